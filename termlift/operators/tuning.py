"""Hyper-parameter grids and train/validation tuning."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlift.operators.classify import normalizer, scaler
from termlift.operators.evaluate import f1_evaluator
from termlift.operators.selection import pvalue_ranking, pvalue_slicer
from termlift.operators.split import PARTS, TUNING_SEED, WEIGHTS, drawn_split
from termlift.operators.svm import Setting, fit_all
from termlift.sources.tables import rows

_GRID_SCHEMA = "numTopFeatures int, withStd boolean, regParam double, maxIter int"
_METRIC_SCHEMA = _GRID_SCHEMA + ", f1 double"


@dataclass(frozen=True)
class Grid:
    """Values to try; the defaults are those of the published results."""

    num_top_features: Sequence[int] = (2000,)
    with_std: Sequence[bool] = (True, False)
    reg_param: Sequence[float] = (0.01, 0.1, 1.0)
    max_iter: Sequence[int] = (5, 10)


@dataclass(frozen=True)
class Point:
    """One combination of a grid."""

    num_top_features: int
    with_std: bool
    reg_param: float
    max_iter: int


def param_grid(spark: SparkSession, grid: Grid) -> DataFrame:
    """Every combination as a row: `numTopFeatures, withStd, regParam, maxIter`."""
    values = [(list(grid.num_top_features), list(grid.with_std), list(grid.reg_param), list(grid.max_iter))]
    schema = "numTopFeatures array<int>, withStd array<boolean>, regParam array<double>, maxIter array<int>"
    combined = rows(spark, values, schema)
    for name in ("numTopFeatures", "withStd", "regParam", "maxIter"):
        combined = combined.withColumn(name, F.explode(name))
    return combined


def tune_with_random_split(
    train_validation: DataFrame,
    key: str,
    grid: Grid,
    weights: Sequence[float] = WEIGHTS[:2],
    seed: int = TUNING_SEED,
    parallelism: int = 1,
) -> DataFrame:
    """F1 of each point on a random validation part of exact size, drawn once, with the work shared as in `tune_on_parts`.

    The draw depends on the keys and the seed, not on how the rows are partitioned.
    """
    drawn = drawn_split(train_validation, key, weights, seed, PARTS[:2])
    train, validation = (drawn.filter(drawn.part == name).drop("part") for name in PARTS[:2])
    return tune_on_parts(train, validation, grid, parallelism)


def tune_on_parts(train: DataFrame, validation: DataFrame, grid: Grid, parallelism: int = 1) -> DataFrame:
    """F1 on a given validation part for each point, sharing the work points have in common.

    The chi-square test depends on no parameter and runs once. Each feature
    count and scaling is prepared once and kept for all SVM settings, where
    fitting whole pipelines would repeat both for every point. All classes and
    settings of it are trained in the same passes, and a setting with fewer
    iterations is taken from the one with more. Up to `parallelism` preparations
    run at a time.
    """
    spark = train.sparkSession
    evaluator = f1_evaluator()
    ranking = pvalue_ranking(train, max(grid.num_top_features))
    settings = [Setting(*one) for one in product(grid.reg_param, grid.max_iter)]

    def scored(prepared: tuple[int, bool]) -> list[tuple]:
        k, with_std = prepared
        slicer = pvalue_slicer(ranking, k)
        scaling = scaler(with_std).fit(slicer.transform(train))
        prepare = PipelineModel([slicer, scaling, normalizer()])
        models = fit_all(prepare.transform(train), settings)
        checking = prepare.transform(validation).select("label", "normal").persist()
        try:
            scores = [evaluator.evaluate(models[setting].transform(checking)) for setting in settings]
        finally:
            checking.unpersist()
        return [(k, with_std, *astuple(setting), float(f1)) for setting, f1 in zip(settings, scores)]

    prepared = list(product(grid.num_top_features, grid.with_std))
    with ThreadPool(max(1, min(parallelism, len(prepared)))) as pool:
        results = [row for part in pool.map(inheritable_thread_target(spark)(scored), prepared) for row in part]
    return rows(spark, results, _METRIC_SCHEMA)


def best_point(metrics: DataFrame) -> Point:
    """The point with the highest F1; ties go to fewer features, scaling, lower penalty and fewer iterations."""
    order = (F.desc("f1"), F.asc("numTopFeatures"), F.desc("withStd"), F.asc("regParam"), F.asc("maxIter"))
    best = metrics.orderBy(*order).first()
    return Point(best.numTopFeatures, best.withStd, best.regParam, best.maxIter)


def fit_point(train: DataFrame, point: Point, ranking: Sequence[int] | None = None) -> PipelineModel:
    """The whole pipeline, fitted with one point's parameters; a ranking of the features made before is reused."""
    ranking = pvalue_ranking(train, point.num_top_features) if ranking is None else ranking
    slicer = pvalue_slicer(ranking, point.num_top_features)
    scaling = scaler(point.with_std).fit(slicer.transform(train))
    prepare = PipelineModel([slicer, scaling, normalizer()])
    setting = Setting(point.reg_param, point.max_iter)
    return PipelineModel([*prepare.stages, fit_all(prepare.transform(train), [setting])[setting]])


def best_params(model: PipelineModel, test: DataFrame) -> DataFrame:
    """One row: a fitted pipeline's parameters and its F1 on test rows."""
    selector, scaling, _, ovr = model.stages
    svm = ovr.getClassifier()
    f1 = f1_evaluator().evaluate(model.transform(test))
    row = (
        len(selector.selectedFeatures),
        scaling.getWithStd(),
        svm.getRegParam(),
        svm.getMaxIter(),
        float(f1),
    )
    return rows(test.sparkSession, [row], _METRIC_SCHEMA)
