"""The linear classification pipeline: select, scale, normalise, one-vs-rest SVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import Normalizer, StandardScaler
from pyspark.sql import DataFrame

from termlift.operators.selection import pvalue_slicer


def scaler(with_std: bool = True, input: str = "selected", output: str = "scaled") -> StandardScaler:
    """Scaling without centring, which keeps vectors sparse; without `with_std` it is the identity."""
    return StandardScaler(withMean=False, withStd=with_std, inputCol=input, outputCol=output)


def normalizer(input: str = "scaled", output: str = "normal") -> Normalizer:
    """Unit L2 length."""
    return Normalizer(p=2.0, inputCol=input, outputCol=output)


def linear_svm(
    reg_param: float = 0.0, max_iter: int = 100, features: str = "normal", label: str = "label"
) -> LinearSVC:
    """Binary hinge-loss SVM; intercept, standardisation, tolerance and threshold at Spark's defaults."""
    return LinearSVC(regParam=reg_param, maxIter=max_iter, featuresCol=features, labelCol=label)


def one_vs_rest(svm: LinearSVC, parallelism: int = 1) -> OneVsRest:
    """One SVM per label, the best margin wins; `parallelism` labels train at a time."""
    return OneVsRest(
        classifier=svm, featuresCol=svm.getFeaturesCol(), labelCol=svm.getLabelCol(), parallelism=parallelism
    )


def classifier_pipeline(
    ranking: Sequence[int],
    num_top_features: int,
    with_std: bool = True,
    reg_param: float = 0.0,
    max_iter: int = 100,
    parallelism: int = 1,
) -> Pipeline:
    """Selection of the first features of a ranking, scaling, normalising and one-vs-rest in one estimator.

    Reads vectors `features` and index `label`, adds `prediction`.
    """
    svm = linear_svm(reg_param, max_iter)
    return Pipeline(
        stages=[
            pvalue_slicer(ranking, num_top_features), scaler(with_std), normalizer(), one_vs_rest(svm, parallelism)
        ]
    )


def score(model, unscored: DataFrame, *keep: str) -> DataFrame:
    """Batch scoring: the kept columns and `prediction`."""
    return model.transform(unscored).select(*keep, "prediction")
