"""Job 3: a tuned linear classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from termlift.operators.split import PARTS, SEED, drawn_split, stable_split, union_all
from termlift.operators.tuning import (
    Grid,
    best_params,
    best_point,
    fit_point,
    tune_on_parts,
    tune_with_random_split,
)


# The parts are read a dozen times, the trainer's packed rows in every pass: memory is left to the latter.
KEPT = StorageLevel.DISK_ONLY


@dataclass(frozen=True)
class Tuned:
    """The best model, each point's validation F1 and the best point's test F1."""

    model: PipelineModel
    metrics: DataFrame
    best: DataFrame


def tuned_classifier(vectors: DataFrame, key: str, grid: Grid = Grid(), parallelism: int = 1) -> Tuned:
    """Split by key, tune on the validation part, refit on train and validation, score the test part."""
    parts = stable_split(vectors, key).select("part", "label", "features").persist(KEPT)
    try:
        train, validation, test = (parts.filter(parts.part == name).drop("part") for name in PARTS)
        metrics = tune_on_parts(train, validation, grid, parallelism)
        return _refitted(union_all(train, validation), test, metrics)
    finally:
        parts.unpersist()


def randomly_tuned_classifier(
    vectors: DataFrame, key: str, grid: Grid = Grid(), seed: int = SEED, parallelism: int = 1
) -> Tuned:
    """The same by random draws of exact sizes: the validation rows are merged back and drawn again by the tuner.

    The parts depend on the keys and the seed, not on how `vectors` is partitioned.
    """
    parts = drawn_split(vectors, key, seed=seed).select(key, "part", "label", "features").persist(KEPT)
    try:
        train, validation, test = (parts.filter(parts.part == name).drop("part") for name in PARTS)
        merged = union_all(train, validation)
        metrics = tune_with_random_split(merged, key, grid, parallelism=parallelism)
        return _refitted(merged, test, metrics)
    finally:
        parts.unpersist()


def _refitted(train: DataFrame, test: DataFrame, metrics: DataFrame) -> Tuned:
    model = fit_point(train, best_point(metrics))
    return Tuned(model, metrics, best_params(model, test))
