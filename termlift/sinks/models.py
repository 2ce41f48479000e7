"""Model output."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> None:
    """Write a fitted pipeline; a model already at this path is replaced."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Read a fitted pipeline."""
    return PipelineModel.load(path)
