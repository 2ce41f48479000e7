"""Scoring raw texts with one stored model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlift.plans.feature_ranking import Features


def text_classifier(features: Features, classifier: PipelineModel) -> PipelineModel:
    """One model from raw text to predicted category, from the fitted features and the fitted classifier.

    It reads the column `reviewText` alone. A null text is scored as an empty one, and a
    text without a known term gets the class of the largest intercept. Labels are not
    read, so rows may have none or ones that were not seen in training. `predicted` is
    the category, as text.
    """
    *texts, indexer = features.model.stages
    filled = SQLTransformer(statement="SELECT *, coalesce(_text, '') AS reviewText FROM __THIS__")
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
    return PipelineModel([filled, *texts, *classifier.stages, names])


def score_texts(model: PipelineModel, rows: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns, and each row's `prediction` and `predicted` category.

    Only these columns enter the model, so others may have any name.
    """
    kept = [F.col(f"`{name}`").alias(f"keep_{place}") for place, name in enumerate(keep)]
    scored = model.transform(rows.select(*kept, F.col(f"`{text}`").alias("_text")))
    back = [F.col(f"keep_{place}").alias(name) for place, name in enumerate(keep)]
    return scored.select(*back, "prediction", "predicted")
