"""Weighted F1 from label and prediction columns."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlift.functions.scores import ratio_or_zero


def confusion_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return scored.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def weighted_f1(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row with `rows` and the label-weighted mean of 2 tp / (actual + predicted), `f1`.

    One pass over the rows gives the confusion counts. Each count then stands
    once for its label and once for its prediction, so no join is needed.
    """
    hit = F.col(label) == F.col(prediction)
    n = F.col("n")
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col(label).alias("class"), n.alias("actual"), zero.alias("predicted"), F.when(hit, n).otherwise(zero).alias("tp")),
        F.struct(F.col(prediction).alias("class"), zero.alias("actual"), n.alias("predicted"), zero.alias("tp")),
    )
    classes = (
        confusion_counts(scored, label, prediction)
        .select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    )
    f1 = ratio_or_zero(2.0 * F.col("tp"), F.col("actual") + F.col("predicted"))
    return classes.agg(
        F.sum("actual").alias("rows"), (F.sum(F.col("actual") * f1) / F.sum("actual")).alias("f1")
    )


def f1_evaluator(label: str = "label", prediction: str = "prediction") -> MulticlassClassificationEvaluator:
    """MLlib's evaluator for the same score."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="f1")
