"""MLlib vectors as rows of SQL values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entries(vector: Column) -> Column:
    """Array of (featureIndex, weight) for the non-zero entries of a sparse or dense vector."""
    parts = F.unwrap_udt(vector)
    index = F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1))
    pairs = F.arrays_zip(index.alias("featureIndex"), parts["values"].alias("weight"))
    return F.filter(pairs, lambda pair: pair["weight"] != 0)


def explode_vector(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    """One row per non-zero entry: the kept columns, `featureIndex`, `weight`.

    Counting inside each vector needs no shuffle. The outer generator keeps the
    optimizer from adding an emptiness filter that would build the vector twice.
    """
    return (
        df.select(*keep, F.inline_outer(entries(F.col(vector))))
        .toDF(*keep, "featureIndex", "weight")
        .filter(F.col("featureIndex").isNotNull())
    )
