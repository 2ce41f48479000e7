"""Consecutive numbers in a given order, for tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termlift.plans.scale import checked_broadcast, written

# Within a partition, `monotonically_increasing_id` counts in the low 33 bits.
_PLACE_BITS = 33


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Add the column `name`: 0, 1, 2, ... in the given order, which must decide ties if the result is to repeat.

    The rows are sorted by ranges and written with their place in their partition. The
    partitions' sizes, one row each, are summed up, and every row adds what lies before its
    partition. So no task sees more than its range, and no row passes through the driver.
    """
    placed = written(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_id", _PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")  # a row per partition
    starts = written(sizes.select("_part", before.alias("_before")), "partition_starts")
    place = F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1)
    joined = placed.withColumn("_part", part).join(checked_broadcast(starts), "_part")
    return joined.withColumn(name, F.col("_before") + place).drop("_part", "_before", "_id")
