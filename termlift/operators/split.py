"""Train, validation and test parts."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PARTS = ("train", "validation", "test")
WEIGHTS = (0.8, 0.1, 0.1)
SEED = 42
# The draw inside the tuner is another one than the draw of the test part.
TUNING_SEED = 43
_PLACES = 1 << 32


def place_of(key: Column, seed: int = SEED) -> Column:
    """A number below 2^32 from the key and the seed, the same on every run."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def stable_split(df: DataFrame, key: str, weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """Add `part`, decided by the key alone and not by how the rows are partitioned."""
    shares = [Fraction(str(weight)) for weight in weights]
    train = int(_PLACES * shares[0] / sum(shares))
    validation = int(_PLACES * (shares[0] + shares[1]) / sum(shares))
    place = place_of(F.col(key), seed)
    part = F.when(place < train, PARTS[0]).when(place < validation, PARTS[1]).otherwise(PARTS[2])
    return df.withColumn("part", part)


def drawn_split(
    df: DataFrame, key: str, weights: Sequence[float] = WEIGHTS, seed: int = SEED, names: Sequence[str] = PARTS
) -> DataFrame:
    """Add `part`: a random draw whose parts have exactly the sizes that the weights say, rounded down.

    The rows are ordered by a hash of the seed and the key, then by the key as text,
    and cut at ranks; the last part takes what is left. The order is the same however
    the rows are partitioned. Nothing is sorted: the place at a rank is found by two
    histograms of 2^16 cells, and only rows at that very place are ranked by key. Rows
    of equal key stay together: a group across a rank goes to the later part. A null key counts as an empty one.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    placed = df.select(place_of(F.col(key), seed).alias("place"), text.alias("text"))
    total = placed.count()
    shares = [Fraction(str(weight)) for weight in weights]
    ranks = [int(total * sum(shares[:upto]) / sum(shares)) for upto in range(1, len(shares))]
    cuts = [_cut_at(placed, rank) if rank < total else None for rank in ranks]
    place, part = place_of(F.col(key), seed), F.lit(names[len(ranks)])
    for name, cut in reversed(list(zip(names, cuts))):
        below = F.lit(True) if cut is None else (place < cut[0]) | ((place == cut[0]) & (text < cut[1]))
        part = F.when(below, name).otherwise(part)
    return df.withColumn("part", part)


def _cut_at(placed: DataFrame, rank: int) -> tuple[int, str]:
    """The place and key of the row with this rank, from 0, in the order of place and key."""
    low, rest = 0, rank
    for step in (1 << 16, 1):
        cell = F.floor((F.col("place") - low) / step).cast("long")
        inside = placed if step > 1 else placed.filter((F.col("place") >= low) & (F.col("place") < low + (1 << 16)))
        counts = inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.orderBy("cell")) - F.col("n")  # a row per cell, 2^16 at most
        found = counts.withColumn("before", before).filter(F.col("before") <= rest).orderBy(F.desc("cell")).first()
        low, rest = low + found.cell * step, rest - found.before
    at = placed.filter(F.col("place") == low).groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("text")) - F.col("n")  # the keys of one place of 2^32
    return low, at.withColumn("before", before).filter(F.col("before") <= rest).orderBy(F.desc("text")).first().text


def random_split(df: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> list[DataFrame]:
    """Spark's seeded split; the parts depend on the input's partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both tables' rows, repeats included, columns matched by name."""
    return first.unionByName(second)
