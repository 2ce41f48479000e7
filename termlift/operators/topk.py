"""Best terms per category and overall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from termlift.functions.scores import rounded

TOP_TERMS = 75
# A category's terms are ranked in this many parts first.
PARTS = 32


def top_terms(scores: DataFrame, k: int = TOP_TERMS) -> DataFrame:
    """The k best terms of each category: `category, rank, term, chi2`.

    Scores are compared at six decimals and ties go to the lower term. Each
    category is ranked in PARTS parts by a hash of the term, whatever its size
    and whatever k is, and the best k of each part are ranked again, so no task
    holds a category and the last shuffle moves at most k * PARTS rows of it.
    """
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS)).alias("part")
    order = (F.desc("chi2"), F.asc("term"))
    rounded_scores = scores.select("category", "term", rounded(F.col("chi2")).alias("chi2"), part)
    in_part = F.row_number().over(Window.partitionBy("category", "part").orderBy(*order))
    best = rounded_scores.withColumn("rank", in_part).filter(F.col("rank") <= k).drop("rank", "part")
    overall = F.row_number().over(Window.partitionBy("category").orderBy(*order))
    return best.withColumn("rank", overall).filter(F.col("rank") <= k).select("category", "rank", "term", "chi2")


def top_lists(top: DataFrame) -> DataFrame:
    """One row per category with its ranked terms and scores as arrays (at most k long)."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "term", "chi2")))
    return (
        top.groupBy("category")
        .agg(ranked.alias("ranked"))
        .select("category", F.col("ranked.term").alias("terms"), F.col("ranked.chi2").alias("scores"))
    )


def top_rows(scored: DataFrame, k: int, score: str, tie: str = "term") -> DataFrame:
    """The k best rows of a whole table, best first."""
    return scored.orderBy(F.desc(score), F.asc(tie)).limit(k)
