"""Report lines and text output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlift.functions.scores import score_text
from termlift.operators.topk import top_lists


def category_lines(top: DataFrame) -> DataFrame:
    """`category, line`: the category, a tab, then `term:score` pairs best first."""
    pairs = F.transform(
        F.arrays_zip("terms", "scores"), lambda pair: F.concat_ws(":", pair["terms"], score_text(pair["scores"]))
    )
    line = F.concat_ws("\t", F.col("category"), F.array_join(pairs, " "))
    return top_lists(top).select("category", line.alias("line"))


def report_lines(top: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Category lines, then one row per dictionary term: `section, category, line`.

    Sorting by all three columns gives the order of the report, at any size.
    """
    first = category_lines(top).select(F.lit(0).alias("section"), "category", "line")
    last = dictionary.select(F.lit(1).alias("section"), F.lit(None).cast("string").alias("category"), F.col("term").alias("line"))
    return first.unionByName(last)


def write_report(top: DataFrame, path: str) -> None:
    """Write the category lines as text; an existing report at this path is replaced, and nothing else."""
    category_lines(top).orderBy("category").select("line").write.mode("overwrite").text(path)


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """Write the terms in order, a space after each; the part files together are the merged line."""
    dictionary.select("term").orderBy("term").write.mode("overwrite").option("lineSep", " ").text(path)


def score_lines(scored: DataFrame, score: str = "statistic") -> DataFrame:
    """`term`, a tab and the score, per row."""
    return scored.select(F.concat_ws("\t", F.col("term"), score_text(F.col(score))).alias("line"))


def write_scores(scored: DataFrame, path: str, score: str = "statistic") -> None:
    """Write term and score, best first and ties by term."""
    ordered = scored.orderBy(F.desc(score), F.asc("term"))
    score_lines(ordered, score).write.mode("overwrite").text(path)


def read_category_lines(lines: DataFrame) -> DataFrame:
    """Parse category lines back to `category, rank, term, chi2`.

    A term holds no colon, so the pair splits at its only one.
    """
    parts = F.split("line", "\t", 2)
    pairs = lines.select(parts[0].alias("category"), F.posexplode_outer(F.split(parts[1], " ")).alias("at", "pair"))
    return pairs.select(
        "category",
        (F.col("at") + 1).alias("rank"),
        F.split_part("pair", F.lit(":"), F.lit(1)).alias("term"),
        F.split_part("pair", F.lit(":"), F.lit(2)).cast("double").alias("chi2"),
    )
