"""Stop words as lists and as tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlift.sources.tables import rows

TERM_SCHEMA = "term string"
# Words that may be part of a plan.
LIST_WORDS = 10_000


def default_stop_words(language: str = "english") -> list[str]:
    """Spark's own list for a language."""
    return list(StopWordsRemover.loadDefaultStopWords(language))


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lines of a text file as column `term`."""
    return spark.read.text(path).select(F.col("value").alias("term")).filter("term != ''").distinct()


def stop_word_table(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    """In-memory words as column `term`."""
    return rows(spark, [(word,) for word in sorted(set(words))], TERM_SCHEMA)


def stop_word_list(table: DataFrame, most: int = LIST_WORDS) -> list[str]:
    """The words of a `term` table, for stages that take a list; more than `most` are refused."""
    words = [row.term for row in table.select("term").limit(most + 1).collect()]
    if len(words) > most:
        raise ValueError(f"more than {most} stop words; drop them by a join instead")
    return sorted(words)
