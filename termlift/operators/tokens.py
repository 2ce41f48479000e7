"""Texts to terms, one row per term occurrence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlift.functions.text import FEATURE_DELIMITERS, TERM_DELIMITERS, is_term, raw_terms, terms
from termlift.plans.scale import checked_broadcast
from termlift.sources.stopwords import stop_word_list


def explode_terms(
    reviews: DataFrame,
    *keep: str,
    text: str = "reviewText",
    delimiters: str = TERM_DELIMITERS,
    stop_words: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """One row per kept term occurrence: the kept columns and `term`.

    Stop words are a list, or a table with `term`, as read from a file.

    The outer generator matters: for a plain one the optimizer infers a filter
    on the array's size, and every text would be split twice.
    """
    pieces = F.explode_outer(raw_terms(F.col(text), delimiters)).alias("term")
    exploded = reviews.select(*keep, pieces)
    if isinstance(stop_words, DataFrame):
        return drop_stop_words(exploded.filter(is_term(F.col("term"), ())), stop_words)
    return exploded.filter(is_term(F.col("term"), stop_words))


def drop_stop_words(exploded: DataFrame, stop_table: DataFrame) -> DataFrame:
    """Rows whose `term` is not in the stop table (`term`)."""
    return exploded.join(checked_broadcast(stop_table), "term", "left_anti").select(*exploded.columns)


def add_terms(
    reviews: DataFrame, text: str = "reviewText", stop_words: Sequence[str] | DataFrame = ()
) -> DataFrame:
    """Add the array column `terms`, split by the feature delimiters.

    A table of stop words must be small enough to be part of the plan, see `stop_word_list`.
    """
    if isinstance(stop_words, DataFrame):
        stop_words = stop_word_list(stop_words)
    return reviews.withColumn("terms", terms(F.col(text), stop_words=stop_words))


def add_pieces(reviews: DataFrame, text: str = "reviewText") -> DataFrame:
    """Add the array column `terms` as `add_terms` does, with short pieces and stop words still in it.

    Spark calls a filter of an array for each element. Where pieces are counted anyway, dropping
    them from the counts, by `kept_terms`, asks once for each different piece.
    """
    return reviews.withColumn("terms", raw_terms(F.col(text), FEATURE_DELIMITERS))


def kept_terms(counted: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """The counts without those of short pieces and stop words, whatever their case; a null `term` stays."""
    return counted.filter(F.col("term").isNull() | is_term(F.col("term"), sorted({word.lower() for word in stop_words})))
