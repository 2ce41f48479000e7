"""The merged dictionary of scored terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlift.functions.text import clean_term


def clean_terms(scored: DataFrame) -> DataFrame:
    """Distinct non-empty cleaned terms of a table with `term`.

    A term cleans to nothing just if it has no ASCII letter or digit, so the
    test needs no second cleaning.
    """
    return scored.filter(F.col("term").rlike("[A-Za-z0-9]")).select(clean_term(F.col("term")).alias("term")).distinct()


def merged_dictionary(scored: DataFrame) -> DataFrame:
    """The cleaned terms in code-point order, one per row."""
    return clean_terms(scored).orderBy("term")
