"""Tokenising and term cleaning as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two delimiter classes. Whitespace and digits are ASCII.
# Only the feature class splits on commas; neither splits on double quotes.
TERM_DELIMITERS = r"[\s\d()\[\]{}.!?;:+=\-_'`~#@&*%€$§\\/]+"
FEATURE_DELIMITERS = r"[\s\d()\[\]{}.!?,;:+=\-_'`~#@&*%€$§\\/]+"

# What the two classes of the delimiters hold, each character by itself.
_SPELLED_OUT = {r"\s": r" \t\n\x0B\f\r", r"\d": "0123456789"}

# Fixed value: the edges that `clean_term` strips (anything but ASCII letters and digits).
EDGE_CHARACTERS = r"^[^A-Za-z0-9]+|[^A-Za-z0-9]+$"

MIN_TERM_LENGTH = 2


def spelled_out(delimiters: str) -> str:
    """The same delimiters without classes inside the class: Java then tells most characters by one look into a table."""
    for name, characters in _SPELLED_OUT.items():
        delimiters = delimiters.replace(name, characters)
    return delimiters


def raw_terms(text: Column, delimiters: str) -> Column:
    """Lower-cased pieces between delimiters, empty and short ones included."""
    return F.split(F.lower(text), spelled_out(delimiters))


def is_term(term: Column, stop_words: Sequence[str] = (), min_length: int = MIN_TERM_LENGTH) -> Column:
    """Predicate: long enough and not a stop word."""
    kept = F.length(term) >= min_length
    return kept & ~term.isin(*stop_words) if stop_words else kept


def terms(
    text: Column,
    delimiters: str = FEATURE_DELIMITERS,
    stop_words: Sequence[str] = (),
    min_length: int = MIN_TERM_LENGTH,
) -> Column:
    """Array of kept terms in text order, repeats included.

    Stop words match whatever their case.
    """
    lowered = sorted({word.lower() for word in stop_words})
    return F.filter(raw_terms(text, delimiters), lambda term: is_term(term, lowered, min_length))


def clean_term(term: Column) -> Column:
    """Strip everything but ASCII letters and digits from both edges."""
    return F.regexp_replace(term, EDGE_CHARACTERS, "")
