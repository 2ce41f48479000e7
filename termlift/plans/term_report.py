"""Job 1: the best terms of each category and the merged dictionary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from termlift.operators.chi2 import chi2_scores
from termlift.operators.counts import term_freq
from termlift.operators.dictionary import clean_terms
from termlift.operators.tokens import explode_terms
from termlift.operators.topk import TOP_TERMS, top_terms
from termlift.plans.scale import spread, written
from termlift.sinks.text import write_dictionary, write_report


@dataclass(frozen=True)
class TermReport:
    """The tables of a report."""

    freq: DataFrame
    scores: DataFrame
    top: DataFrame
    dictionary: DataFrame


def counted(reviews: DataFrame, stop_words: Sequence[str] | DataFrame) -> DataFrame:
    """The only pass over the texts: pair counts as a written table."""
    return written(term_freq(explode_terms(spread(reviews), "category", stop_words=stop_words)), "term_freq")


def term_report(reviews: DataFrame, stop_words: Sequence[str] | DataFrame, k: int = TOP_TERMS) -> TermReport:
    """Counts, scores, top terms and dictionary of `category, reviewText` rows."""
    freq = counted(reviews, stop_words)
    scores = chi2_scores(freq)
    return TermReport(freq, scores, top_terms(scores, k), clean_terms(freq))


def write_term_report(report: TermReport, folder: str) -> None:
    """Write the category lines and the merged dictionary, which follows them in the report, below a folder."""
    write_report(report.top, f"{folder}/report")
    write_dictionary(report.dictionary, f"{folder}/dictionary")
