"""Chi-square scores of (category, term) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from termlift.functions.scores import chi2_2x2
from termlift.operators.counts import category_totals, term_totals
from termlift.plans.scale import BROADCAST_ROWS, within, written

# Keys that a category is dealt to where its total cannot be broadcast.
SALTS = 32


def _category_side(freq: DataFrame) -> DataFrame:
    """Category totals with the grand total on each row, as a written table."""
    totals = category_totals(freq)
    everything = totals.agg(F.sum("category_total")).scalar()
    return written(totals.withColumn("grand_total", everything), "category_totals")


def _scored(with_margins: DataFrame) -> DataFrame:
    margins = (F.col(name) for name in ("freq_ct", "term_total", "category_total", "grand_total"))
    return with_margins.select("category", "term", "freq_ct", chi2_2x2(*margins).alias("chi2"))


def chi2_scores(freq: DataFrame, max_categories: int = BROADCAST_ROWS) -> DataFrame:
    """Score every pair of a `term_freq` table: `category, term, freq_ct, chi2`.

    With a proven small number of categories, a term has at most that many
    rows: its total is a window sum over one shuffle by term, and the category
    totals are broadcast. Beyond the bound it takes `chi2_scores_by_join`.
    `freq` is read several times, so give it a written table.
    """
    totals = _category_side(freq)
    if not within(totals, max_categories):
        return _joined_by_shuffle(freq, totals)
    term_total = F.sum("freq_ct").over(Window.partitionBy("term")).alias("term_total")
    with_term = freq.select("category", "term", "freq_ct", term_total)
    return _scored(with_term.join(F.broadcast(totals), "category"))


def chi2_scores_by_join(freq: DataFrame, max_categories: int = BROADCAST_ROWS) -> DataFrame:
    """The same scores by joins only, for any number of categories.

    Term totals are unbounded and shuffle; category totals are broadcast if
    proven small, else they shuffle too.
    """
    totals = _category_side(freq)
    if not within(totals, max_categories):
        return _joined_by_shuffle(freq, totals)
    return _filled(freq.join(term_totals(freq), "term", "left").join(F.broadcast(totals), "category", "left"))


def _joined_by_shuffle(freq: DataFrame, totals: DataFrame) -> DataFrame:
    """Both joins by shuffle. A category's pairs are dealt to SALTS keys, and its total is there for each."""
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS))
    copies = totals.withColumn("salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS))).cast("array<long>")))
    with_term = freq.join(term_totals(freq).hint("shuffle_merge"), "term", "left").withColumn("salt", salt)
    return _filled(with_term.join(copies.hint("shuffle_merge"), ["category", "salt"], "left"))


def _filled(joined: DataFrame) -> DataFrame:
    return _scored(joined.fillna(0, ["term_total", "category_total", "grand_total"]))
