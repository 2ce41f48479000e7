"""Chi-square and formatting expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_DECIMALS = 6


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient, or 0.0 where the denominator is zero."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def chi2_2x2(pair: Column, term_total: Column, category_total: Column, grand_total: Column) -> Column:
    """Chi-square of the 2x2 table (term or not, category or not) from its margins.

    Counts turn into doubles before any product, so large corpora do not overflow.
    """
    both = pair.cast("double")
    term = term_total.cast("double")
    category = category_total.cast("double")
    total = grand_total.cast("double")
    term_elsewhere = term - both
    others_here = category - both
    others_elsewhere = total - term - category + both
    association = both * others_elsewhere - term_elsewhere * others_here
    margins = term * (total - term) * category * (total - category)
    return ratio_or_zero(total * association * association, margins)


def rounded(score: Column) -> Column:
    """Score at the precision that ranks, ties and text output use."""
    return F.round(score, SCORE_DECIMALS)


def score_text(score: Column) -> Column:
    """Fixed-point text with six decimals."""
    return F.format_string("%.6f", rounded(score))


# Up to here the error function is summed as a series, beyond as a continued fraction; both reach 1e-14 with TERMS steps.
_SERIES_UP_TO = 2.0
_TERMS = 80


def _erfc(z: Column) -> Column:
    """Complementary error function of z >= 0."""
    steps = F.sequence(F.lit(1), F.lit(_TERMS))
    two_over_root_pi = 2.0 / math.sqrt(math.pi)
    # erf(z) = 2/sqrt(pi) exp(-z^2) * sum of z (2 z^2)^n / (1 * 3 * ... * (2n + 1))
    series = F.aggregate(
        steps,
        F.struct(z.alias("term"), z.alias("sum")),
        lambda seen, n: F.struct(
            (seen["term"] * 2.0 * z * z / (2 * n + 1)).alias("term"),
            (seen["sum"] + seen["term"] * 2.0 * z * z / (2 * n + 1)).alias("sum"),
        ),
        lambda seen: seen["sum"],
    )
    # erfc(z) = exp(-z^2)/sqrt(pi) / (z + (1/2)/(z + (2/2)/(z + (3/2)/(z + ...)))), from the inside out
    fraction = F.aggregate(F.reverse(steps), z, lambda inner, n: z + (n / 2.0) / inner)
    small = 1.0 - two_over_root_pi * F.exp(-z * z) * series
    large = F.exp(-z * z) / math.sqrt(math.pi) / fraction
    return F.when(z <= _SERIES_UP_TO, small).otherwise(large)


def chi2_survival(statistic: Column, degrees: Column) -> Column:
    """Probability that a chi-square variable with so many degrees of freedom exceeds the statistic.

    With x half the statistic it is a finite sum of x^a / gamma(a + 1) * exp(-x),
    over a = 0, 1, ... below half an even number of degrees, or over a = 1/2,
    3/2, ... plus erfc(sqrt(x)) for an odd one. Terms are kept as logarithms, so
    many degrees do not overflow. Without a degree of freedom it is one.
    """
    x = statistic / 2.0
    odd = degrees % 2
    first = odd / 2.0
    count = F.floor(degrees / 2).cast("int")
    # log of the first term: -x for a = 0; log(x)/2 - x - log gamma(3/2) for a = 1/2.
    start = F.when(odd == 1, F.log(x) / 2.0 - x - math.log(math.sqrt(math.pi) / 2)).otherwise(-x)
    steps = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(
        steps,
        F.struct(start.alias("log"), F.lit(0.0).alias("sum")),
        lambda seen, n: F.struct(
            (seen["log"] + F.log(x) - F.log(n + first)).alias("log"), (seen["sum"] + F.exp(seen["log"])).alias("sum")
        ),
        lambda seen: seen["sum"],
    )
    tail = F.when(odd == 1, _erfc(F.sqrt(x))).otherwise(F.lit(0.0))
    return F.when((degrees <= 0) | (x <= 0), F.lit(1.0)).otherwise(F.least(total + tail, F.lit(1.0)))
