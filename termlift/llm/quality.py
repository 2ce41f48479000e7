"""Quality rules whose thresholds come from quantile sketches of each language and source.

Words are runs of `[^\\x20\\x09-\\x0D]`. Each measure is a part per mille of a
whole; a sketch is a histogram over buckets whose width grows with the value (32
buckets for each power of two, so a quantile is at most 1/32 too low). Sketches
are merged by adding counts, so they combine before the shuffle and a hot source
costs no more than any other. The sketch of a language and source is its own plus
the language's, scaled to the weight of PRIOR documents, so that small sources lean
on their language and the fences move smoothly as a source grows. A value is an
outlier when it lies beyond

    upper quantile + SPREAD * (upper quantile - median),    UPPER of five parts of the documents lie below,

and for word lengths also below the same from the lower quantile. Fences hold no
fixed distance; what is fixed is the count that no document is judged by, EVENTS
times what one event adds (UNITS): four symbols, repeated lines or the like more
than the fence allows for the text's length may be chance. As the quantile is an
order statistic, up to a fifth of a group may be outliers and not move its fence.

Defined results: a null text counts as empty; empty texts have no words and
fail the base rule; null languages and sources are groups of their own; repeated
rows are judged alike, each on its own; an empty table gives an empty result.
Other columns of the input are neither read nor clash with those made here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termlift.plans.scale import checked_broadcast, written

GAP = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Upper and lower quantiles: UPPER and 5 - UPPER fifths.
UPPER = 4
SPREAD = 4
# Documents that the language's sketch counts as in the sketch of each of its sources.
PRIOR = 20
EVENTS = 4
# What one event adds to a measure's part: a symbol, a long token, a repeated window, a line, a capital.
UNITS = {"symbols": 1, "word_length": 25, "repeats": 2 * WINDOW, "dup_lines": 1, "capitals": 1}
LOW_SIDE = ("word_length",)


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append `q_*` counts of the whole text to every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    cut = docs.withColumn("q_text", body).withColumn(
        "q_hashes",
        F.transform(F.filter(F.split("q_text", GAP + "+"), lambda word: word != ""), lambda word: F.xxhash64(word)),
    )
    counted = (
        cut.withColumn("q_n_words", F.size("q_hashes").cast("long"))
        .withColumn("q_windows", _windows(F.col("q_hashes"), F.col("q_n_words")))
        .withColumn("q_lines", F.filter(F.split("q_text", "\n"), lambda line: F.rlike(line, F.lit(WORD))))
    )
    measured = (
        counted.withColumn("q_n_lines", F.size("q_lines").cast("long"))
        .withColumn("q_n_dup_lines", (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"))
        .withColumn("q_word_chars", (F.length("q_text") - F.regexp_count("q_text", F.lit(GAP))).cast("long"))
        .withColumn("q_n_symbols", F.regexp_count("q_text", F.lit(SYMBOLS)).cast("long"))
        .withColumn("q_n_capitals", F.regexp_count("q_text", F.lit(r"\p{Lu}")).cast("long"))
        .withColumn("q_repeated", F.size(F.array_distinct("q_windows")) < F.size("q_windows"))
        .drop("q_text", "q_lines", "q_hashes")
    )
    marked = measured.withColumn("q_pairs", F.when(F.col("q_repeated"), _sorted_windows("q_windows")))
    return marked.withColumn("q_n_repeat_words", _covered("q_pairs")).drop("q_windows", "q_pairs", "q_repeated")


def _windows(hashes: Column, n_words: Column) -> Column:
    starts = F.sequence(F.lit(1), (n_words - (WINDOW - 1)).cast("int"))
    made = F.transform(starts, lambda start: F.xxhash64(F.slice(hashes, start, WINDOW)))
    return F.when(n_words >= WINDOW, made).otherwise(F.array().cast("array<bigint>"))


def _sorted_windows(windows: str) -> Column:
    return F.array_sort(F.transform(windows, lambda key, start: F.struct(key.alias("key"), start.alias("start"))))


def _covered(pairs: str) -> Column:
    """Words inside windows that occur twice or more: neighbours in key order share their key."""
    at = F.col(pairs)
    twins = F.filter(
        at,
        lambda pair, i: (F.get(at, i - 1)["key"] == pair["key"]) | (F.get(at, i + 1)["key"] == pair["key"]),
    )
    starts = F.array_sort(F.transform(twins, lambda pair: pair["start"]))
    total = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda done, start: F.struct(
            (done["n"] + F.least(F.lit(WINDOW), start - done["last"])).alias("n"), start.alias("last")
        ),
        lambda done: done["n"],
    )
    return F.coalesce(total, F.lit(0)).cast("long")


def _per_mille(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.floor(part * 1000 / whole)).otherwise(F.lit(0)).cast("long")


# Each measure's part and whole.
MEASURES = {
    "symbols": ("q_n_symbols", "q_n_words"),
    "word_length": ("q_word_chars", "q_n_words"),
    "repeats": ("q_n_repeat_words", "q_n_words"),
    "dup_lines": ("q_n_dup_lines", "q_n_lines"),
    "capitals": ("q_n_capitals", "q_word_chars"),
}


def _value(name: str) -> Column:
    part, whole = MEASURES[name]
    return _per_mille(F.col(part), F.col(whole))


def base_failed() -> Column:
    words = F.col("q_n_words")
    return (words < MIN_WORDS) | (100 * F.col("q_n_repeat_words") > MAX_REPEAT_PERCENT * words)


def bucket(value: Column) -> Column:
    """The value with all but its six highest bits cleared."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0)).cast("int")
    power = F.pow(F.lit(2.0), shift).cast("long")
    return F.floor(value / power).cast("long") * power


def sketches(measured: DataFrame, keys: list[str]) -> DataFrame:
    """Bucket counts of every measure by `keys`: keys, measure, bucket, n."""
    named = [F.struct(F.lit(name).alias("measure"), bucket(_value(name)).alias("bucket")) for name in MEASURES]
    rows = measured.select(*keys, F.inline(F.array(*named)))
    return rows.groupBy(*keys, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Coarser sketches: counts of the same bucket add up."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def blended(fine: DataFrame) -> DataFrame:
    """The sketch of each language and source, with its language's added at the weight of PRIOR documents.

    Own counts are multiplied by the language's documents and the language's by PRIOR,
    which keeps whole numbers; they are decimals, as products may pass 64 bits.
    """
    key = ["q_lang", "q_source"]
    wide = merged(fine, ["q_lang"]).select(F.col("q_lang").alias("q_l"), "measure", "bucket", "n")
    documents = fine.filter(F.col("measure") == next(iter(MEASURES)))
    of_lang = documents.groupBy(F.col("q_lang").alias("q_l")).agg(F.sum("n").alias("in_lang"))
    same = F.col("q_lang").eqNullSafe(F.col("q_l"))

    def weight(count: Column, times: Column) -> Column:
        return (count.cast("decimal(19,0)") * times.cast("decimal(18,0)")).cast("decimal(38,0)").alias("n")

    own = fine.join(of_lang, same).select(*key, "measure", "bucket", weight(F.col("n"), F.col("in_lang")))
    lent = documents.select(*key).distinct().join(wide, same).select(*key, "measure", "bucket", weight(F.col("n"), F.lit(PRIOR)))
    return merged(own.unionByName(lent), key)


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row by `keys`: a map of each measure to its lowest and highest value before the EVENTS allowed.

    A window holds one row per bucket, of which there are 32 for each power of two.
    """
    group = Window.partitionBy(*keys, "measure")
    seen = sketch.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("all", F.sum("n").over(group))

    def quantile(part: int, of: int, name: str) -> Column:
        return F.min(F.when(F.col("upto") * of >= F.col("all") * part, F.col("bucket"))).alias(name)

    picked = seen.groupBy(*keys, "measure").agg(quantile(5 - UPPER, 5, "lower"), quantile(1, 2, "middle"), quantile(UPPER, 5, "upper"))
    low = F.when(F.col("measure").isin(*LOW_SIDE), F.col("lower") - SPREAD * (F.col("middle") - F.col("lower"))).otherwise(F.lit(0))
    high = F.col("upper") + SPREAD * (F.col("upper") - F.col("middle"))
    fence = F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))
    pairs = F.collect_list(F.struct("measure", fence.alias("fence")))
    return picked.groupBy(*keys).agg(F.map_from_entries(pairs).alias("fences"))


def thresholds(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Fences of each language and source as a written table: q_lang, q_source, q_fences."""
    counts = [name for name in measured.columns if name.startswith("q_")]
    keyed = measured.select(F.col(lang).alias("q_lang"), F.col(source).alias("q_source"), *counts)
    fine = written(sketches(keyed, ["q_lang", "q_source"]), "quality_sketches")
    limits = fences(blended(fine), ["q_lang", "q_source"])
    return written(limits.select("q_lang", "q_source", F.col("fences").alias("q_fences")), "quality_fences")


def judged(measured: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Append `q_base_failed` and `q_kept` by a join with the thresholds."""
    inside = F.lit(True)
    for name, (_, whole) in MEASURES.items():
        fence = F.col("q_fences")[name]
        chance = F.floor(F.lit(1000 * EVENTS * UNITS[name]) / F.greatest(F.col(whole), F.lit(1)))
        inside = inside & _value(name).between(fence["low"] - chance, fence["high"] + chance)
    same = F.col(lang).eqNullSafe(F.col("q_lang")) & F.col(source).eqNullSafe(F.col("q_source"))
    joined = measured.join(checked_broadcast(limits), same)
    failed = joined.withColumn("q_base_failed", base_failed())
    return failed.withColumn("q_kept", ~F.col("q_base_failed") & inside).drop("q_lang", "q_source", "q_fences")


def quality_report(docs: DataFrame) -> DataFrame:
    """Counts and verdict of each document, in one pass over the texts: the counts are written once."""
    narrow = docs.select("doc_id", "lang", "source", "text")
    measured = written(features(narrow).drop("text"), "quality_features")
    rows = judged(measured, thresholds(measured))
    counts = [F.col(f"q_{name}").alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select("doc_id", *counts, F.col("q_base_failed").alias("base_failed"), F.col("q_kept").alias("kept"))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, with their own columns.

    The rows are written once with their counts, so the texts are measured once
    and no key is needed to join verdicts back.
    """
    measured = written(features(docs), "quality_rows")
    kept = judged(measured, thresholds(measured)).filter("q_kept")
    return kept.select(*(F.col(f"`{name}`") for name in docs.columns))
