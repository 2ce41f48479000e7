"""Exact histogram of encoded lengths, and the answers its suffix sums give for every context limit.

Only the length of each document leaves the encoding task. Documents of equal
length are counted before the shuffle. Sums over all greater lengths are taken in
two levels: inside blocks of neighbouring lengths, and over the blocks, so no
window holds more than a block or the list of blocks.

Defined results: null and empty texts have length 0 and are counted; repeated
rows count each; an empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termlift.llm.bpe import texts_as_bytes, vocabulary
from termlift.plans.scale import written

BLOCK = 1024


def lengths(docs: DataFrame, definition: str, text: str = "text") -> DataFrame:
    """The encoded length of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(shared.value)
        for batch in batches:
            sizes = [len(vocab.encode(value.as_buffer().to_pybytes())) // 4 for value in batch["b_text"]]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n_tokens"])

    return texts_as_bytes(docs, text).mapInArrow(run, "n_tokens long")


def histogram(sizes: DataFrame) -> DataFrame:
    """Documents of every length that occurs: n_tokens, docs."""
    return sizes.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """Append, for each length L: docs and tokens of documents of L tokens and more, and of all when cut to L.

    `truncated_total` is the number of tokens left when every document is cut to
    L; `share_within` is the share of documents of at most L tokens, that is, the
    quantile of which L is the value.
    """
    counted = counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    blocks = counted.groupBy("block").agg(F.sum("docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = blocks.select(
        "block",
        *(F.coalesce(F.sum(f"b_{name}").over(above), F.lit(0)).alias(f"later_{name}") for name in ("docs", "tokens")),
        *(F.sum(f"b_{name}").over(over).alias(f"all_{name}") for name in ("docs", "tokens")),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = counted.select("*", *(F.sum(name).over(inside).alias(f"in_{name}") for name in ("docs", "tokens")))
    total = local.join(later, "block").withColumn("docs_from", F.col("in_docs") + F.col("later_docs"))
    total = total.withColumn("tokens_from", F.col("in_tokens") + F.col("later_tokens"))
    below = F.col("all_tokens") - F.col("tokens_from")
    within = F.col("all_docs") - F.col("docs_from") + F.col("docs")
    return total.select(
        "n_tokens",
        "docs",
        "docs_from",
        "tokens_from",
        (below + F.col("n_tokens") * F.col("docs_from")).alias("truncated_total"),
        (within / F.col("all_docs")).alias("share_within"),
    )


def token_counts(docs: DataFrame, definition: str, text: str = "text") -> DataFrame:
    """The histogram with its suffix sums."""
    return suffix_sums(written(histogram(lengths(docs, definition, text)), "token_lengths"))


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """Tokens left when every document is cut to `limit`, from the table of suffix sums, for any limit."""
    longer = F.col("n_tokens") >= limit
    first = F.min_by(F.struct("n_tokens", "docs_from", "truncated_total"), F.when(longer, F.col("n_tokens")))
    picked = sums.agg(first.alias("at"), F.max("truncated_total").alias("all"))
    cut = F.col("at.truncated_total") - (F.col("at.n_tokens") - limit) * F.col("at.docs_from")
    return picked.select(F.coalesce(cut, F.col("all"), F.lit(0)).alias("truncated_total"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least `share` of the documents do not exceed."""
    return sums.filter(F.col("share_within") >= share).agg(F.min("n_tokens").alias("n_tokens"))
