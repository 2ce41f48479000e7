"""Occurrence counts of terms and their margins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def term_freq(exploded: DataFrame) -> DataFrame:
    """Occurrences per (category, term).

    The key holds both columns, so one frequent term or one large category is
    combined in each task first and then spread over the shuffle.
    """
    return exploded.groupBy("category", "term").agg(F.count(F.lit(1)).alias("freq_ct"))


def term_totals(freq: DataFrame) -> DataFrame:
    """Occurrences per term over all categories."""
    return freq.groupBy("term").agg(F.sum("freq_ct").alias("term_total"))


def category_totals(freq: DataFrame) -> DataFrame:
    """Occurrences per category over all terms."""
    return freq.groupBy("category").agg(F.sum("freq_ct").alias("category_total"))


def grand_total(freq: DataFrame) -> DataFrame:
    """All occurrences, one row."""
    return freq.agg(F.sum("freq_ct").alias("grand_total"))


def all_margins(freq: DataFrame) -> DataFrame:
    """Pair counts and all three margins in one grouping-sets aggregate.

    `level` is 0 for pairs, 1 for categories, 2 for terms and 3 for the grand
    total. It runs on counted pairs, so the four-fold expansion is of those
    and not of the occurrences.
    """
    sets = [["category", "term"], ["category"], ["term"], []]
    return freq.groupingSets(sets, "category", "term").agg(
        F.sum("freq_ct").alias("n"), F.grouping_id().cast("int").alias("level")
    )


def distinct_terms(freq: DataFrame) -> DataFrame:
    """The scored terms."""
    return freq.select("term").distinct()


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def corpus_counts(with_terms: DataFrame) -> DataFrame:
    """Per term: occurrences `n` and number of rows that hold it, `df`.

    Each Arrow batch of rows gives its different terms with their counts, and
    these are added up by one shuffle, by term. So a term is looked up in the
    small dictionary of its batch, and not each occurrence in the aggregate's
    table of a whole task's terms. Each batch also adds one null term for its
    rows, so the null term's counts are the number of rows and the texts need
    not be read again for it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch_counts(batch.column(0))

    counted = with_terms.select("terms").mapInArrow(run, "term string, n long, df long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _batch_counts(bags: pa.Array) -> pa.RecordBatch:
    """The different terms of some rows: occurrences and rows that hold them; the null term has the number of rows."""
    flat, row = bags.flatten(), pc.list_parent_indices(bags)
    if flat.null_count:
        flat, row = flat.drop_null(), row.filter(flat.is_valid())
    coded = flat.dictionary_encode()
    code, size = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    pairs = row.to_numpy() * size + code
    pairs.sort()
    first = np.ones(len(pairs), bool)
    first[1:] = pairs[1:] != pairs[:-1]
    n = np.bincount(code, minlength=size)
    df = np.bincount(pairs[first] % size, minlength=size) if size else n
    term = pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.nulls(1, pa.string())])
    columns = [term, *(pa.array(np.append(one, len(bags)), pa.int64()) for one in (n, df))]
    return pa.RecordBatch.from_arrays(columns, ["term", "n", "df"])


def document_freq(corpus: DataFrame) -> DataFrame:
    """The terms of a `corpus_counts` table."""
    return corpus.filter(F.col("term").isNotNull())


def document_count(corpus: DataFrame) -> DataFrame:
    """The number of rows behind a `corpus_counts` table, one row."""
    return corpus.filter(F.col("term").isNull()).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("documents"))
