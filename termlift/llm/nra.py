"""Ranked lexical search by NRA: impact-sorted lists are read in order, with score intervals per document.

The documents are indexed once, in blocks: a block holds its documents' lengths
and, for every term that some item asks for, the documents with that term. Counts
over all blocks (documents, terms, document frequencies) then fix every term's
weight and every posting's impact. In each block and for each item, the lists of
the item's terms, sorted by falling impact, are read sequentially in growing
steps. What was read bounds each document's score from below; the impacts at
which the lists stand bound what it may still gain. Reading ends when no document
that is unseen or open can reach the k-th lower bound, not even to tie with it,
and the score of every document that can is final. So a block's best documents
are exact, and the best of all blocks are the best of all.

Blocks are bounded by text and by documents, items are taken in parts of bounded
size, and only k rows of a block and item leave a task.

Defined results: null and empty texts have no term, neither documents nor items;
items with no term that occurs have no row; repeated rows of `documents` are
documents of their own, a null id sorts behind all others; rows of items with an
equal id ask for the union of their terms; terms of weight 0 add nothing; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from termlift.llm.bpe import texts_as_bytes
from termlift.plans.scale import written

BEST = 50
# A block ends with the first of these, and its lists are read in steps that double from FIRST_STEP on.
BLOCK_DOCUMENTS = 1 << 14
BLOCK_BYTES = 64 << 20
FIRST_STEP = 256
# Items are taken in parts of about this many bytes; their terms go to every task.
PART_BYTES = 4 << 20
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_TO_TERMS = bytes.maketrans(
    bytes(code for code in range(128) if not chr(code).isalnum()), b" " * sum(not chr(code).isalnum() for code in range(128))
)


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all characters beyond ASCII; A-Z lower-cased."""
    return text.lower().translate(_TO_TERMS).split()


def _sql_terms(text: str) -> Column:
    lower = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, BETWEEN), lambda term: term != "")


def item_parts(items: DataFrame, item: str, text: str, part_bytes: int) -> Iterator[list[tuple[object, list[str]]]]:
    """The items with their distinct terms, in parts that are each small enough for the driver and every task."""
    asked = items.select(F.col(item).alias("item"), F.explode(_sql_terms(text)).alias("term")).groupBy("item").agg(
        F.array_sort(F.collect_set("term")).alias("terms")
    )
    asked = written(asked, "search_items")
    size = asked.agg(F.sum(F.octet_length(F.array_join("terms", " ")) + 8)).first()[0] or 0
    parts = size // part_bytes + 1
    for part in range(parts):
        mine = asked.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == part) if parts > 1 else asked
        rows = [(row.item, row.terms) for row in mine.collect()]
        if rows:
            yield sorted(rows, key=lambda row: (row[0] is None, row[0]))


def index(docs: DataFrame, vocabulary: Broadcast, key: str, text: str, block_documents: int, block_bytes: int) -> DataFrame:
    """One row per block of documents: n_docs, n_terms, the documents' keys and lengths, term frequencies.

    `postings` holds (term, place of the document, occurrences), 32 bits each, by term; `held` the terms, with
    as many documents as `df` says.
    """
    rows = texts_as_bytes(docs, text, key)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        known = number.keys()
        keys, lengths, found, size, key_type = [], [], [], 0, None

        def block() -> pa.RecordBatch:
            triples = np.concatenate(found).reshape(-1, 3) if found else np.zeros((0, 3), np.uint32)
            triples = triples[np.argsort(triples[:, 0], kind="stable")]
            held, df = np.unique(triples[:, 0], return_counts=True)
            packed = zlib.compress(np.ascontiguousarray(triples.T).tobytes(), 1)
            columns = [
                pa.array([len(keys)], pa.int64()),
                pa.array([sum(lengths)], pa.int64()),
                pa.array([pa.concat_arrays(keys).to_pylist()] if keys else [[]], pa.list_(key_type)),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([packed], pa.binary()),
                pa.array([held.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([df], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, ["n_docs", "n_terms", "keys", "lengths", "postings", "held", "df"])

        for batch in batches:
            key_type = batch.schema.field(key).type
            for row, value in enumerate(batch["b_text"]):
                body = value.as_buffer()
                terms = terms_of(body.to_pybytes())
                if not terms:
                    continue
                counts = Counter(terms)
                hits = known & counts.keys()
                triples = np.empty((len(hits), 3), np.uint32)
                triples[:, 0] = [number[term] for term in hits]
                triples[:, 1] = len(keys)
                triples[:, 2] = [counts[term] for term in hits]
                found.append(triples.ravel())
                keys.append(batch[key].slice(row, 1))
                lengths.append(len(terms))
                size += body.size
                if len(keys) >= block_documents or size >= block_bytes:
                    yield block()
                    keys, lengths, found, size = [], [], [], 0
        if keys:
            yield block()

    schema = f"n_docs long, n_terms long, keys array<{kind}>, lengths array<long>, postings binary, held array<int>, df array<long>"
    return rows.mapInArrow(run, schema)


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What one occurrence list adds per unit of weight, in whole numbers."""
    m = 100 - 50 + (50 * n * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight_of(documents: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


class Lists:
    """A block's postings by term, each list by falling impact."""

    def __init__(self, row: dict, documents: int, terms: int):
        term, place, tf = np.frombuffer(zlib.decompress(row["postings"]), np.uint32).reshape(3, -1)
        lengths = np.asarray(row["lengths"], np.int64)
        gain = impacts(tf.astype(np.int64), lengths[place], documents, terms)
        order = np.lexsort((place, -gain, term))
        self.place, self.gain = place[order].astype(np.int64), gain[order]
        self.names, self.first = np.unique(term[order], return_index=True)
        self.last = np.append(self.first[1:], len(term))
        self.size = len(lengths)

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a term, best first."""
        at = np.searchsorted(self.names, term)
        if at == len(self.names) or self.names[at] != term:
            return self.place[:0], self.gain[:0]
        return self.place[self.first[at] : self.last[at]], self.gain[self.first[at] : self.last[at]]


def best_by_nra(lists: list[tuple[np.ndarray, np.ndarray]], size: int, best: int, first_step: int = FIRST_STEP) -> tuple[np.ndarray, np.ndarray]:
    """All documents that reach the `best`-th highest score, ties included, and their final scores.

    `lists` hold documents below `size` and positive scores, in falling order.
    Documents that can no longer reach the bound are dropped and the remaining
    ones renumbered, so later steps look at few.
    """
    names = np.arange(size)
    lower = np.zeros(size, np.int64)
    seen = np.zeros((len(lists), size), bool)
    lists = [(docs, scores) for docs, scores in lists]
    at, step = [0] * len(lists), first_step
    while True:
        frontier = np.zeros(len(lists), np.int64)
        for number, (docs, scores) in enumerate(lists):
            end = min(at[number] + step, len(docs))
            read = docs[at[number] : end]
            lower[read] += scores[at[number] : end]
            seen[number, read] = True
            at[number] = end
            frontier[number] = scores[end - 1] if 0 < end < len(docs) else 0
        step *= 2
        # Sums stay below 2^53, so the product in doubles is exact.
        open_gain = frontier.sum() - (frontier.astype(float) @ seen).astype(np.int64)
        upper = lower + open_gain
        bound = np.partition(lower, len(lower) - best)[len(lower) - best] if len(lower) > best else 0
        alive = (upper >= bound) & (upper > 0)
        if np.array_equal(lower[alive], upper[alive]):
            return names[alive], lower[alive]
        if alive.sum() <= len(names) // 2:
            renumbered = np.cumsum(alive) - 1
            names, lower, seen = names[alive], lower[alive], seen[:, alive]
            rest = []
            for docs, scores in ((docs[start:], scores[start:]) for (docs, scores), start in zip(lists, at)):
                stays = alive[docs]
                rest.append((renumbered[docs[stays]], scores[stays]))
            lists, at = rest, [0] * len(rest)


def _first(docs: np.ndarray, score: np.ndarray, keys: pa.Array, best: int) -> tuple[np.ndarray, np.ndarray]:
    """Of documents that tie at the bound, those of lowest key."""
    if len(docs) <= best:
        return docs, score
    table = pa.table({"score": score, "key": keys.take(pa.array(docs))})
    order = pc.sort_indices(table, sort_keys=[("score", "descending"), ("key", "ascending")], null_placement="at_end")
    chosen = order.to_numpy()[:best]
    return docs[chosen], score[chosen]


def _searched(table: DataFrame, shared: Broadcast, documents: int, terms: int, best: int, schema: str) -> DataFrame:
    """The best documents of each block for each item: item, key, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, item_type = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                block = {name: batch[name][row].as_py() for name in ("lengths", "postings")}
                keys = batch["keys"][row].values
                lists = Lists(block, documents, terms)
                names, places, scores = [], [], []
                for name, numbers, weights in items:
                    found = [(docs, gain * weight) for (docs, gain), weight in zip(map(lists.of, numbers), weights) if weight > 0 and len(docs)]
                    if found:
                        docs, score = _first(*best_by_nra(found, lists.size, best), keys, best)
                        names += [name] * len(docs)
                        places.append(docs)
                        scores.append(score)
                if names:
                    columns = [pa.array(names, item_type), keys.take(pa.array(np.concatenate(places))), pa.array(np.concatenate(scores))]
                    yield pa.RecordBatch.from_arrays(columns, ["item", "key", "score"])

    return table.select("lengths", "postings", "keys").mapInArrow(run, schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_documents: int = BLOCK_DOCUMENTS,
    block_bytes: int = BLOCK_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Each item's `best` documents of highest score above 0: item, rank, key, score."""
    spark = docs.sparkSession
    context = spark.sparkContext
    kinds = (items.schema[item].dataType, docs.schema[key].dataType)
    schema = f"item {kinds[0].simpleString()}, key {kinds[1].simpleString()}, score long"
    found = None
    for part in item_parts(items, item, item_text, part_bytes):
        words = sorted({term for _, terms in part for term in terms})
        number = {word: place for place, word in enumerate(words)}
        vocabulary = context.broadcast({word.encode(): place for word, place in number.items()})
        table = written(index(docs, vocabulary, key, text, block_documents, block_bytes), "search_index")
        documents, terms = (value or 0 for value in table.agg(F.sum("n_docs"), F.sum("n_terms")).first())
        held = table.select(F.explode(F.arrays_zip("held", "df")).alias("one")).groupBy("one.held").agg(F.sum("one.df").alias("df"))
        df = np.zeros(len(words), np.int64)
        for row in held.collect():  # a row per term of this part's items at most
            df[row.held] = row.df
        weights = weight_of(documents, df)
        numbered = [(name, [number[term] for term in asked]) for name, asked in part]
        asked = [(name, numbers, weights[numbers].tolist()) for name, numbers in numbered]
        shared = context.broadcast((asked, to_arrow_type(kinds[0])))
        one = _searched(table, shared, documents, terms, best, schema)
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = spark.createDataFrame([], schema)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")

