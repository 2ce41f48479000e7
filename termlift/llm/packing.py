"""Packing of encoded documents into sequences by first-fit decreasing.

Each document's ids and one end id are cut into full sequences and a rest. All
pieces are dealt to groups by a hash of their document, so that each group is a
random part of the corpus of a bounded expected size; groups are packed
independently, the longest pieces first, each into the first sequence with room.
A tournament tree over the sequences' free room finds that one in as many steps
as the tree is high. Pieces with no rest fill a sequence alone.

Only piece descriptions are shuffled, never ids.

Defined results: a null text is empty and gives the end id alone; repeated rows
are packed each; ties in length go by key, start and checksum; an empty table
gives no sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlift.llm.bpe import texts_as_bytes, vocabulary
from termlift.plans.scale import written

SEQUENCE = 2048
END_ID = 1
# Expected pieces of a group: enough to leave under a percent of padding, little enough for one task.
GROUP_PIECES = 16_384
SEQUENCE_BITS = 32


def pieces(docs: DataFrame, definition: str, key: str = "doc_id", text: str = "text", capacity: int = SEQUENCE) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    names = [key, "start", "length", "ids_crc32", "doc_tokens"]
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(shared.value)
        for batch in batches:
            rows, starts, sums, sizes = [], [], [], []
            for row, value in enumerate(batch["b_text"]):
                ids = vocab.encode(value.as_buffer().to_pybytes()) + end
                for start in range(0, len(ids), 4 * capacity):
                    rows.append(row)
                    starts.append(start // 4)
                    sums.append(zlib.crc32(ids[start : start + 4 * capacity]))
                    sizes.append(len(ids) // 4)
            total, first = np.array(sizes, np.int64), np.array(starts, np.int64)
            columns = [batch[key].take(pa.array(rows, pa.int64())), first, np.minimum(capacity, total - first), sums, total]
            typed = [columns[0], *(pa.array(column, pa.int64()) for column in columns[1:])]
            yield pa.RecordBatch.from_arrays(typed, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return texts_as_bytes(docs, text, key).mapInArrow(run, schema)


def first_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """The bin and the offset in it of every size, in the given order; each goes to the first bin with room.

    `tree` is a tournament over the bins' free room: a node holds the larger of
    its two halves, so the first bin with room is reached by going left where
    the left half has enough.
    """
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - tree[node])
        tree[node] -= size
        while node > 1:
            node //= 2
            left, right = tree[2 * node], tree[2 * node + 1]
            most = left if left >= right else right
            if tree[node] == most:
                break
            tree[node] = most
    return bins, offsets


def packed(made: DataFrame, key: str = "doc_id", capacity: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Append `sequence_id` and `offset` to every piece of a written table."""
    groups = max(1, -(-made.count() // group_pieces))
    spread = F.pmod(F.xxhash64(F.col(key), "start", "ids_crc32"), F.lit(groups)).cast("int").alias("pack_group")
    order = [key, "start", "ids_crc32"]

    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values(["length", *order], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        bins, offsets = first_fit(ordered["length"].tolist(), capacity)
        ordered["sequence_id"] = (int(group[0]) << SEQUENCE_BITS) + np.array(bins, np.int64)
        ordered["offset"] = np.array(offsets, np.int64)
        return ordered.drop(columns="pack_group")

    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in made.schema)
    schema = f"{kinds}, sequence_id long, `offset` long"
    return made.select("*", spread).groupBy("pack_group").applyInPandas(run, schema)


def pack(docs: DataFrame, definition: str, key: str = "doc_id", text: str = "text", capacity: int = SEQUENCE) -> DataFrame:
    """Where each piece of each document lies."""
    return packed(written(pieces(docs, definition, key, text, capacity), "pieces"), key, capacity)
