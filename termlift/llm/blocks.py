"""Blocks of documents: rows of some megabytes of text, on which numpy can work at once.

A block is the unit that asks: it sends each bucket of keys the distinct keys it
holds, and gets one answer for each. So the traffic of a key is bounded by the
number of blocks, however often it occurs, and nothing else is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from termlift.plans.scale import written

BLOCK_BYTES = 8 << 20
CODEC = "zstd"


def squeezed(values: bytes | np.ndarray) -> bytes:
    """Compressed bytes, led by their length."""
    raw = values if isinstance(values, bytes) else np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=CODEC, asbytes=True)


def unsqueezed(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec=CODEC, asbytes=True)


def squeezed_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys, as compressed differences."""
    return squeezed(np.diff(keys, prepend=np.uint64(0)))


def unsqueezed_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(unsqueezed(blob), np.uint64))


def binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def loosened(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere, as Python functions return it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(field.name, loosened(field.dataType)) for field in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(loosened(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, loosened(kind.valueType))
    return kind


def text_blocks(rows: DataFrame, key: str, name: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Gather rows of `key` and `b_text` into a written table of blocks: block, keys, sizes, body.

    Blocks are cut where the rows lie, without a shuffle. Their numbers are only
    fixed by writing them, so whoever uses them reads that table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, held = [], [], 0
        for batch in batches:
            for one, value in zip(batch[key].to_pylist(), batch["b_text"]):
                text = value.as_buffer().to_pybytes()
                if held and held + len(text) > block_bytes:
                    yield made(keys, texts)
                    keys, texts, held = [], [], 0
                keys.append(one)
                texts.append(text)
                held += len(text)
        if keys:
            yield made(keys, texts)

    def made(keys: list, texts: list[bytes]) -> pa.RecordBatch:
        sizes = pa.array([[len(text) for text in texts]], pa.list_(pa.int64()))
        columns = [pa.array([keys], pa.list_(kind)), sizes, binary([squeezed(b"".join(texts))])]
        return pa.RecordBatch.from_arrays(columns, ["keys", "sizes", "body"])

    made_of = loosened(rows.schema[key].dataType)
    kind = to_arrow_type(made_of)
    schema = T.StructType.fromDDL("sizes array<long>, body binary")
    packed = rows.mapInArrow(run, T.StructType([T.StructField("keys", T.ArrayType(made_of)), *schema]))
    return written(packed.select(F.monotonically_increasing_id().alias("block"), "*"), name)


def texts_of(sizes: list[int], body: bytes) -> list[bytes]:
    """The texts of a block."""
    text = unsqueezed(body)
    ends = np.cumsum([0, *sizes]).tolist()
    return [text[start:end] for start, end in zip(ends, ends[1:])]
