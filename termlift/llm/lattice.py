"""Near-duplicate embeddings by lattice hashing.

A random projection to eight dimensions, scaled and decoded to the nearest point
of the E8 lattice, hashes a vector; TABLES independent projections give as many
tables. Close vectors fall in equal or touching cells, so each vector is stored
in its own cell and also looks into the nearest of the 240 touching ones. Vectors
of one label that meet in a cell are compared by cosine in double precision.

Equal vectors are one class: they are hashed once, and counts of links multiply
by the size of a class. Classes of a label are dealt into blocks of a few megabytes,
each with its cells, and blocks into chunks. Every two chunks of a label are compared
inside one task, which looks up cells, compares vectors and counts links there; no
pair leaves it, only counts and one link to the smallest member of what it connects.
Rounds pair the chunks as in a tournament, so that a round shuffles a block once.

Projections come from a fixed seed and are the same in every task. A pair at the
threshold of 0.93 is missed with a probability of a few in a thousand, closer
pairs less; the tests measure recall against all pairs.

Defined results: null labels, null or zero vectors and vectors with null or
non-finite components link with nothing; vectors of different lengths link with
nothing; repeated rows are vectors of their own, which link with each other (an
id stands for one vector); an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from termlift.llm.components import components
from termlift.plans.scale import checked_broadcast, delete_scratch, scratch_path, written

THRESHOLD = 0.93
TABLES = 8
PROBES = 12
# Width of a lattice unit: a pair at the threshold is about half as far apart, in each projected direction.
WIDTH = 1.1
SEED = 20_240_117

# Bytes of a block of classes, and blocks of a chunk. A task holds two chunks.
BLOCK_BYTES = 2 * 1024 * 1024
CHUNK_BLOCKS = 16
ROW_GROUP_BYTES = 16 * 1024 * 1024
# Partitions of a shuffle of blocks, at most.
PARTITIONS = 2000
# Pairs of a task that are looked at together, vectors that look up others together, and slots (as a power of two) of cells.
BATCH = 1 << 15
LOOKERS = 1 << 13
SLOT_BITS = 18
# Components count as large from about this many standard deviations on; large ones of unlike sign keep vectors apart.
# They are counted in the vectors as they stand and turned in so many ways.
LARGE = 0.75
TURNS = 3


@functools.cache
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8, which lead to the touching cells."""
    pairs = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            root = np.zeros(8)
            root[[i, j]] = a, b
            pairs.append(root)
    halves = [np.array(signs) for signs in itertools.product((0.5, -0.5), repeat=8) if sum(s < 0 for s in signs) % 2 == 0]
    return np.array(pairs + halves)


def _nearest_d8(points: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: where it is odd, the worst coordinate is rounded the other way."""
    rounded = np.rint(points)
    error = points - rounded
    odd = np.flatnonzero(rounded.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(error[odd]).argmax(axis=1)
    rounded[odd, worst] += np.where(error[odd, worst] >= 0, 1.0, -1.0)
    return rounded


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: E8 is D8 and its copy shifted by one half."""
    whole, half = _nearest_d8(points), _nearest_d8(points - 0.5) + 0.5
    closer = ((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


@functools.lru_cache(maxsize=8)
def projections(length: int, tables: int) -> np.ndarray:
    """`tables` matrices of Gaussian entries, from `length` to eight dimensions."""
    return np.random.default_rng([SEED, length]).standard_normal((tables, length, 8))


@functools.cache
def _factors() -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 1 << 32, 8)


def names(points: np.ndarray) -> np.ndarray:
    """A 32-bit name of each lattice point. It is linear: a neighbour's name is the point's plus the root's."""
    return ((2 * points).astype(np.int64) @ _factors() & 0xFFFFFFFF).astype(np.uint32)


@functools.cache
def _steps() -> np.ndarray:
    return names(roots())


@functools.cache
def _root_names() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The names of the roots in order, which root each is, and the opposite of each root."""
    order = np.argsort(_steps())
    ordered = _steps()[order]
    return ordered, order, order[np.searchsorted(ordered, names(-roots()))]


@functools.cache
def _halves() -> tuple[np.ndarray, np.ndarray]:
    """One of each two opposite roots, and the other one."""
    opposite = _root_names()[2]
    some = np.flatnonzero(np.arange(len(opposite)) < opposite)
    return some, opposite[some]


def _nearest_roots(error: np.ndarray, probes: int) -> np.ndarray:
    """The roots that lead to the cells nearest to points at `error` from the centre of their own: the largest products."""
    some, opposite = _halves()
    along = error @ roots()[some].T
    size = np.abs(along)
    # Of opposite roots, one has a positive product and the other its negative, so the largest are found among half of them.
    least = np.partition(size, -probes, axis=1)[:, -probes] if probes <= len(some) else np.zeros(len(size))
    row, column = np.nonzero(size >= least[:, None])
    if len(column) != len(size) * probes or not least.all():  # ties
        return np.argpartition(-(error @ roots().T), probes, axis=1)[:, :probes]
    return np.where(along[row, column] > 0, some[column], opposite[column]).reshape(-1, probes)


def cells(vectors: np.ndarray, tables: int, probes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Of unit vectors, the names of their own cells as (tables, rows), and the roots that lead to the cells they look into as (tables, rows, probes)."""
    own = np.empty((tables, len(vectors)), np.uint32)
    near = np.empty((tables, len(vectors), probes), np.uint8)
    for start in range(0, len(vectors), 1024):
        some = slice(start, start + 1024)
        for number, matrix in enumerate(projections(vectors.shape[1], tables)):
            points = vectors[some] @ matrix / width
            centre = nearest_e8(points)
            own[number, some] = names(centre)
            near[number, some] = _nearest_roots(points - centre, probes)
    return own, near


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Each row divided by its largest component, then by its length, so neither overflows nor vanishes."""
    scaled = vectors.astype(np.float64)
    scaled /= np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


@functools.lru_cache(maxsize=8)
def _turn(length: int, number: int) -> np.ndarray:
    """A fixed random rotation."""
    return np.linalg.qr(np.random.default_rng([SEED, length, number]).standard_normal((length, length)))[0].astype(np.float32)


def _unlike_at_most(length: int, threshold: float) -> tuple[int, float]:
    """In how many components two unit vectors at the threshold may be large with unlike signs, and from where on they are large.

    Each is twice that value apart, so one more would make the squared distance too large.
    """
    distance = max(0.0, 2 - 2 * threshold) + 1e-4
    most = max(1, round(distance * length / (4 * LARGE**2))) - 1
    return most, 1.00001 * np.sqrt(distance / (4 * (most + 1)))


def _signs(unit: np.ndarray, least: float) -> list[np.ndarray]:
    """Where components are large and positive, and where large and negative, as pairs of 64-bit words: as the vectors stand, then turned."""
    length, words, made = unit.shape[1], -(-unit.shape[1] // 64), []
    for number in range(1 + TURNS):
        values = unit @ _turn(length, number) if number else unit
        masks = np.zeros((len(unit), 2, 8 * words), np.uint8)
        for side, large in enumerate((values >= np.float32(least), values <= -np.float32(least))):
            masks[:, side, : -(-length // 8)] = np.packbits(large, axis=1)
        # One item of 16 bytes a vector, which is fetched at once.
        made += [np.ascontiguousarray(masks.view(np.uint64)[:, :, word]).view(np.complex128)[:, 0] for word in range(words)]
    return made


@dataclass
class Chunk:
    """Classes of vectors of one length, with their cells."""

    reps: pa.Array
    copies: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    own: np.ndarray
    near: np.ndarray
    threshold: float

    def __post_init__(self) -> None:
        self.unit = np.empty(self.vectors.shape, np.float32)
        self.most, least = _unlike_at_most(self.unit.shape[1], self.threshold)
        signs = []
        for start in range(0, len(self), 4096):
            some = slice(start, start + 4096)
            scaled = (self.vectors[some] / np.abs(self.vectors[some]).max(axis=1, keepdims=True)).astype(np.float32)
            self.unit[some] = scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
            signs.append(_signs(self.unit[some], least))
        self.signs = [np.concatenate(column) for column in zip(*signs)]

    def __len__(self) -> int:
        return len(self.labels)


def _meet(one: Chunk, other: Chunk, x: np.ndarray, y: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether `x` of `one` looks into the cell of `y` of `other`, and whether `y` looks into that of `x`."""
    ordered, order, opposite = _root_names()
    away = other.own[table][y] - one.own[table][x]
    same = away == 0
    at = np.minimum(np.searchsorted(ordered, away), len(ordered) - 1)
    touch, root = ordered[at] == away, order[at]
    return same | touch & _has(one.near[table], x, root), same | touch & _has(other.near[table], y, opposite[root])


def _has(near: np.ndarray, row: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Whether each row of `near` has a root."""
    hits = near.take(row, axis=0) == root.astype(np.uint8)[:, None]
    # Four columns at a time, where that comes out even.
    hits = hits.view(np.uint32) if hits.shape[1] % 4 == 0 else hits
    return functools.reduce(np.bitwise_or, hits.T) != 0


def _close(one: Chunk, other: Chunk, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the cosine of each pair, in double precision, reaches the threshold."""
    length, threshold = one.unit.shape[1], one.threshold
    error = 2.0**-22 * (length + 8)
    close = np.zeros(len(x), bool)
    for start in range(0, len(x), 512):
        some = slice(start, start + 512)
        near = np.einsum("ij,ij->i", one.unit[x[some]], other.unit[y[some]])
        close[some] = near >= threshold
        open_ = start + np.flatnonzero(np.abs(near - threshold) <= error)
        if len(open_):
            products = unit_rows(one.vectors[x[open_]]) * unit_rows(other.vectors[y[open_]])
            # Added one by one, from the first component on.
            close[open_] = np.cumsum(products, axis=1)[:, -1] >= threshold
    return close


def _unlike(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """In how many components the pairs are large with unlike signs."""
    a, b = mine.view(np.uint64).reshape(-1, 2), theirs.view(np.uint64).reshape(-1, 2)
    return np.bitwise_count((a[:, 0] & b[:, 1]) | (a[:, 1] & b[:, 0]))


def _by_rank(count: np.ndarray) -> Iterator[tuple[slice, np.ndarray | int]]:
    """Every item of rows that have `count` of them, in descending order: which rows, and the number of each one's item.

    The first items of all rows come first, then the second ones of all that have two,
    and so on; where few rows are left, all their further items follow.
    """
    rank, left = 0, len(count)
    while left:
        if left < 2048 and count[0] > rank + 1:
            low = 0
            while low < left:
                high = min(left, low + max(1, BATCH // int(count[low] - rank)))
                some = count[low:high] - rank
                for start in range(0, int(some[0]), BATCH):
                    part = np.minimum(some - start, BATCH)
                    ends = np.cumsum(part)
                    yield np.repeat(np.arange(low, high), part), rank + start + np.arange(ends[-1]) - np.repeat(ends - part, part)
                low = high
            return
        for low in range(0, left, BATCH):
            yield slice(low, min(left, low + BATCH)), rank
        rank += 1
        left = left - int(np.searchsorted(count[:left][::-1], rank, "right"))


def _candidates(one: Chunk, other: Chunk, table: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (x, y) where `x` of `one` looks into the cell of `y` of `other`, but for many that are too far apart; few that do not meet are among them."""
    shift = np.uint32(32 - SLOT_BITS)
    stored = other.own[table] >> shift
    order = np.argsort(stored, kind="stable")
    many = np.bincount(stored, minlength=1 << SLOT_BITS)
    first = (np.cumsum(many) - many).astype(np.int32)
    # Their ranks fit 16 bits unless a chunk has more vectors than that; then sorting takes longer.
    many = many.astype(np.uint16 if many.max() < 1 << 16 else np.int64)
    signs = other.signs[0][order]
    by_cell = np.argsort(one.own[table])
    for start in range(0, len(one), LOOKERS):
        # Some neighbouring cells at a time, root by root, so that what is looked up lies close together.
        lookers = by_cell[start : start + LOOKERS]
        own, near = one.own[table][lookers], one.near[table].take(lookers, axis=0)
        looks = np.argsort(near.ravel(), kind="stable")
        row = looks // near.shape[1]
        slots = np.concatenate([own, own[row] + _steps()[near.ravel()[looks]]]) >> shift
        count = many[slots]
        found = np.argsort(count, kind="stable")[::-1][: np.count_nonzero(count)]
        rows = np.concatenate([lookers, lookers[row]])[found]
        count, starts, mine = count[found].astype(np.int64), first[slots[found]].astype(np.int64), one.signs[0][rows]
        for some, rank in _by_rank(count):
            at = starts[some] + rank
            left = np.flatnonzero(_unlike(mine[some], signs.take(at)) <= one.most)
            yield rows[some][left], order[at[left]]


def _not_far(one: Chunk, other: Chunk, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs but for most of those that are too far apart."""
    words = len(one.signs) // (1 + TURNS)
    for first in range(0 if words > 1 else 1, len(one.signs), words):
        unlike = np.zeros(len(x), np.uint16)
        for number in range(first, first + words):
            unlike += _unlike(one.signs[number].take(x), other.signs[number].take(y))
        left = np.flatnonzero(unlike <= one.most)
        x, y = x[left], y[left]
    return x, y


def _gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs in fewer, larger arrays."""
    held, many = [], 0
    for pair in itertools.chain(pairs, [None]):
        if pair is not None:
            held.append(pair)
            many += len(pair[0])
        if held and (pair is None or many >= BATCH):
            yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])
            held, many = [], 0


def links_between(one: Chunk, other: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every linked pair of a vector of `one` and another of `other`, each once: in the first table where they meet."""
    for table in range(len(one.own)):
        for a, b in ((one, other),) if one is other else ((one, other), (other, one)):
            near = (_not_far(a, b, x, y) for x, y in _gathered(_candidates(a, b, table)))
            for x, y in _gathered(near):
                left = a.labels[x] == b.labels[y]
                if one is other:
                    left &= x != y
                for former in range(table):
                    left &= a.own[former][x] != b.own[former][y]
                x, y = x[left], y[left]
                forth, back = _meet(a, b, x, y, table)
                # A pair that meets from both sides counts from one of them: from the smaller row, or from `one`.
                left = forth & ~(back & (x > y)) if one is other else forth & ~(back & (a is other))
                x, y = x[left], y[left]
                left = _close(a, b, x, y)
                x, y = x[left], y[left]
                for former in range(table):
                    forth, back = _meet(a, b, x, y, former)
                    x, y = x[~(forth | back)], y[~(forth | back)]
                if len(x):
                    yield (x, y) if a is one else (y, x)


def _unite(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a and b: each row of `low` has the smallest row of its set."""
    while True:
        a, b = low[a], low[b]
        differ = a != b
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(further := low[low], low):
            low[:] = further


def _linked(parts: list[Chunk], alone: bool) -> pa.Table:
    """Of one or two chunks, the rows that link between them and, if `alone`, inside: rep, how many rows of the input each links with, and the first row it reaches."""
    copies = np.concatenate([part.copies for part in parts])
    starts = np.cumsum([0, *map(len, parts)])
    low, total = np.arange(len(copies)), np.zeros(len(copies), np.int64)
    pairs = [(i, i) for i in range(len(parts))] if alone else []
    for i, j in pairs + ([(0, 1)] if len(parts) == 2 else []):
        for x, y in _gathered(links_between(parts[i], parts[j])):
            a, b = x + starts[i], y + starts[j]
            np.add.at(total, a, copies[b])
            np.add.at(total, b, copies[a])
            _unite(low, a, b)
    found = np.flatnonzero(total)
    reps = pa.concat_arrays([part.reps for part in parts])
    return pa.table({"rep": reps.take(pa.array(found)), "n": pa.array(total[found]), "first": reps.take(pa.array(low[found]))})


def _vector_type(vectors: DataFrame, vector: str) -> str:
    """Single precision stays as it is; all else is compared as doubles."""
    kind = vectors.schema[vector].dataType
    return "array<float>" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "array<double>"


def described(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """Each row's key and label, the digest of its vector (null where it cannot be compared), its length and its components' bytes."""
    size = 4 if _vector_type(vectors, vector) == "array<float>" else 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["e_vec"]
            full = pc.and_(pc.and_(batch["key"].is_valid(), batch["e_label"].is_valid()), lists.is_valid())
            sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            ends = np.cumsum(sizes)
            kind = np.float32 if size == 4 else np.float64
            # Nulls become NaN, and adding zero turns a negative zero into a positive one, so equal vectors have equal bytes.
            flat = np.asarray(pc.fill_null(lists.flatten(), float("nan")), kind) + kind(0)
            inner, some = np.concatenate([[0], np.cumsum(~np.isfinite(flat))]), np.concatenate([[0], np.cumsum(flat != 0)])
            usable = np.asarray(full) & (inner[ends] == inner[ends - sizes]) & (some[ends] > some[ends - sizes])
            body, ends = memoryview(flat.tobytes()), ends * size
            raw = [bytes(body[end - size * n : end]) if ok else None for ok, end, n in zip(usable.tolist(), ends.tolist(), sizes.tolist())]
            digests = [hashlib.md5(value).digest() if value is not None else None for value in raw]
            columns = [batch["key"], batch["e_label"], pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "e_label", "digest", "length", "raw"])

    kinds = ", ".join(f"{name} {vectors.schema[column].dataType.simpleString()}" for name, column in (("key", key), ("e_label", label)))
    chosen = vectors.select(F.col(key).alias("key"), F.col(label).alias("e_label"), F.col(vector).cast(_vector_type(vectors, vector)).alias("e_vec"))
    return chosen.mapInArrow(run, f"{kinds}, digest binary, length int, raw binary")


def _packed(size: int, kind: T.DataType, tables: int, probes: int, width: float) -> tuple[Callable[[pa.Table], pa.Table], T.StructType]:
    """A block's classes as one row for each length of vectors."""
    schema = T.StructType.fromDDL("family long, chunk int, chunks int, length int, reps array<int>, copies binary, labels binary, vectors binary, own binary, near binary")
    schema["reps"].dataType = T.ArrayType(kind)
    arrow = to_arrow_schema(schema)

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        lengths, made = group["length"].to_numpy(), []
        for length in np.unique(lengths):
            part = group.filter(pa.array(lengths == length)).combine_chunks()
            raw = b"".join(part["raw"].to_pylist())
            vectors = np.frombuffer(raw, np.float32 if size == 4 else np.float64).reshape(-1, length)
            own, near = cells(unit_rows(vectors), tables, probes, width)
            whole = [part[name][0].as_py() for name in ("family", "chunk", "chunks")]
            arrays = [part[name].combine_chunks().to_numpy().tobytes() for name in ("copies", "name")]
            made.append([*whole, int(length), part["rep"].to_pylist(), *arrays, raw, own.tobytes(), near.tobytes()])
        return pa.Table.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*made), arrow)], schema=arrow)

    return run, schema


def _as_chunk(group: pa.Table, chosen: np.ndarray, size: int, tables: int, probes: int, threshold: float) -> Chunk:
    """The chunk that some rows of blocks make up. Their bytes are read where they are."""

    def values(name: str, kind: type, *shape: int) -> list[np.ndarray]:
        column = group[name]
        return [np.frombuffer(column[row].as_buffer(), kind).reshape(*shape) for row in chosen.tolist()]

    length = group["length"][0].as_py()
    vectors = np.concatenate(values("vectors", np.float32 if size == 4 else np.float64, -1, length))
    reps = pa.concat_arrays([group["reps"][row].values for row in chosen.tolist()])
    copies, labels = (np.concatenate(values(name, np.int64, -1)) for name in ("copies", "labels"))
    own = np.concatenate(values("own", np.uint32, tables, -1), axis=1)
    near = np.concatenate(values("near", np.uint8, tables, -1, probes), axis=1)
    return Chunk(reps, copies, labels, vectors, own, near, threshold)


def _freed(spark: SparkSession) -> None:
    """Spark deletes a shuffle's files once nothing in the driver refers to it, which it notices when it collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _written_blocks(vectors: DataFrame, key: str, vector: str, label: str, tables: int, probes: int, width: float, block_bytes: int, chunk_blocks: int) -> tuple[str, int, int]:
    """Write the classes in blocks; the path, the most chunks that a label has, and the number of all chunks."""
    spark = vectors.sparkSession
    size = 4 if _vector_type(vectors, vector) == "array<float>" else 8
    counts = vectors.groupBy(F.col(label).alias("e_label"), F.size(vector).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    weight = F.col("n") * (F.col("length") * size + tables * (4 + probes) + 32)
    counts = written(counts.filter("e_label IS NOT NULL AND length > 0").withColumn("weight", weight), "vector_counts")
    # Small groups share blocks; others have blocks of their own, some of them a chunk.
    is_large = F.col("weight") > block_bytes // 2
    blocks = F.ceil(F.col("weight") / block_bytes)
    large = written(counts.filter(is_large).select("e_label", "length", blocks.cast("int").alias("blocks"), F.ceil(blocks / chunk_blocks).cast("int").alias("chunks")), "vector_groups")
    rest = counts.filter(~is_large).agg(F.sum("weight")).first()[0] or 0
    shared = -(-2 * rest // block_bytes)
    sizes = large.agg(F.max("chunks"), F.sum("chunks"), F.sum("blocks")).first()
    most, chunks, many = (sizes[0] or 1, (sizes[1] or 0) + shared, (sizes[2] or 0) + shared)

    group = F.xxhash64("e_label", "length")
    usable = described(vectors, key, vector, label).filter("digest IS NOT NULL").join(checked_broadcast(large), ["e_label", "length"], "left")
    placed = usable.select(
        F.when(F.col("blocks").isNull(), F.pmod(group, F.lit(max(1, shared)))).otherwise(group).alias("family"),
        F.coalesce(F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"), F.lit(0)).alias("block"),
        F.coalesce("blocks", F.lit(1)).alias("blocks"),
        F.coalesce("chunks", F.lit(1)).alias("chunks"),
        "e_label", "length", "digest", "key", "raw",
    )
    chunk = F.floor(F.col("block") * F.col("chunks") / F.col("blocks")).cast("int").alias("chunk")
    placed = placed.select("family", "block", chunk, "chunks", F.xxhash64("e_label").alias("name"), "e_label", "length", "digest", "key", "raw")
    # Equal vectors fall in one block, so grouping them needs no further shuffle.
    placed = placed.repartition(max(1, min(many, PARTITIONS)), "family", "block")
    classes = placed.groupBy("family", "block", "chunk", "chunks", "name", "e_label", "length", "digest").agg(
        F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw")
    )
    run, schema = _packed(size, vectors.schema[key].dataType, tables, probes, width)
    packed = classes.select("family", "block", "chunk", "chunks", "name", "length", "rep", "copies", "raw").groupBy("family", "block").applyInArrow(run, schema)
    path = scratch_path(spark, "vector_blocks")
    # Small row groups, as a reader holds a whole one of rows that are as large as these.
    packed.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return path, most, chunks


def _meeting(blocks: DataFrame, number: int) -> DataFrame:
    """The blocks that take part in a round, with the two chunks that meet as `low` and `high`; a chunk without a partner meets itself in the first."""
    even = F.col("chunks") + F.col("chunks") % 2
    turns = even - 1
    # Chunks whose numbers add up to the round's meet; the one that would meet itself meets the last.
    other = F.pmod(F.lit(number) - F.col("chunk"), turns)
    partner = F.when(F.col("chunk") == turns, F.pmod((even / 2).cast("int") * number, turns)).when(other == F.col("chunk"), turns).otherwise(other)
    met = blocks.filter(F.lit(number) < turns).withColumn("partner", partner.cast("int"))
    met = met if number == 0 else met.filter("partner < chunks")
    met = met.withColumn("partner", F.when(F.col("partner") < F.col("chunks"), F.col("partner")).otherwise(F.col("chunk")))
    return met.withColumn("low", F.least("chunk", "partner")).withColumn("high", F.greatest("chunk", "partner")).drop("partner", "chunks")


def _round(blocks: DataFrame, number: int, partitions: int, threshold: float, size: int, tables: int, probes: int) -> str:
    """Compare the chunks that meet in a round; the path of rep, n, first."""

    def run(group: pa.Table) -> pa.Table:
        sides = group["chunk"].to_numpy()
        parts = [_as_chunk(group, np.flatnonzero(sides == side), size, tables, probes, threshold) for side in np.unique(sides)]
        return _linked(parts, number == 0)

    kind = blocks.schema["reps"].dataType.elementType.simpleString()
    met = _meeting(blocks, number).repartition(partitions, "family", "low", "high")
    found = met.groupBy("family", "length", "low", "high").applyInArrow(run, f"rep {kind}, n long, first {kind}")
    path = scratch_path(blocks.sparkSession, "vector_links")
    found.write.parquet(path)
    return path


def near_links(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    probes: int = PROBES,
    width: float = WIDTH,
    block_bytes: int = BLOCK_BYTES,
    chunk_blocks: int = CHUNK_BLOCKS,
) -> DataFrame:
    """Of each class that links with others, as a written table: rep (its smallest key), n (rows it links with), first (a rep it is connected to).

    A class may have several rows, whose `n` add up; each linked pair counts once for both.
    """
    spark = vectors.sparkSession
    size = 4 if _vector_type(vectors, vector) == "array<float>" else 8
    path, most, chunks = _written_blocks(vectors, key, vector, label, tables, probes, width, block_bytes, chunk_blocks)
    paths = []
    for number in range(most - 1 + most % 2):
        # The plan of the last job is held until another one has run; here that is the one that looks at the files.
        blocks = spark.read.parquet(path)
        _freed(spark)
        paths.append(_round(blocks, number, max(1, min(2 * chunks, PARTITIONS)), threshold, size, tables, probes))
    delete_scratch(spark, [path])
    links = spark.read.parquet(*paths)
    _freed(spark)
    return links


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", **options: float) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept. Options are those of `near_links`."""
    links = near_links(vectors, key, vector, label, **options)
    edges = links.filter("rep != first").select("rep", "first").distinct()
    linked = components(edges).withColumnRenamed("node", "rep")
    outside = links.groupBy("rep").agg(F.sum("n").alias("outside"))
    members = written(described(vectors, key, vector, label).select("key", "e_label", "digest"), "vector_members")
    usable = members.filter("digest IS NOT NULL")
    classes = usable.groupBy("e_label", "digest").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"))
    summary = classes.join(outside, "rep", "left").join(linked, "rep", "left").select(
        "e_label",
        "digest",
        (F.col("copies") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    marked = usable.join(summary, ["e_label", "digest"]).select("key", "n_links", "component_id")
    lone = members.filter("digest IS NULL").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    every = marked.unionByName(lone)
    return every.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
