"""MinHash near-duplicates by one-permutation hashing with optimal densification.

A document's shingles are hashed once; the upper bits of a hash choose one of
BINS bins, which keeps its smallest hash. An empty bin copies a full one, chosen
by a hash of the bin and the number of attempts, the same for every document
(optimal densification). Bands of ROWS neighbouring bins are bucket keys: two
documents of similarity 0.85 share none with a probability below one in a
million, of similarity 0.8 below one in ten thousand.

Documents with the same set are one class and are hashed once, so a group of
copies costs one signature. In each bucket every class is linked to the smallest
one only: a star, with as many edges as members. Each edge is confirmed on the
full sets. Where a bucket then still holds several components, its members are
compared inside a task, in chunks of bounded size, and what comes out is which
components are linked; so a star whose centre is unlike some members loses no
link between them, and no list of pairs is made. That step alone takes time that
grows with the square of a bucket that holds several components.

Sets are rebuilt from the texts where edges are confirmed; only texts of classes
that met another one in a bucket are shuffled.

Defined results: null, empty and blank texts have an empty set and link with
nothing; texts with fewer words than a shingle are one shingle; repeated rows are
copies of each other, and the smallest id stands for its component; rows with a
null id are not compared and keep a null component; an empty table gives an
empty result. Columns of the input other than id and text are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlift.llm.bpe import texts_as_bytes
from termlift.llm.components import components
from termlift.llm.shingles import mixed, shingle_set
from termlift.plans.scale import written

WIDTH = 3
PERCENT = 85
BINS = 128
ROWS = 5
BANDS = BINS // ROWS
ATTEMPTS = 2048
# Members of a bucket that a task compares with as many others, and shingles it does so for at a time.
CHUNK = 512
COLUMNS = 4096


@functools.cache
def _sources() -> np.ndarray:
    """For every attempt and bin, the bin that an empty one copies if it is full."""
    cells = np.arange(ATTEMPTS * BINS, dtype=np.uint64) + np.uint64(1)
    return (mixed(cells * np.uint64(0xD1342543DE82EF95)) % np.uint64(BINS)).astype(np.int64).reshape(ATTEMPTS, BINS)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The densified minimum of every bin, from a sorted, non-empty set."""
    bins = (shingles >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    minima = np.zeros(BINS, np.uint64)
    full = np.zeros(BINS, bool)
    minima[bins[first]] = shingles[first]
    full[bins[first]] = True
    made = minima.copy()
    empty = np.flatnonzero(~full)
    for attempt in _sources():
        if not len(empty):
            break
        source = attempt[empty]
        found = full[source]
        made[empty[found]] = minima[source[found]]
        empty = empty[~found]
    # Beyond the table of attempts, the next full bin stands in.
    order = np.flatnonzero(full)
    made[empty] = minima[order[np.searchsorted(order, empty) % len(order)]]
    return made


def band_keys(made: np.ndarray) -> np.ndarray:
    """One hash per band; the band's number is part of it."""
    bands = made[: BANDS * ROWS].reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(ROWS):
        keys = mixed(keys) + bands[:, row]
    return mixed(keys)


def described(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Each document's set size, a digest of its set (null if empty) and its band keys: key, n, digest, bands."""
    rows = texts_as_bytes(docs, text, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands = [], [], []
            for value in batch["b_text"]:
                made = shingle_set(value.as_buffer().to_pybytes(), width)
                sizes.append(len(made))
                digests.append(hashlib.md5(made.tobytes()).digest() if len(made) else None)
                bands.append(band_keys(signature(made)).view(np.int64) if len(made) else None)
            columns = [batch[key], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n", "digest", "bands"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n long, digest binary, bands array<long>")


def confirmed(
    edges: DataFrame,
    texts: DataFrame,
    set_of: Callable[[bytes], np.ndarray],
    close: Callable[[np.ndarray, np.ndarray], bool],
) -> DataFrame:
    """Edges (a, b) whose full sets are close. `texts` has rep and b_text, from which a set is made."""
    left = texts.select(F.col("rep").alias("a"), F.col("b_text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("b_text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, known = [], {}
            for row, (one, other) in enumerate(zip(batch["text_a"], batch["text_b"])):
                sets = []
                for value in (one, other):
                    body = value.as_buffer().to_pybytes()
                    if body not in known:
                        if len(known) >= 8:
                            known.clear()
                        known[body] = set_of(body)
                    sets.append(known[body])
                if close(*sets):
                    keep.append(row)
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part["a"], part["b"]], ["a", "b"])

    kind = edges.schema["a"].dataType.simpleString()
    # Texts are dealt by key at every size, and both sides read the same exchange.
    paired = edges.hint("merge").join(left, "a").hint("merge").join(right, "b").select("a", "b", "text_a", "text_b")
    return paired.mapInArrow(run, f"a {kind}, b {kind}")


def _similar(percent: int) -> Callable[[np.ndarray, np.ndarray], bool]:
    def close(one: np.ndarray, other: np.ndarray) -> bool:
        shared = len(np.intersect1d(one, other, assume_unique=True))
        return 100 * shared >= percent * (len(one) + len(other) - shared)

    return close


def _possible(edges: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Edges whose set sizes allow the similarity."""
    joined = edges.join(sizes.select(F.col("rep").alias("a"), F.col("n").alias("n_a")), "a").join(
        sizes.select(F.col("rep").alias("b"), F.col("n").alias("n_b")), "b"
    )
    return joined.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b")


def shared_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices over slices of the shingles."""
    member = np.repeat(np.arange(len(sets)), [len(one) for one in sets])
    _, shingle, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = seen[shingle] > 1
    _, column = np.unique(shingle[common], return_inverse=True)
    order = np.argsort(column, kind="stable")
    member, column = member[common][order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[member[low:high], column[low:high] - start] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _linked_parts(width: int, percent: int) -> Callable[[pa.Table], pa.Table]:
    """In one pair of chunks of a bucket: the components that any two members link."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.select(["rep", "part"]).to_pylist()
        sets = [shingle_set(value.as_buffer().to_pybytes(), width) for value in group["b_text"]]
        sizes = np.array([len(one) for one in sets])
        parts = sorted({row["part"] for row in rows})
        number = {one: place for place, one in enumerate(parts)}
        part = np.array([number[row["part"]] for row in rows])
        shared = shared_shingles(sets)
        near = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
        one, other = np.nonzero(near & (part[:, None] < part[None, :]))
        pairs = sorted(set(zip(part[one].tolist(), part[other].tolist())))
        kind = group.schema.field("part").type
        ends = [pa.array([parts[pair[side]] for pair in pairs], kind) for side in (0, 1)]
        return pa.Table.from_arrays(ends, ["a", "b"])

    return run


def across(placed: DataFrame, texts: DataFrame, linked: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Links between the components that share a bucket: pairs (a, b) of component ids.

    Members are compared by `linked` inside the task, so no pair is emitted but one for each
    two components found to be linked. A large bucket is cut into chunks, and
    every two of them are a group, so none exceeds twice CHUNK members. Buckets of
    the same members are compared once.
    """
    buckets = placed.groupBy("band").agg(
        F.min("part").alias("low"),
        F.max("part").alias("high"),
        F.count(F.lit(1)).alias("many"),
        F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("members"),
    )
    # With two members, the star has compared all there is.
    open_buckets = buckets.filter((F.col("low") != F.col("high")) & (F.col("many") > 2))
    once = open_buckets.groupBy("many", "members").agg(F.min("band").alias("band"))
    chunks = F.ceil(F.col("many") / CHUNK).cast("int").alias("chunks")
    rows = placed.join(once.select("band", chunks), "band")
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")),
    )
    dealt = rows.select("band", "rep", "part", F.inline(pair)).hint("merge").join(texts, "rep")
    kind = placed.schema["part"].dataType.simpleString()
    return dealt.groupBy("band", "i", "j").applyInArrow(linked, f"a {kind}, b {kind}").distinct()


def classes_of(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """Every document's key, set size `n`, and component: the smallest key it reaches, null if its set is empty."""
    rows = written(described(docs, key, text, width), "minhash_rows")
    full = rows.filter(F.col("digest").isNotNull() & F.col("key").isNotNull())
    classes = full.groupBy("digest").agg(F.min("key").alias("rep"), F.min("n").alias("n"), F.min("bands").alias("bands"))
    classes = written(classes, "minhash_classes")

    met = classes.select("rep", F.explode("bands").alias("band"))
    shared = met.groupBy("band").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    crowd = written(met.join(shared.select("band", "centre"), "band"), "minhash_buckets")
    star = crowd.filter("rep != centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    tried = _possible(star, classes.select("rep", "n"), percent)

    # The list of ids grows with the documents, so it meets the texts by a shuffle at every size.
    wanted = written(crowd.select("rep").distinct(), "minhash_wanted").hint("merge")
    first = docs.select(F.col(key), F.col(text)).join(wanted, F.col(key) == F.col("rep"), "left_semi")
    # A repeated row would repeat its edges only; one text per id is enough.
    texts = texts_as_bytes(first, text, key).withColumnRenamed(key, "rep").dropDuplicates(["rep"])
    texts = written(texts, "minhash_texts")
    linked = written(components(confirmed(tried, texts, functools.partial(shingle_set, width=width), _similar(percent))), "minhash_components")

    placed = crowd.join(linked, F.col("rep") == F.col("node"), "left").select(
        "band", "rep", F.coalesce("component_id", "rep").alias("part")
    )
    joined = components(across(placed, texts, _linked_parts(width, percent))).select(
        F.col("node").alias("part"), F.col("component_id").alias("whole")
    )
    known = classes.select("digest", "rep").join(linked, F.col("rep") == F.col("node"), "left")
    placed_classes = known.select("digest", F.coalesce("component_id", "rep").alias("part")).join(joined, "part", "left")
    places = placed_classes.select("digest", F.coalesce("whole", "part").alias("component"))
    return rows.join(places, "digest", "left").select("key", "n", "component")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """One row per document: key, n_shingles, component_id, kept."""
    placed = classes_of(docs, key, text, width, percent)
    smallest = F.when(F.col("key").isNotNull(), F.coalesce("component", "key")).alias("component_id")
    found = placed.select(F.col("key"), F.col("n").alias("n_shingles"), smallest)
    return found.select(F.col("key").alias(key), "n_shingles", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """The rows of `docs` without those whose component has a smaller id; of rows with equal ids one stays.

    Rows with a null id stay. All columns pass through.
    """
    marked = written(near_duplicates(docs, key, text, width, percent), "minhash_marks")
    gone = marked.filter("NOT kept AND component_id IS NOT NULL").select(key).distinct()
    # As above: whole rows meet a list that grows with them by a shuffle at every size.
    left = docs.join(gone.hint("merge"), key, "left_anti").select(*(F.col(f"`{name}`") for name in docs.columns))
    repeated = marked.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    if not repeated.take(1):
        return left
    again = repeated.select(key)
    return left.join(again, key, "left_anti").unionByName(left.join(again, key, "left_semi").dropDuplicates([key]))
