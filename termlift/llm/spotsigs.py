"""Document fingerprints by SpotSigs: chains of content words behind common words.

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
A-Z lower-cased. Every common word (ANCHORS) is a spot, and so is the start of the
text; a spot's signature is a hash of its word and of the next CHAIN content words,
which are the words that are not common. A document's fingerprint is the set of its
signatures, written as their sorted hex digits: what is between the spots, such as
mark-up and punctuation, does not count, and equal texts have equal fingerprints.
The likeness of two fingerprints is their Jaccard similarity.

`near_duplicates` compares all documents. Sets are partitioned by their length, so
that sets similar enough lie in one partition or in neighbouring ones, and meet
there by the signatures that a similar set must share: the rarest of each. Pairs
are compared with bounds from the lengths first. `followed` compares each document
with the one that follows it, and with what an edit makes of it, in one shuffle of
the texts by ranges of the id.

Defined results: null texts are empty; texts without a word (blank, or punctuation
only) have their white-space separated runs as one chain, empty ones the empty
fingerprint; texts of common words only are one chain of all of them; the likeness
of two empty fingerprints is 1; rows of equal id follow each other by text, null ids
come last; a lone document follows itself; an empty table gives an empty result.
Ids are whole numbers. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlift.llm.bpe import texts_as_bytes
from termlift.llm.components import components
from termlift.llm.minhash import across, confirmed
from termlift.llm.shingles import mixed, word_hashes
from termlift.plans.scale import written

# Articles, pronouns, prepositions, conjunctions and auxiliaries of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his in is it its not of on or she that the their "
    "they this to was were which who will with you "
    "au aux avec ce ces dans des du elle en est et il la le les leur mais ne ou par pas pour que qui sa se ses sont sur un une "
    "als auch auf aus bei das dass dem den der die ein eine er es im ist mit nicht sein sich sie sind und von war wie zu "
    "al como con de del el ella era han las lo los no para pero por son su sus una y"
).split()
CHAIN = 2
PERCENT = 80
# Documents are dealt by ranges of the id of about this much text; there are at most MAX_RANGES.
RANGE_BYTES = 8 << 20
MAX_RANGES = 8192
# Cells of the fixed-size table of how often signatures occur.
FREQUENCY_CELLS = 1 << 20

_TO_WORDS = bytes.maketrans(
    bytes(code for code in range(128) if not chr(code).isalnum()), b" " * sum(not chr(code).isalnum() for code in range(128))
)
_ANCHOR_HASHES = np.sort(word_hashes(" ".join(dict.fromkeys(ANCHORS)).encode()))
_START = np.uint64(0x243F6A8885A308D3)


def signatures(text: bytes, chain: int = CHAIN) -> np.ndarray:
    """The sorted distinct signatures of a whole text, 32 bits each."""
    words = word_hashes(text.translate(_TO_WORDS))
    if not len(words):
        words = word_hashes(text)
    if not len(words):
        return np.zeros(0, np.uint32)
    place = np.searchsorted(_ANCHOR_HASHES, words)
    common = _ANCHOR_HASHES[np.minimum(place, len(_ANCHOR_HASHES) - 1)] == words
    content = words[~common]
    if not len(content):
        return _digest(np.array([_folded(words)]))
    before = np.cumsum(~common)
    # The start of the text is a spot whose chain begins with the first content word.
    first = np.append(0, before[common])
    total = mixed(np.append(_START, words[common]))
    chained = first < len(content)
    first, total = first[chained], total[chained]
    padded = np.append(content, np.zeros(chain, np.uint64))
    for offset in range(chain):
        total = mixed(total) + padded[first + offset]
    return _digest(total)


def _folded(words: np.ndarray) -> np.uint64:
    total = hashlib.blake2b(words.tobytes(), digest_size=8).digest()
    return np.frombuffer(total, np.uint64)[0]


def _digest(total: np.ndarray) -> np.ndarray:
    return np.unique((mixed(total) >> np.uint64(32)).astype(np.uint32))


def fingerprint(found: np.ndarray) -> str:
    """Eight hex digits per signature, in order."""
    return found.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Jaccard similarity; 1 for two empty sets."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return shared / (len(one) + len(other) - shared)


def similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity reaches a percentage, told by the lengths alone where they exclude it.

    Stops as soon as the signatures not yet met cannot make up for those that only one set holds.
    """
    if len(one) > len(other):
        one, other = other, one
    if not len(one) or 100 * len(one) < percent * len(other):
        return False
    missed, step = 0, max(64, len(one) // 8)
    for start in range(0, len(one), step):
        part = one[start : start + step]
        place = np.minimum(np.searchsorted(other, part), len(other) - 1)
        missed += int(np.count_nonzero(other[place] != part))
        most = len(one) - missed
        if 100 * most < percent * (len(other) + missed):
            return False
    return True


def _ranges(docs: DataFrame, key: str, text: str, range_bytes: int) -> tuple[DataFrame, list[float]]:
    """Rows of key, b_text and `f_key`, and the bounds of ranges of the key with about equal numbers of documents."""
    rows = texts_as_bytes(docs, text, key).select(F.col(key).cast("long").alias("f_key"), "b_text")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = min(MAX_RANGES, max(1, math.ceil(size / range_bytes)))
    shares = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("f_key", shares, 10 * parts)).first()[0] if shares else []
    # A bucketizer wants two ranges at least.
    return rows, [-math.inf, *sorted({0.0, *map(float, cuts or [])}), math.inf]


def _in_ranges(rows: DataFrame, bounds: list[float]) -> DataFrame:
    """Add the number of each row's range; null ids, which come last, share the lowest."""
    known = F.coalesce(F.col("f_key").cast("double"), F.lit(-math.inf))
    dealt = Bucketizer(splits=bounds, inputCol="f_place", outputCol="f_range").transform(rows.withColumn("f_place", known))
    return dealt.withColumn("f_range", F.col("f_range").cast("int")).drop("f_place")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every document's key and text, by falling key within ranges, and behind each range the document that follows it.

    Columns f_range, f_guest, f_key, b_text, sorted within partitions. The first document of a range is copied
    to the next higher one, whose last document it follows; the first of all follows the last of all.
    """
    rows, bounds = _ranges(docs, key, text, range_bytes)
    placed = _in_ranges(rows, bounds)
    # A row per range, of which there are at most MAX_RANGES.
    ids = _in_ranges(rows.select("f_key"), bounds).groupBy("f_range").agg(F.max("f_key").alias("top"))
    known = sorted((row.f_range, row.top) for row in ids.collect())
    if not known:
        return placed.withColumn("f_guest", F.lit(False)).select("f_range", "f_guest", "f_key", "b_text")
    above = {number: known[(i + 1) % len(known)][0] for i, (number, _) in enumerate(known)}
    tops = docs.sparkSession.createDataFrame([(n, top, above[n]) for n, top in known], "f_range int, top long, above int")
    marked = placed.join(F.broadcast(tops), "f_range")
    own = F.struct(F.col("f_range").alias("r"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("above").alias("r"), F.lit(True).alias("guest"))
    places = F.when(F.col("f_key").eqNullSafe(F.col("top")), F.array(own, guest)).otherwise(F.array(own))
    dealt = marked.select("f_key", "b_text", F.explode(places).alias("at"))
    dealt = dealt.select(F.col("at.r").alias("f_range"), F.col("at.guest").alias("f_guest"), "f_key", "b_text")
    return dealt.repartition("f_range").sortWithinPartitions("f_range", "f_guest", F.desc_nulls_last("f_key"), "b_text")


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many code points from the start of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


class _Document:
    def __init__(self, key: int | None, body: bytes):
        self.key, self.text = key, body.decode("utf-8", "replace")
        self.spots = signatures(body)


def followed(docs: DataFrame, key: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and the likeness to that and to the next document.

    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures.
    """
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_signatures"]

    def compared(one: _Document, following: _Document) -> tuple:
        changed = edited(one.text, following.text).encode()
        spots = signatures(changed)
        return (
            one.key,
            len(one.text),
            hashlib.sha256(changed).hexdigest(),
            fingerprint(one.spots),
            fingerprint(spots),
            likeness(one.spots, spots),
            likeness(one.spots, following.spots),
            len(one.spots),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, current = None, None
        types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int64()]
        for batch in batches:
            made, size = [], 0
            for number, is_guest, name, value in zip(batch["f_range"].to_pylist(), batch["f_guest"].to_pylist(), batch["f_key"].to_pylist(), batch["b_text"]):
                if number != current:
                    waiting, current = None, number
                if is_guest and waiting is None:
                    continue
                document = _Document(name, value.as_buffer().to_pybytes())
                if waiting is not None:
                    made.append(compared(waiting, document))
                    size += len(made[-1][3]) + len(made[-1][4])
                waiting = None if is_guest else document
                if size > RANGE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names)
                    made, size = [], 0
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names)

    schema = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_signatures long"
    rows = with_next(docs, key, text, range_bytes)
    kind = docs.schema[key].dataType
    return rows.mapInArrow(run, schema).select(F.col("key").cast(kind).alias(key), *names[1:])


def length_bounds(percent: int) -> np.ndarray:
    """Lowest set lengths of the partitions: sets similar enough are in one partition or in neighbouring ones."""
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(100 * bounds[-1] // percent + 1)
    return np.array(bounds)


def _sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Each document's key, set length, packed signatures, and a digest of them, null for the empty set."""
    rows = texts_as_bytes(docs, text, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                packed = [signatures(value.as_buffer().to_pybytes()).tobytes() for value in part["b_text"]]
                digests = [hashlib.md5(one).digest() if one else None for one in packed]
                columns = [part[key], pa.array([len(one) // 4 for one in packed], pa.int64()), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n", "digest", "spots"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n long, digest binary, spots binary")


def _unpacked(spots: bytes) -> np.ndarray:
    return np.frombuffer(spots, np.uint32)


def _frequencies(classes: DataFrame) -> np.ndarray:
    """How many sets hold a signature of each cell; a fixed number of cells, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FREQUENCY_CELLS, np.int64)
        for batch in batches:
            for value in batch["spots"]:
                np.add.at(total, _unpacked(value.as_buffer().to_pybytes()) % FREQUENCY_CELLS, 1)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(total[full])], ["cell", "n"])

    counts = classes.select("spots").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(FREQUENCY_CELLS, np.int64)
    cells[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    return cells


def _meetings(classes: DataFrame, frequencies: Broadcast, percent: int) -> DataFrame:
    """Where sets meet: band (length partition and signature), rep.

    Sets similar enough share a signature among the rarest of each, as many as may be missing and one more.
    A set also visits the next partition, where the longer one of a pair may be.
    """
    bounds = length_bounds(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, value in enumerate(batch["spots"]):
                found = _unpacked(value.as_buffer().to_pybytes())
                order = np.lexsort((found, frequencies.value[found % FREQUENCY_CELLS]))
                rarest = found[order[: len(found) - -(-percent * len(found) // 100) + 1]].astype(np.int64)
                own = int(np.searchsorted(bounds, len(found), side="right"))
                bands = np.concatenate([rarest | (number << 32) for number in (own, own + 1)])
                reps = batch["rep"].slice(row, 1).take(pa.array(np.zeros(len(bands), np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(bands), reps], ["band", "rep"])

    kind = classes.schema["rep"].dataType.simpleString()
    return classes.select("rep", "spots").mapInArrow(run, f"band long, rep {kind}")


def _linked_parts(percent: int) -> Callable[[pa.Table], pa.Table]:
    """In one pair of chunks of a band: the components that any two members link."""

    def run(group: pa.Table) -> pa.Table:
        parts = group["part"].to_pylist()
        sets = sorted(((_unpacked(value.as_buffer().to_pybytes()), part) for value, part in zip(group["b_text"], parts)), key=lambda one: len(one[0]))
        pairs = set()
        for place, (one, part) in enumerate(sets):
            for other, else_part in sets[place + 1 :]:
                if 100 * len(one) < percent * len(other):
                    break
                pair = (min(part, else_part), max(part, else_part))
                if part != else_part and pair not in pairs and similar(one, other, percent):
                    pairs.add(pair)
        kind = group.schema.field("part").type
        return pa.Table.from_arrays([pa.array([pair[side] for pair in sorted(pairs)], kind) for side in (0, 1)], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: key, n_signatures, component_id (the smallest key it is linked with), kept.

    Documents are linked when the Jaccard similarity of their signatures is at least `percent`; empty sets link
    with nothing. Equal sets are one class. In each band the classes are linked to the smallest one first, a
    star; bands that then still hold several components are compared inside tasks.
    """
    rows = written(_sets(docs, key, text), "spot_rows")
    full = rows.filter(F.col("digest").isNotNull() & F.col("key").isNotNull())
    classes = written(full.groupBy("digest").agg(F.min("key").alias("rep"), F.min("spots").alias("spots")), "spot_classes")
    frequencies = docs.sparkSession.sparkContext.broadcast(_frequencies(classes))
    met = written(_meetings(classes, frequencies, percent), "spot_meetings")
    shared = met.groupBy("band").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    crowd = written(met.join(shared.select("band", "centre"), "band"), "spot_bands")
    star = crowd.filter("rep != centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    sets = classes.select("rep", F.col("spots").alias("b_text"))
    near = confirmed(star, sets, _unpacked, lambda one, other: similar(one, other, percent))
    linked = written(components(near), "spot_components")

    placed = crowd.join(linked, F.col("rep") == F.col("node"), "left").select("band", "rep", F.coalesce("component_id", "rep").alias("part"))
    joined = components(across(placed, sets, _linked_parts(percent))).select(F.col("node").alias("part"), F.col("component_id").alias("whole"))
    known = classes.select("digest", "rep").join(linked, F.col("rep") == F.col("node"), "left")
    places = known.select("digest", F.coalesce("component_id", "rep").alias("part")).join(joined, "part", "left")
    whole = places.select("digest", F.coalesce("whole", "part").alias("component"))
    own = F.when(F.col("key").isNotNull(), F.coalesce("component", "key")).alias("component_id")
    found = rows.select("key", "n", "digest").join(whole, "digest", "left").select("key", F.col("n").alias("n_signatures"), own)
    return found.select(F.col("key").alias(key), "n_signatures", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
