"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions, each in the node of a binary tree that the
decisions before it lead to. Every decision has, for every context of the last 0
to DEPTH bytes, a Krichevsky-Trofimov estimate from the training texts, and the
estimates of all depths are mixed by the weights of context-tree weighting: with
Pe(s) the probability that the estimate of context s gave to its decisions, and

    Pw(s) = (Pe(s) + product of Pw over the contexts one byte longer) / 2,

context s takes Pe(s) / (2 Pw(s)) of the weight that reaches it and passes the
rest to the longer context. At the greatest depth Pw = Pe. A context not seen in
training adds nothing: the longest seen one takes all the weight that reaches it.
The model is fixed after training. A text is coded after an end mark and
followed by one, so the probabilities of all texts sum to one.

How it is spread: blocks of text (see blocks.py) count their distinct byte
n-grams; counts and later requests go to buckets by the two newest bytes of the
context, in which all longer contexts of a bucket lie together. Only the sums of
the two lowest depths (at most 256 * 255 numbers) pass through the driver. A
bucket answers each block's request with one log probability per n-gram, and the
block adds them up per document. Many blocks of one bucket are split by a salt.

The code length per byte is that of the text and its end, in bits, over the bytes
of the text. Answers travel as 32-bit floats, which moves a sum by less than one
part in ten million.

Words and their base score are counted likewise, by block, then by word.

Defined results: a null text is empty and consists of the end alone, without a
code length per byte; bytes that
are not UTF-8 are scored like any others; rows with a null id count as held out
if crc32 of the empty string, 0, says so, as it does; repeated rows count each;
without any training text all probabilities are one half per decision and the
base score is null; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from termlift.llm.blocks import binary, squeezed, squeezed_keys, text_blocks, texts_of, unsqueezed, unsqueezed_keys
from termlift.llm.bpe import texts_as_bytes
from termlift.llm.shingles import word_hashes
from termlift.plans.scale import written

DEPTH = 5
# UTF-8 never contains this byte; it marks the end of a text, and what lies before its start.
END = 0xFF
FOLD = 10
BUCKETS = 256
# Contexts of this many bytes and more stay inside one bucket.
LOCAL = 2
BLOCKS_PER_TASK = 512
WORD_SMOOTHING = 0.1
GROUP_BYTES = 1 << 19
# Each n-gram takes a dozen numbers for each of its eight decisions while it is scored.
KEYS_AT_ONCE = 1 << 14
# Counts of keys that wait before they are added up.
COUNTS_AT_ONCE = 1 << 19
# Stands for the end of a text among the hashes of words.
END_WORD = np.uint64(0x5851F42D4C957F2D)
# log gamma(i + 1/2) and log i! for the first arguments; beyond them Stirling's series is exact to 1e-12.
TABLE = 64
HALF_TABLE = np.array([math.lgamma(i + 0.5) for i in range(TABLE)])
FULL_TABLE = np.array([math.lgamma(i + 1.0) for i in range(TABLE)])


def is_held_out(key: object) -> bool:
    """One text in ten, by its id."""
    return zlib.crc32(b"" if key is None else str(key).encode()) % FOLD == 0


def _stirling(x: np.ndarray) -> np.ndarray:
    inverse = 1.0 / x
    square = inverse * inverse
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series


def _log_gamma(counts: np.ndarray, offset: float, table: np.ndarray) -> np.ndarray:
    big = _stirling(np.maximum(counts, TABLE) + offset)
    return np.where(counts < TABLE, table[np.minimum(counts, TABLE - 1)], big)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    gammas = _log_gamma(zeros, 0.5, HALF_TABLE) + _log_gamma(ones, 0.5, HALF_TABLE)
    return gammas - math.log(math.pi) - _log_gamma(zeros + ones, 1.0, FULL_TABLE)


def ngrams(text: bytes, depth: int = DEPTH) -> np.ndarray:
    """For each byte and the end: the bytes before it, the newest in the highest place, then the byte itself."""
    codes = np.frombuffer(bytes([END]) * depth + text + bytes([END]), np.uint8).astype(np.uint64)
    made = codes[depth:].copy()
    for back in range(1, depth + 1):
        made |= codes[depth - back : len(codes) - back] << np.uint64(8 * (depth + 1 - back))
    return made


def bucket_of(keys: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The bucket of an n-gram: a hash of the two newest bytes of its context."""
    newest = (keys >> np.uint64(8 * (depth - 1))).astype(np.uint32)
    return ((newest * np.uint32(2654435761)) >> np.uint32(24)).astype(np.int64) % BUCKETS


class Level:
    """Decision nodes of all contexts of one depth: sorted names, counts, and the log of Pe and Pw.

    A node's name is the context followed by the decisions so far, a number from 1
    to 255, so names are n-grams whose last byte is such a number.
    """

    def __init__(self, names: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray | None) -> None:
        self.names, self.zeros, self.ones = names, zeros, ones
        self.estimate = log_estimate(zeros, ones)
        self.own = np.ones(len(names))
        self.weighted = self.estimate
        if longer is not None:
            self.weighted = np.logaddexp(self.estimate, longer) - math.log(2)
            self.own = np.exp(self.estimate - math.log(2) - self.weighted)

    def parents(self, depth: int) -> Level:
        """The level of contexts one byte shorter; `depth` is this level's."""
        return Level(*_sums(cut_to(self.names, depth - 1), self.zeros, self.ones, self.weighted))


def cut_to(names: np.ndarray, depth: int) -> np.ndarray:
    """Names with contexts cut to the newest `depth` bytes."""
    low = np.uint64(8 * (DEPTH - depth + 1))
    return names >> low << low | (names & np.uint64(255))


def _sums(names: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct names in order and the sums of each array over them."""
    order = np.argsort(names, kind="stable")
    names = names[order]
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    return [names[first], *(np.add.reduceat(array[order], first) for array in values)]


def decisions(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each n-gram the names of its eight nodes, and the bits decided there, as (n-grams, 8)."""
    symbol = (keys & np.uint64(255))[:, None] | np.uint64(256)
    shifts = np.arange(8, 0, -1, dtype=np.uint64)[None, :]
    nodes = symbol >> shifts
    bits = (symbol >> (shifts - np.uint64(1))) & np.uint64(1)
    return (keys & ~np.uint64(255))[:, None] | nodes, bits.astype(bool)


def deepest(keys: np.ndarray, counts: np.ndarray) -> Level:
    """The level of the longest contexts, from distinct n-grams in order, with their counts."""
    symbol, context, parts = keys & np.uint64(255) | np.uint64(256), keys & ~np.uint64(255), []
    for shift in range(8, 0, -1):
        # The keys are in order, so the nodes of one decision are too; only distinct ones are held.
        names = context | symbol >> np.uint64(shift)
        first = np.flatnonzero(np.concatenate([names[:1] == names[:1], names[1:] != names[:-1]]))
        bit = (symbol >> np.uint64(shift - 1)) & np.uint64(1) == 1
        parts.append((names[first], np.add.reduceat(np.where(bit, 0, counts), first), np.add.reduceat(np.where(bit, counts, 0), first)))
    return Level(*_sums(*map(np.concatenate, zip(*parts))), None)


def local_levels(keys: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels LOCAL to DEPTH of a bucket's training counts, the longest contexts last."""
    levels = [deepest(keys, counts)]
    for depth in range(DEPTH, LOCAL, -1):
        levels.insert(0, levels[0].parents(depth))
    return levels


class Upper:
    """Depths 0 and 1, for every newest byte and node: seen, share of ones so far, weight left for longer contexts."""

    def __init__(self, newest: np.ndarray, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray) -> None:
        shape = (256, 256)
        grid = {name: np.zeros(shape, kind) for name, kind in (("zeros", np.int64), ("ones", np.int64), ("longer", float))}
        for name, values in (("zeros", zeros), ("ones", ones), ("longer", weighted)):
            grid[name][newest, node] = values
        seen = grid["zeros"] + grid["ones"] > 0
        level = Level(np.zeros(shape), grid["zeros"], grid["ones"], np.where(seen, grid["longer"], 0.0))
        total = [grid["zeros"].sum(axis=0), grid["ones"].sum(axis=0)]
        root = Level(np.zeros(256), *total, np.where(seen, level.weighted, 0.0).sum(axis=0))
        own, share = root.own[None, :], (root.ones + 0.5) / (root.zeros + root.ones + 1)
        inside = (level.ones + 0.5) / (level.zeros + level.ones + 1)
        self.ones = np.where(seen, own * share + (1 - own) * level.own * inside, share[None, :])
        self.left = np.where(seen, (1 - own) * (1 - level.own), 0.0)
        # Where no longer context is seen, depth 1 takes what is left.
        self.last = np.where(seen, inside, share[None, :])


def log_probabilities(keys: np.ndarray, levels: list[Level], upper: Upper) -> np.ndarray:
    """log2 of the mixed probability of each n-gram's last byte after the bytes before it, some n-grams at a time."""
    parts = [_mixed_logs(keys[start : start + KEYS_AT_ONCE], levels, upper) for start in range(0, len(keys), KEYS_AT_ONCE)]
    return np.concatenate([np.zeros(0), *parts])


def _mixed_logs(keys: np.ndarray, levels: list[Level], upper: Upper) -> np.ndarray:
    names, bits = decisions(keys)
    newest = (keys >> np.uint64(8 * DEPTH)).astype(np.int64)[:, None]
    node = (names & np.uint64(255)).astype(np.int64)
    ones, left, last = upper.ones[newest, node], upper.left[newest, node], upper.last[newest, node]
    for depth, level in zip(range(LOCAL, DEPTH + 1), levels):
        wanted = cut_to(names, depth)
        at = np.minimum(np.searchsorted(level.names, wanted), len(level.names) - 1)
        seen = level.names[at] == wanted
        share = (level.ones[at] + 0.5) / (level.zeros[at] + level.ones[at] + 1)
        own = level.own[at]
        ones = np.where(seen, ones + left * own * share, ones)
        left = np.where(seen, left * (1 - own), left)
        last = np.where(seen, share, last)
    ones = ones + left * last
    return np.log2(np.where(bits, ones, 1 - ones)).sum(axis=1)


def words(text: bytes) -> np.ndarray:
    """Hashes of a text's words and of its end."""
    return np.append(word_hashes(text), END_WORD)


def word_bucket(keys: np.ndarray) -> np.ndarray:
    """Buckets of words come after those of n-grams."""
    return BUCKETS + (keys >> np.uint64(56)).astype(np.int64)


# What a text is cut into, and where each key of it goes.
KINDS = ((ngrams, bucket_of), (words, word_bucket))


def _groups(texts: list[bytes]) -> Iterator[range]:
    """Neighbouring texts of about GROUP_BYTES together."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= GROUP_BYTES:
            yield range(start, at + 1)
            start, size = at + 1, 0
    if start < len(texts):
        yield range(start, len(texts))


def _sorted_unique(keys: np.ndarray) -> np.ndarray:
    """Distinct keys in order; np.unique hashes numbers, which takes several times as long as sorting them."""
    keys = np.sort(keys)
    return keys[np.concatenate([keys[:1] == keys[:1], keys[1:] != keys[:-1]])]


def _distinct(texts: list[bytes], make: Callable, held: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block's texts and how often each occurs in those to learn from.

    Only the distinct keys of each group of texts are held at a time.
    """

    def counted() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for group in _groups(texts):
            for kept_out in (False, True):
                made = [make(texts[at]) for at in group if held[at] == kept_out]
                if made:
                    found, counts = np.unique(np.concatenate(made), return_counts=True)
                    yield found, np.zeros_like(counts) if kept_out else counts

    return _added_up(counted())


def _added_up(counted: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their counts; no more wait to be added than there are distinct ones, or COUNTS_AT_ONCE."""
    parts, waiting = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
    for keys, counts in counted:
        parts.append((keys, counts))
        waiting += len(keys)
        if waiting > max(COUNTS_AT_ONCE, len(parts[0][0])):
            parts, waiting = [tuple(_sums(*map(np.concatenate, zip(*parts))))], 0
    keys, counts = map(np.concatenate, zip(*parts))
    return tuple(_sums(keys, counts)) if len(keys) else (keys, counts)


def _by_bucket(keys: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The buckets that occur and the places of their keys, which stay in order."""
    # Short numbers are sorted by radix.
    order = np.argsort(bucket.astype(np.uint16), kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    return found, np.split(order, starts[1:])


def requests(blocks: DataFrame) -> DataFrame:
    """Each block's distinct n-grams and words by bucket, with how often its training texts hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                texts = texts_of(batch["sizes"][row].as_py(), batch["body"][row].as_py())
                held = [is_held_out(key) for key in batch["keys"][row].as_py()]
                for make, bucket in KINDS:
                    keys, counts = _distinct(texts, make, held)
                    found, places = _by_bucket(keys, bucket(keys))
                    columns = [
                        pa.array(found.astype(np.int32)),
                        pa.array(np.full(len(found), batch["block"][row].as_py(), np.int64)),
                        binary([squeezed_keys(keys[at]) for at in places]),
                        binary([squeezed(counts[at]) for at in places]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "keys", "counts"])

    return blocks.mapInArrow(run, "bucket int, block long, keys binary, counts binary")


def _counted(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return unsqueezed_keys(row["keys"]), np.frombuffer(unsqueezed(row["counts"]), np.int64)


def _merged(table: pa.Table) -> pa.Table:
    """Counts of one bucket summed over its rows, without keys that no training text holds."""

    def known() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for row in range(table.num_rows):
            keys, counts = _counted({name: table[name][row].as_py() for name in ("keys", "counts")})
            yield keys[counts > 0], counts[counts > 0]

    keys, counts = _added_up(known())
    columns = [table["bucket"].slice(0, 1), [squeezed_keys(keys)], [squeezed(counts)], [len(keys)], [int(counts.sum())]]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    arrays = [columns[0].cast(types[0]), *(pa.chunked_array([pa.array(c, t)]) for c, t in zip(columns[1:], types[1:]))]
    return pa.Table.from_arrays(arrays, MODEL_NAMES)


MODEL_NAMES = ["bucket", "keys", "counts", "distinct", "total"]
MODEL_SCHEMA = "bucket int, keys binary, counts binary, distinct long, total long"


def model(asked: DataFrame, salts: int) -> DataFrame:
    """The training counts of each bucket: summed over the blocks of one salt, then over the salts."""
    salted = asked.select("bucket", F.pmod("block", F.lit(salts)).alias("salt"), "keys", "counts")
    partial = salted.groupBy("bucket", "salt").applyInArrow(_merged, MODEL_SCHEMA)
    return written(partial.groupBy("bucket").applyInArrow(_merged, MODEL_SCHEMA), "ctw_model")


def upper_levels(counted: DataFrame) -> Upper:
    """Depths 0 and 1 from sums over all buckets: at most 256 * 255 rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["keys", "counts"]).to_pylist():
                keys, counts = _counted(row)
                if not len(keys):
                    continue
                level = local_levels(keys, counts)[0]
                names, *sums = _sums(cut_to(level.names, 1), level.zeros, level.ones, level.weighted)
                place = [names >> np.uint64(8 * DEPTH), names & np.uint64(255)]
                columns = [*(pa.array(values.astype(np.int64)) for values in place), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, ["newest", "node", "zeros", "ones", "weighted"])

    rows = counted.filter(F.col("bucket") < BUCKETS).mapInArrow(
        run, "newest long, node long, zeros long, ones long, weighted double"
    )
    sums = rows.groupBy("newest", "node").agg(F.sum("zeros"), F.sum("ones"), F.sum("weighted")).toArrow()
    return Upper(*(np.asarray(sums.column(place)) for place in range(5)))


def answers(asked: DataFrame, counted: DataFrame, upper: Upper, salts: int) -> DataFrame:
    """For every request the log probabilities of its n-grams, or the training counts of its words."""
    shared = asked.sparkSession.sparkContext.broadcast(upper)
    copies = counted.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "keys", "counts")
    questions = asked.select("bucket", F.pmod("block", F.lit(salts)).cast("int").alias("salt"), "block", "keys")

    def run(known: pa.Table, wanted: pa.Table) -> pa.Table:
        rows = known.to_pylist()
        keys, counts = _counted(rows[0]) if rows else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        replies = []
        bucket = wanted["bucket"][0].as_py() if wanted.num_rows else 0
        levels = local_levels(keys, counts) if len(keys) and bucket < BUCKETS else []
        for value in wanted["keys"]:
            some = unsqueezed_keys(value.as_py())
            if bucket < BUCKETS:
                replies.append(squeezed(log_probabilities(some, levels, shared.value).astype(np.float32)))
            elif len(keys):
                at = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
                replies.append(squeezed(np.where(keys[at] == some, counts[at], 0)))
            else:
                replies.append(squeezed(np.zeros(len(some), np.int64)))
        arrays = [wanted["block"].combine_chunks(), wanted["bucket"].combine_chunks(), pa.array(replies, pa.binary())]
        return pa.Table.from_arrays(arrays, ["block", "bucket", "reply"])

    pairs = copies.groupBy("bucket", "salt").cogroup(questions.groupBy("bucket", "salt"))
    return pairs.applyInArrow(run, "block long, bucket int, reply binary")


def _looked_up(texts: list[bytes], make: Callable, bucket: Callable, replies: dict[int, bytes], kind: type) -> Iterator[np.ndarray]:
    """For each text the answers to its keys, in ascending order of the keys."""
    groups = list(_groups(texts))
    distinct = [_sorted_unique(np.concatenate([make(texts[at]) for at in group])) for group in groups]
    keys = _sorted_unique(np.concatenate(distinct))
    found, places = _by_bucket(keys, bucket(keys))
    values = np.zeros(len(keys), kind)
    for one, at in zip(found.tolist(), places):
        values[at] = np.frombuffer(unsqueezed(replies[one]), kind)
    for group, own in zip(groups, distinct):
        near = values[np.searchsorted(keys, own)]
        for at in group:
            # A text's keys are sorted, so that neighbouring needles meet neighbours among the few keys of its group.
            yield near[np.searchsorted(own, np.sort(make(texts[at])))]


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: key, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte."""
    blocks = text_blocks(texts_as_bytes(docs, text, key), key, "ctw_blocks")
    asked = written(requests(blocks), "ctw_requests")
    salts = max(1, -(-blocks.count() // BLOCKS_PER_TASK))
    counted = model(asked, salts)
    tokens = counted.filter(F.col("bucket") >= BUCKETS).agg(F.sum("total"), F.sum("distinct")).first()
    total, distinct = tokens[0] or 0, tokens[1] or 0
    replies = answers(asked, counted, upper_levels(counted), salts)

    def run(group: pa.Table, answered: pa.Table) -> pa.Table:
        reply = dict(zip(answered["bucket"].to_pylist(), answered["reply"].to_pylist()))
        out = [[] for _ in SCORE_NAMES]
        for row in group.to_pylist():
            texts = texts_of(row["sizes"], row["body"])
            logs = [values.astype(np.float64).sum() * math.log10(2) for values in _looked_up(texts, *KINDS[0], reply, np.float32)]
            counts = list(_looked_up(texts, *KINDS[1], reply, np.int64))
            bottom = total + WORD_SMOOTHING * (distinct + 1)
            base = [float(np.log10((many + WORD_SMOOTHING) / bottom).sum()) if total else None for many in counts]
            known = [int((many > 0).sum()) for many in counts]
            held = [is_held_out(one) for one in row["keys"]]
            sizes = [len(one) for one in texts]
            rates = [-log / math.log10(2) / size if size else None for log, size in zip(logs, sizes)]
            made = (row["keys"], held, [len(m) for m in counts], known, [total] * len(texts), base, logs, sizes, rates)
            for column, values in zip(out, made):
                column += values
        return pa.Table.from_arrays([pa.array(column, kind) for column, kind in zip(out, kinds)], SCORE_NAMES)

    kinds = [to_arrow_type(docs.schema[key].dataType), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2, pa.int64(), pa.float64()]
    ddl = docs.schema[key].dataType.simpleString()
    schema = (
        f"key {ddl}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
        "n_bytes long, bits_per_byte double"
    )
    scored = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)
    return scored.withColumnRenamed("key", key)


SCORE_NAMES = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]
