"""Collocations by SON: shards mined at lowered support, then one exact count of all their candidates.

Texts are lower-cased (A-Z), cut at `[.,;:!?\\x0A-\\x0D]` into pieces and those at
`[\\x20\\x09]` into words. They are numbered once and written as blocks, each of one
language. The blocks are dealt to SHARDS shards. A phrase that reaches the
support in the whole language reaches, in one shard at least, the support times
the shard's share of the language's words; so each shard is mined completely at
that local support, length by length: a phrase is counted only where both phrases
that are one word shorter were frequent. Local counts are summed by Spark per
(language, shard, hash), so a shard is no task and may be of any size. SHARDS is
the same at every size and far below the support: with more shards the local
support falls towards one and fewer phrases are pruned.

What is frequent in some shard, and whose local counts together reach the support, is kept as a set of hash cells of a fixed size
(CELL_BITS); a cell that another phrase shares only lets a phrase through that is
then counted in vain, and only if its parts share cells too. The last pass counts every
candidate in every block, by its words, adds up the blocks of a task, and the sums are
exact. Almost every task meets almost every candidate, so this pass has few and long tasks:
as many as there are cores, or more if each still reads WORDS_PER_COUNT words for every
candidate. Its rows are then at most the candidates times the cores, or a share of the words.

Defined results: null texts are empty; a null language counts as `und`, together
with rows that say so; repeated rows count each; empty texts and an empty table
give no phrase; equal scores go by count, then by phrase in byte order. Columns
of the input other than text and language are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termlift.llm.bpe import texts_as_bytes
from termlift.llm.shingles import mixed
from termlift.plans.scale import checked_broadcast, written

SUPPORT = 100
MAX_WORDS = 5
TOP = 2000
SHARDS = 4
NO_LANGUAGE = "und"
# Text of a block, and of the part of it that is split at a time.
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
# The set of frequent hashes has this many cells, one bit each: 16 MB.
CELL_BITS = 27
# While a shard is mined, a phrase is known by this many bits of its hash; equal ones add up, which prunes less but loses none.
KEY_BITS = 40
BATCH_ROWS = 1 << 17
# Counts that a task of the last pass adds up before it passes on its largest language's.
HELD_COUNTS = 1 << 19
# Words that a task of the last pass reads for each candidate, unless cores would stand idle.
WORDS_PER_COUNT = 128

_PIECE_END = b"\n"
_SPLITTING = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


class _Numbers(dict):
    """Words to consecutive numbers; the end of a piece is 0 and the empty word 1."""

    def __init__(self):
        super().__init__({_PIECE_END: 0, b"": 1})
        self._next = count(2)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = next(self._next)
        return number


def _sliced(text: bytes) -> Iterator[bytes]:
    """Parts of about SLICE_BYTES that end where a word does."""
    start = 0
    while start < len(text):
        end = start + SLICE_BYTES
        if end < len(text):
            ends = [at for at in (text.find(b" ", end), text.find(_PIECE_END, end)) if at >= 0]
            end = min(ends, default=len(text))
        yield text[start:end]
        start = end


def numbered(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The texts as word numbers, a 0 after each piece, and the word of every number from 2 on."""
    numbers, parts = _Numbers(), []
    joined = (_PIECE_END.join(texts) + _PIECE_END).lower().translate(_SPLITTING)
    for part in _sliced(joined):
        words = part.replace(_PIECE_END, b" \n ").split(b" ")
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    flat = np.concatenate(parts)
    return flat[flat != 1], list(numbers)[2:]


_BLOCKS = "lang string, shard int, n_words long, numbers binary, words binary"


def blocks(docs: DataFrame, text: str = "text", lang: str = "lang", block_bytes: int = BLOCK_BYTES, shards: int = SHARDS) -> DataFrame:
    """Numbered texts of one language each: lang, shard, n_words, and compressed numbers and words."""
    rows = texts_as_bytes(docs.withColumn("p_lang", F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE))), text, "p_lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        made = count(TaskContext.get().partitionId())

        def block(name: str) -> pa.RecordBatch:
            flat, words = numbered(waiting.pop(name))
            del sizes[name]
            packed = [zlib.compress(flat.tobytes(), 1), zlib.compress(b" ".join(words), 1)]
            values = [name, next(made) % shards, int(np.count_nonzero(flat)), *packed]
            schema = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("n_words", pa.int64()), ("numbers", pa.binary()), ("words", pa.binary())])
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            for name, value in zip(batch["p_lang"].to_pylist(), batch["b_text"]):
                body = value.as_buffer().to_pybytes()
                waiting.setdefault(name, []).append(body)
                sizes[name] = sizes.get(name, 0) + len(body)
                if sizes[name] >= block_bytes:
                    yield block(name)
                elif sum(sizes.values()) >= 2 * block_bytes:
                    yield block(max(sizes, key=sizes.get))
        for name in list(waiting):
            yield block(name)

    return rows.mapInArrow(run, _BLOCKS)


class Block:
    """A block's word numbers with a hash for each word."""

    def __init__(self, row: dict):
        self.lang = row["lang"]
        self.numbers = np.frombuffer(zlib.decompress(row["numbers"]), np.int32)
        self.words = zlib.decompress(row["words"]).split(b" ") if row["n_words"] else []
        seed = zlib.crc32(self.lang.encode())
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(word, seed) for word in self.words), np.uint64, len(self.words))
        self.hashes = np.concatenate([np.zeros(2, np.uint64), hashes])

    def phrases(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the phrase of `length` words from every position, and whether it lies within a piece."""
        size = max(len(self.numbers) - length + 1, 0)
        total, inside = np.full(size, np.uint64(length)), np.ones(size, bool)
        for offset in range(length):
            part = self.numbers[offset : offset + size]
            total = mixed(total) + self.hashes[part]
            inside &= part > 0
        return mixed(total), inside

    def candidates(self, length: int, cells: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose phrase may be frequent by its parts of one word less, and their hashes."""
        hashes, inside = self.phrases(length)
        if length > 1:
            shorter, whole = self.phrases(length - 1)
            fine = whole & held(cells, shorter)
            inside &= fine[:-1] & fine[1:]
        at = np.flatnonzero(inside)
        return at, hashes[at]

    def counted(self, length: int, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first position and the count of every different phrase at the positions, by its words."""
        _, first, group, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        lead = at[first][group]
        if all(np.array_equal(self.numbers[at + i], self.numbers[lead + i]) for i in range(length)):
            return at[first], times
        words = np.stack([self.numbers[at + i] for i in range(length)], axis=1)
        _, first, times = np.unique(words, axis=0, return_index=True, return_counts=True)
        return at[first], times

    def texts(self, first: np.ndarray, length: int) -> list[bytes]:
        """The phrases of `length` words that start at the positions."""
        rows = np.stack([self.numbers[first + offset] - 2 for offset in range(length)], axis=1).tolist()
        return [b" ".join([self.words[number] for number in row]) for row in rows]


def held(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes lie in a cell of the set."""
    cell = hashes >> np.uint64(64 - CELL_BITS)
    return (cells[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def _per_block(table: DataFrame, made: Callable[[Block, int], Iterator[list]], names: list[str], types: list[pa.DataType], schema: str) -> DataFrame:
    """Rows from each block: `made` gives columns, or one value for all rows, which leave in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                values = {name: batch[name][row].as_py() for name in batch.schema.names}
                for columns in made(Block(values), values["shard"]):
                    size = len(columns[-1])
                    for start in range(0, size, BATCH_ROWS):
                        many = min(BATCH_ROWS, size - start)
                        part = [
                            pa.repeat(pa.scalar(column, kind), many) if isinstance(column, (str, int)) else pa.array(column[start : start + many], kind)
                            for column, kind in zip(columns, types)
                        ]
                        yield pa.RecordBatch.from_arrays(part, names)

    return table.mapInArrow(run, schema)


def _frequent_cells(local: DataFrame, least: DataFrame, support: int) -> np.ndarray:
    """The cells of all hashes that reach the local support in some shard, and the support in all shards together.

    Every shard counts the phrases whose parts are in the set, which is one for all shards, so the sum over the
    shards is at least the phrase's count, and a phrase that reaches the support is never left out. A block gives a phrase once, so rows are dealt before they are summed: adding them up in the tasks that make
    them would take memory and merge next to nothing.
    """
    summed = local.repartition("hash").groupBy("lang", "shard", "hash").agg(F.sum("n").alias("n"))
    known = summed.join(checked_broadcast(least), ["lang", "shard"])
    whole = known.groupBy("lang", "hash").agg(F.sum("n").alias("f"), F.bool_or(F.col("n") >= F.col("least")).alias("local"))
    frequent = whole.filter(F.col("local") & (F.col("f") >= support))
    cell = F.shiftright("hash", KEY_BITS - CELL_BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftright(hash, {KEY_BITS - CELL_BITS}) & 63 as int))")
    words = frequent.groupBy(F.shiftright(cell, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = words.toArrow()
    cells = np.zeros(1 << (CELL_BITS - 6), np.uint64)
    cells[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return cells


def local_supports(table: DataFrame, support: int) -> DataFrame:
    """Per language and shard, the support times the shard's share of the words, rounded up: lang, shard, least."""
    sizes = table.groupBy("lang", "shard").agg(F.sum("n_words").alias("part"))
    totals = sizes.groupBy("lang").agg(F.sum("part").alias("n"))
    share = F.expr(f"cast(({support} * cast(part as decimal(28,0)) + n - 1) div n as bigint)")
    return sizes.join(totals, "lang").filter("n > 0").select("lang", "shard", share.alias("least"))


def candidate_cells(table: DataFrame, support: int, max_words: int) -> np.ndarray:
    """Mine every shard length by length; the cells of all phrases frequent in a shard and in all together, of any length."""
    context = table.sparkSession.sparkContext
    least = written(local_supports(table, support), "phrase_supports")
    cells = np.zeros(1 << (CELL_BITS - 6), np.uint64)
    for length in range(1, max_words + 1):
        shared = context.broadcast(cells)

        def made(block: Block, shard: int, length=length, shared=shared) -> Iterator[list]:
            _, hashes = block.candidates(length, shared.value)
            found, times = np.unique(hashes >> np.uint64(64 - KEY_BITS), return_counts=True)
            yield [block.lang, shard, found.view(np.int64), times.astype(np.int32)]

        types = [pa.string(), pa.int32(), pa.int64(), pa.int32()]
        local = _per_block(table, made, ["lang", "shard", "hash", "n"], types, "lang string, shard int, hash long, n int")
        grown = _frequent_cells(local, least, support)
        shared.unpersist()
        if not grown.any():
            break
        cells |= grown
    return cells


def _candidate_counts(table: DataFrame, shared: Broadcast, max_words: int, held_counts: int) -> DataFrame:
    """Exact counts of all candidates, by their words, summed over the blocks of a task: lang, phrase, n.

    A phrase that reaches the support has only parts that reach it, so one whose parts are not
    in the set is there by a shared cell only and is left out.
    """

    def candidates(block: Block) -> Iterator[tuple[list[bytes], list[int]]]:
        fine = None
        for length in range(1, max_words + 1):
            hashes, inside = block.phrases(length)
            if fine is not None:
                inside &= fine[:-1] & fine[1:]
            fine = inside & held(shared.value, hashes)
            at = np.flatnonzero(fine)
            first, times = block.counted(length, at, hashes[at])
            for start in range(0, len(first), BATCH_ROWS):
                part = slice(start, start + BATCH_ROWS)
                yield block.texts(first[part], length), times[part].tolist()

    def rows(lang: str, counts: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        phrases, times = list(counts), list(counts.values())
        for start in range(0, len(phrases), BATCH_ROWS):
            part = pa.array(phrases[start : start + BATCH_ROWS], pa.binary()).cast(pa.string())
            columns = [pa.repeat(pa.scalar(lang), len(part)), part, pa.array(times[start : start + BATCH_ROWS], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, dict[bytes, int]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block({name: batch[name][row].as_py() for name in batch.schema.names})
                counts = waiting.setdefault(block.lang, {})
                for phrases, times in candidates(block):
                    for phrase, many in zip(phrases, times):
                        counts[phrase] = counts.get(phrase, 0) + many
                    while sum(map(len, waiting.values())) > held_counts:
                        largest = max(waiting, key=lambda name: len(waiting[name]))
                        yield from rows(largest, waiting[largest])
                        waiting[largest].clear()
        for lang, counts in waiting.items():
            yield from rows(lang, counts)

    return table.mapInArrow(run, "lang string, phrase string, n long")


def counting_tasks(cells: np.ndarray, words: int, cores: int) -> int:
    """How many tasks the last pass has at most, given the cells of all candidates."""
    candidates = max(int(np.bitwise_count(cells).sum()), 1)
    return max(cores, words // (WORDS_PER_COUNT * candidates))


def frequent_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    support: int = SUPPORT,
    max_words: int = MAX_WORDS,
    shards: int = SHARDS,
    block_bytes: int = BLOCK_BYTES,
    held_counts: int = HELD_COUNTS,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to `max_words` words that reach the support, and each language's words.

    Written tables: lang, phrase, words, f; and lang, n.
    """
    table = written(blocks(docs, text, lang, block_bytes, shards), "phrase_blocks")
    totals = written(table.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase_totals")
    context = table.sparkSession.sparkContext
    cells = candidate_cells(table, support, max_words)
    tasks = counting_tasks(cells, totals.agg(F.sum("n")).first()[0] or 0, context.defaultParallelism)

    counts = _candidate_counts(table.coalesce(tasks), context.broadcast(cells), max_words, held_counts)
    # Blocks of a task are added up where they are counted, so rows are dealt as they come.
    summed = counts.repartition("phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= support)
    summed = summed.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "f")
    return written(summed, "frequent_phrases"), totals


def _joined(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Every phrase of two words or more with its weakest cut: lang, phrase, a, l, r, n, score.

    Phrases inside a longer one that is as frequent are left out. The parts of a
    frequent phrase are frequent, so their counts are in the table.
    """
    longer = frequent.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    words = F.split("phrase", " ")
    parts = cuts.withColumn("left", _joined(words, F.lit(1), F.col("k"))).withColumn(
        "right", _joined(words, F.col("k") + 1, F.col("words") - F.col("k"))
    )
    known = frequent.select("lang", "phrase", "f")
    left = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr("(cast(1000 * cast(a as decimal(19,0)) as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = parts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(checked_broadcast(totals), "lang")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda start: _joined(words, start, size)),
        )
    )
    inner = longer.filter("words > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("outer"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    return best.join(covered, ["lang", "phrase"], "left").filter("outer IS NULL OR outer < a").drop("outer")


def top_collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, top: int = TOP, **sizes: int
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    scored = collocations(*frequent_phrases(docs, text, lang, support, **sizes))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
