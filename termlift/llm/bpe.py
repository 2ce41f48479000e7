"""Byte-pair encoding with forced boundaries.

A pair of neighbouring bytes that no vocabulary token contains can never be
merged across, so a text may be cut there, its fragments encoded on their own,
and the ids joined. Cuts are taken only where the split pattern cannot look
across them either: after an ASCII byte that is no white space, and not before
an apostrophe. Fragments are about a word long and repeat, so each task encodes
each distinct one once and looks the others up.

The vocabulary is a `tokenizers` file of a byte-level BPE. Its merges must be
numbered in the order of their ids, which is checked when it is read.

Defined results: a null text is encoded as an empty one, to no ids; bytes that
are not UTF-8 are read as U+FFFD; special tokens in a text become their ids, as
the library does by default; texts without any cut are one fragment.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
APOSTROPHE = ord("'")
# A task keeps the ids of this many fragments, then starts anew; longer fragments are not kept.
KEPT_FRAGMENTS = 400_000
KEPT_BYTES = 48
# Cutting works on slices of about this many bytes, to bound the arrays made from a batch.
SLICE_BYTES = 1 << 20


def byte_characters() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others follow from U+0100 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


class Vocabulary(dict):
    """Maps fragments to their ids (little-endian unsigned 32-bit), encoding those it has not seen."""

    def __init__(self, definition: str) -> None:
        super().__init__()
        parsed = json.loads(definition)
        stand_in = byte_characters()
        special = {token["content"]: token["id"] for token in parsed["added_tokens"]}
        vocab = {word: i for word, i in parsed["model"]["vocab"].items() if word not in special}
        ranks = {bytes(stand_in[c] for c in word): i for word, i in vocab.items()}
        made = ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in parsed["model"]["merges"]]
        if [vocab[word] for word in made] != sorted(vocab[word] for word in made):
            raise ValueError("the merges are not numbered in the order of their ids")
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = frozenset(special)
        self.pieces = {i: token for token, i in ranks.items()} | {i: word.encode() for word, i in special.items()}
        self.forced = self._forced([*ranks, *(word.encode() for word in special)])
        self.kept = 0

    @staticmethod
    def _forced(tokens: list[bytes]) -> np.ndarray:
        """True for every pair of bytes, as `left * 256 + right`, that is a certain cut."""
        cut = np.ones((256, 256), bool)
        for token in tokens:
            codes = np.frombuffer(token, np.uint8)
            cut[codes[:-1], codes[1:]] = False
        cut[128:] = False
        cut[[byte for byte in range(128) if chr(byte).isspace()]] = False
        cut[:, APOSTROPHE] = False
        return cut.reshape(-1)

    def __missing__(self, fragment: bytes) -> bytes:
        text = fragment.decode("utf-8", "replace")
        if any(word in text for word in self.special):
            ids = self.encoding.encode(text, allowed_special=self.special)
        else:
            ids = self.encoding.encode_ordinary(text)
        packed = np.array(ids, "<u4").tobytes()
        if len(fragment) <= KEPT_BYTES:
            if self.kept >= KEPT_FRAGMENTS:
                self.clear()
                self.kept = 0
            self.kept += 1
            self[fragment] = packed
        return packed

    def encode(self, text: bytes) -> bytes:
        """All ids of a text."""
        parts = []
        start = 0
        for at in range(0, len(text), SLICE_BYTES):
            codes = np.frombuffer(text, np.uint8, min(SLICE_BYTES + 1, len(text) - at), at)
            pairs = codes[:-1].astype(np.uint16) << 8 | codes[1:]
            cuts = [start, *(np.flatnonzero(self.forced[pairs]) + (at + 1)).tolist()]
            parts += [self[text[left:right]] for left, right in zip(cuts, cuts[1:])]
            start = cuts[-1]
        if start < len(text):
            parts.append(self[text[start:]])
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        """The text of the ids, in UTF-8."""
        joined = b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return joined.decode("utf-8", "replace").encode()


@functools.lru_cache(maxsize=2)
def vocabulary(definition: str) -> Vocabulary:
    """One vocabulary per worker process, shared by its tasks."""
    return Vocabulary(definition)


def read_definition(path: str) -> str:
    """The tokenizer file, read on the driver; its size is that of a vocabulary and does not grow with the data."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def texts_as_bytes(docs: DataFrame, text: str = "text", *keys: str) -> DataFrame:
    """Key columns and the UTF-8 bytes of each text, empty for null, as `b_text`."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("b_text")
    return docs.select(*(F.col(key) for key in keys), body)


def with_ids(docs: DataFrame, definition: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's key, ids (binary, little-endian unsigned 32-bit) and text decoded from them (binary)."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    rows = texts_as_bytes(docs, text, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [vocab.encode(value.as_buffer().to_pybytes()) for value in part["b_text"]]
                texts = [vocab.decode(value) for value in ids]
                columns = [part[key], pa.array(ids, pa.large_binary()), pa.array(texts, pa.large_binary())]
                yield pa.RecordBatch.from_arrays([columns[0], columns[1].cast(pa.binary()), columns[2].cast(pa.binary())], [key, "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, ids binary, decoded binary")


def encoding_digests(docs: DataFrame, definition: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Length and digests of each document's ids and of the text decoded from them.

    Digests are taken where the ids are made, so that neither ids nor texts leave the task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    rows = texts_as_bytes(docs, text, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(shared.value)
        for batch in batches:
            sizes, id_digests, text_digests = [], [], []
            for value in batch["b_text"]:
                ids = vocab.encode(value.as_buffer().to_pybytes())
                sizes.append(len(ids) // 4)
                id_digests.append(hashlib.sha256(ids).hexdigest())
                text_digests.append(hashlib.sha256(vocab.decode(ids)).hexdigest())
            columns = [batch[key], pa.array(sizes, pa.int64()), pa.array(id_digests), pa.array(text_digests)]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
