"""Encoding, token counts and packing against the tokenizers library."""

import hashlib
import random
import struct
import zlib

import pytest
from tokenizers import Tokenizer

from termlift.llm import bpe, packing, token_counts
from termlift.llm.queries import TOKENIZER
from tests.llm.conftest import made

ALPHABET = ["a", "B", "é", "ß", "\n", "  ", " ", "\t", "'s", "'", "don't", "can'T", "!", "!!'", "...", "12", "3", "<|endoftext|>", "<|", "日本", "😀", "　", "\xa0", "\x85", "\x00", "_", "q", "Z", "'ll", "\r\n", "\x1c", " '"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def definition():
    return bpe.read_definition(TOKENIZER)


def expected_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_random_texts_encode_as_the_library_does(library, definition):
    vocabulary, dealer = bpe.Vocabulary(definition), random.Random(5)
    for _ in range(3000):
        text = "".join(dealer.choice(ALPHABET) for _ in range(dealer.randint(0, 14)))
        ids = packed(expected_ids(library, text))
        assert vocabulary.encode(text.encode()) == ids, text
        assert vocabulary.decode(ids) == text.encode()


def test_slices_do_not_show(library, definition, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_BYTES", 7)
    monkeypatch.setattr(bpe, "KEPT_FRAGMENTS", 3)
    text = "It's a long text, isn't it?\n\n  Yes — 12,345 naïve cafés!" * 3
    assert bpe.Vocabulary(definition).encode(text.encode()) == packed(expected_ids(library, text))


def test_digests_of_edge_cases(edge_docs, edge_texts, no_docs, library, definition):
    got = {row.doc_id: row for row in bpe.encoding_digests(edge_docs, definition).collect()}
    assert len(got) == len(edge_texts)
    for i, text in enumerate(edge_texts):
        ids = expected_ids(library, text)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encoding_digests(no_docs, definition).count() == 0


def test_ids_and_texts_round_trip(edge_docs, edge_texts, definition):
    got = {row.doc_id: bytes(row.decoded) for row in bpe.with_ids(edge_docs, definition).collect()}
    assert got == {i: (text or "").encode() for i, text in enumerate(edge_texts)}


def test_histogram_answers(edge_docs, edge_texts, no_docs, library, definition, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 16)
    sizes = [len(expected_ids(library, text)) for text in edge_texts]
    sums = token_counts.token_counts(edge_docs, definition).cache()
    for row in sums.collect():
        longer = [size for size in sizes if size >= row.n_tokens]
        assert (row.docs, row.docs_from, row.tokens_from) == (sizes.count(row.n_tokens), len(longer), sum(longer))
        assert row.truncated_total == sum(min(size, row.n_tokens) for size in sizes)
    for limit in (0, 1, 7, 64, 100_000, 10_000_000):
        assert token_counts.truncated_total(sums, limit).first()[0] == sum(min(size, limit) for size in sizes)
    assert token_counts.quantile(sums, 0.5).first()[0] == sorted(sizes)[(len(sizes) - 1) // 2]
    empty = token_counts.token_counts(no_docs, definition)
    assert empty.count() == 0 and token_counts.truncated_total(empty, 9).first()[0] == 0


def check_packing(rows, ids_of, capacity):
    by_sequence, by_document = {}, {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append(row)
        by_document.setdefault(row.doc_id, []).append(row)
    for parts in by_sequence.values():
        at = 0
        for part in sorted(parts, key=lambda part: part.offset):
            assert part.offset == at and part.length > 0
            at += part.length
        assert at <= capacity
    for doc, ids in ids_of.items():
        whole = [*ids, packing.END_ID]
        at = 0
        for part in sorted(by_document.pop(doc), key=lambda part: part.start):
            assert part.start == at and part.doc_tokens == len(whole)
            assert part.ids_crc32 == zlib.crc32(packed(whole[at : at + part.length]))
            at += part.length
        assert at == len(whole)
    assert not by_document
    return len(by_sequence)


def test_every_id_is_packed_once(edge_docs, edge_texts, no_docs, library, definition):
    ids_of = {i: expected_ids(library, text) for i, text in enumerate(edge_texts)}
    count = check_packing(packing.pack(edge_docs, definition).collect(), ids_of, packing.SEQUENCE)
    total = sum(len(ids) + 1 for ids in ids_of.values())
    assert count <= -(-total // packing.SEQUENCE) + 1
    assert packing.pack(no_docs, definition).count() == 0


def test_groups_are_packed_apart(spark, definition, library):
    texts = [f"document {i} " + "word " * (i % 90) for i in range(300)]
    docs = made(spark, texts)
    rows = packing.packed(packing.written(packing.pieces(docs, definition, capacity=64), "pieces"), capacity=64, group_pieces=50).collect()
    check_packing(rows, {i: expected_ids(library, text) for i, text in enumerate(texts)}, 64)


def test_repeated_rows_are_packed_each(spark, definition):
    docs = made(spark, ["same text"]).union(made(spark, ["same text"]))
    rows = packing.pack(docs, definition).collect()
    assert len(rows) == 2 and len({(row.sequence_id, row.offset) for row in rows}) == 2


def test_first_fit_equals_a_plain_search():
    dealer = random.Random(3)
    for _ in range(50):
        sizes = sorted((dealer.randint(1, 64) for _ in range(dealer.randint(1, 70))), reverse=True)
        room, expected = [], []
        for size in sizes:
            place = next((i for i, free in enumerate(room) if free >= size), len(room))
            if place == len(room):
                room.append(64)
            expected.append((place, 64 - room[place]))
            room[place] -= size
        assert list(zip(*packing.first_fit(sizes, 64))) == expected
