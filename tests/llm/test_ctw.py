"""Context-tree weighting against a recursive definition in exact fractions."""

import math
import random
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from termlift.llm import ctw
from tests.llm.conftest import made, words


def kt(zeros, ones):
    value = Fraction(1)
    for i in range(zeros):
        value *= Fraction(2 * i + 1, 2)
    for i in range(ones):
        value *= Fraction(2 * i + 1, 2)
    return value / math.factorial(zeros + ones)


def plain_model(texts, depth):
    """log10 of the probability of a text, by the recursion over contexts and decisions."""
    counts = Counter()

    def events(text):
        body = bytes([ctw.END]) * depth + text + bytes([ctw.END])
        for at in range(depth, len(body)):
            node = 1
            for shift in range(7, -1, -1):
                bit = body[at] >> shift & 1
                yield body[at - depth : at], node, bit
                node = 2 * node + bit

    for text in texts:
        for context, node, bit in events(text):
            for length in range(depth + 1):
                counts[context[depth - length :], node, bit] += 1
    contexts = {(context, node) for context, node, _ in counts}
    longer = {}
    for context, node in contexts:
        if context:
            longer.setdefault((context[1:], node), []).append(context)
    weighted = {}

    def weight(context, node):
        if (context, node) not in weighted:
            own = kt(counts[context, node, 0], counts[context, node, 1])
            if len(context) < depth:
                rest = math.prod(weight(one, node)[0] for one in longer[context, node])
                weighted[context, node] = ((own + rest) / 2, own / (own + rest))
            else:
                weighted[context, node] = (own, Fraction(1))
        return weighted[context, node]

    def probability(context, node, bit):
        total, left, last = Fraction(0), Fraction(1), Fraction(1, 2)
        for length in range(depth + 1):
            short = context[depth - length :]
            if (short, node) not in contexts:
                break
            _, own = weight(short, node)
            zeros, ones = counts[short, node, 0], counts[short, node, 1]
            last = Fraction(2 * (ones if bit else zeros) + 1, 2 * (zeros + ones + 1))
            total, left = total + left * own * last, left * (1 - own)
        return total + left * last

    return lambda text: sum(math.log10(probability(*event)) for event in events(text))


def held(i):
    return zlib.crc32(str(i).encode()) % 10 == 0


def test_scores_equal_the_recursion(spark):
    dealer = random.Random(1)
    texts = [" ".join(dealer.choice(["ab", "abc", "bca", "é"]) for _ in range(dealer.randint(0, 6))) for _ in range(40)]
    texts[5:7] = [None, ""]
    bodies = [(text or "").encode() for text in texts]
    train = [body for i, body in enumerate(bodies) if not held(i)]
    model = plain_model(train, ctw.DEPTH)
    tokens = [[*body.lower().split(), None] for body in bodies]
    known = Counter(token for i, some in enumerate(tokens) if not held(i) for token in some)
    total = sum(known.values())
    got = {row.doc_id: row for row in ctw.scores(made(spark, texts).repartition(3)).collect()}
    assert len(got) == len(texts)
    for i, some in enumerate(tokens):
        base = sum(math.log10((known[token] + 0.1) / (total + 0.1 * (len(known) + 1))) for token in some)
        row = got[i]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held(i), len(some), total)
        assert row.n_known == sum(known[token] > 0 for token in some)
        assert row.base_score == pytest.approx(base)
        assert row.score == pytest.approx(model(bodies[i]), rel=1e-5)
        assert row.n_bytes == len(bodies[i])
        rate = -row.score / math.log10(2) / len(bodies[i]) if bodies[i] else None
        assert row.bits_per_byte == (pytest.approx(rate) if bodies[i] else None)


def test_probabilities_of_the_next_byte_sum_to_one():
    dealer = random.Random(2)
    grams = np.concatenate([ctw.ngrams(bytes(dealer.choice(b"abc ") for _ in range(200))) for _ in range(5)])
    keys, counts = np.unique(grams, return_counts=True)
    upper = {}
    for bucket in np.unique(ctw.bucket_of(keys)):
        some = ctw.bucket_of(keys) == bucket
        level = ctw.local_levels(keys[some], counts[some])[0]
        names, zeros, ones, weighted = ctw._sums(ctw.cut_to(level.names, 1), level.zeros, level.ones, level.weighted)
        for name, *values in zip(names.tolist(), zeros, ones, weighted):
            at = upper.setdefault((name >> 8 * ctw.DEPTH, name & 255), [0, 0, 0.0])
            upper[name >> 8 * ctw.DEPTH, name & 255] = [a + b for a, b in zip(at, values)]
    columns = [*zip(*upper)], [*zip(*upper.values())]
    made_of = ctw.Upper(*(np.array(column) for column in (*columns[0], *columns[1])))
    for context in (keys[0], keys[-1], np.uint64(0x7A7A7A7A7A00)):
        every = (context & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
        some = ctw.bucket_of(keys) == ctw.bucket_of(every[:1])[0]
        levels = ctw.local_levels(keys[some], counts[some]) if some.any() else []
        assert 2 ** ctw.log_probabilities(every, levels, made_of) @ np.ones(256) == pytest.approx(1.0)


def test_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = ctw.scores(docs).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert sums["sum(score)"] > sums["sum(base_score)"]


def test_edge_cases(spark, edge_docs, edge_texts, no_docs):
    got = ctw.scores(edge_docs.withColumnRenamed("doc_id", "id2").withColumnRenamed("id2", "doc_id")).collect()
    assert len(got) == len(edge_texts) and all(math.isfinite(row.score) and row.score < 0 for row in got)
    assert ctw.scores(no_docs).count() == 0
    held_only = made(spark, ["nothing to learn from"], start=next(i for i in range(100) if held(i)))
    row = ctw.scores(held_only).first()
    assert (row.train_tokens, row.n_known, row.base_score) == (0, 0, None)
    assert row.score == pytest.approx(-(len("nothing to learn from") + 1) * 8 * math.log10(2))
    assert row.bits_per_byte == pytest.approx(8 * 22 / 21)


def test_log_estimates_of_large_counts():
    zeros, ones = np.array([0, 3, 63, 64, 1000, 10**9]), np.array([0, 0, 1, 64, 5, 10**9 + 1])
    expected = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1) for a, b in zip(zeros.tolist(), ones.tolist())]
    assert ctw.log_estimate(zeros, ones) == pytest.approx(expected, rel=1e-9, abs=1e-9)


def test_keys_of_groups_are_counted_and_looked_up(monkeypatch):
    monkeypatch.setattr(ctw, "GROUP_BYTES", 40)
    random.seed(5)
    texts = [bytes(random.choices(b"ab c", k=random.randrange(30))) for _ in range(60)] + [b""]
    held = [at % 3 == 0 for at in range(len(texts))]
    learned = Counter(key for text, out in zip(texts, held) if not out for key in ctw.ngrams(text).tolist())
    keys, counts = ctw._distinct(texts, ctw.ngrams, held)
    assert keys.tolist() == sorted({key for text in texts for key in ctw.ngrams(text).tolist()})
    assert counts.tolist() == [learned[key] for key in keys.tolist()]
    assert ctw._sorted_unique(keys[::-1].repeat(2)).tolist() == keys.tolist() and not len(ctw._sorted_unique(keys[:0]))
    found, places = ctw._by_bucket(keys, ctw.bucket_of(keys))
    replies = {int(one): ctw.squeezed(counts[at]) for one, at in zip(found, places)}
    answers = ctw._looked_up(texts, ctw.ngrams, ctw.bucket_of, replies, np.int64)
    assert [answer.tolist() for answer in answers] == [[learned[key] for key in sorted(ctw.ngrams(text).tolist())] for text in texts]


def peak_of(job):
    """What a call gives, and the most bytes that it held at a time."""
    tracemalloc.start()
    try:
        return job(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_bucket_follows_its_distinct_nodes(monkeypatch):
    dealer = np.random.default_rng(6)
    contexts = np.uint64(0x6162 << 24) + dealer.integers(0, 2000, 200_000).astype(np.uint64) << np.uint64(8)
    keys, counts = np.unique(contexts | dealer.integers(0, 256, 200_000).astype(np.uint64), return_counts=True)
    levels, peak = peak_of(lambda: ctw.local_levels(keys, counts))
    names, bits = ctw.decisions(keys)
    each, bit = np.repeat(counts, 8), bits.ravel()
    for got, expected in zip((levels[-1].names, levels[-1].zeros, levels[-1].ones), ctw._sums(names.ravel(), np.where(bit, 0, each), np.where(bit, each, 0))):
        assert np.array_equal(got, expected)
    assert peak < 20 * levels[-1].names.nbytes
    upper = ctw.Upper(*(np.zeros(1, kind) for kind in (int, int, int, int, float)))
    logs, peak = peak_of(lambda: ctw.log_probabilities(keys, levels, upper))
    assert peak < 400 * len(keys)
    monkeypatch.setattr(ctw, "KEYS_AT_ONCE", len(keys))
    assert np.array_equal(logs, ctw.log_probabilities(keys, levels, upper)) and not len(ctw.log_probabilities(keys[:0], levels, upper))


def test_counts_are_added_up_while_they_come(monkeypatch):
    monkeypatch.setattr(ctw, "COUNTS_AT_ONCE", 1000)
    keys = np.arange(1000, dtype=np.uint64)
    (found, counts), peak = peak_of(lambda: ctw._added_up((keys.copy(), np.ones(1000, np.int64)) for _ in range(300)))
    assert np.array_equal(found, keys) and set(counts.tolist()) == {300}
    assert peak < 30 * keys.nbytes
