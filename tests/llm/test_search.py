"""Ranked search and phrase mining on edge cases, against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from termlift.llm import nra, phrases
from termlift.sources.tables import rows
from tests.llm.conftest import made, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def plain_search(documents, items, best):
    found = [(key, Counter(TERM.findall(lowered(text)))) for key, text in documents]
    found = [(key, terms) for key, terms in found if terms]
    many, total = len(found), sum(sum(terms.values()) for _, terms in found)
    df = Counter(term for _, terms in found for term in terms)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(TERM.findall(lowered(text)))
    out = []
    for item, terms in asked.items():
        scores = []
        for key, counts in found:
            m = 100 - 50 + (50 * sum(counts.values()) * many) // total
            score = sum(
                math.floor(1000 * math.log((2 * many + 2) / (2 * df[term] + 1))) * ((1_000_000_000 * counts[term]) // (1000 * counts[term] + 20 * m))
                for term in terms
                if counts[term]
            )
            if score > 0:
                scores.append((-score, key is None, key))
        scores.sort(key=lambda one: (one[0], one[1], one[2] or 0))
        out += [(item, rank, key, -score) for rank, (score, _, key) in enumerate(scores[:best], 1)]
    return out


def by_rank(row):
    return (row[0] is None, row[0] or 0, row[1])


def searched(docs, items, **options):
    return sorted((tuple(row) for row in nra.search(docs, items, **options).collect()), key=by_rank)


@pytest.mark.parametrize("options", [{}, {"block_documents": 7, "best": 3}, {"block_bytes": 900, "part_bytes": 200, "best": 5}])
def test_search_equals_plain_python(spark, edge_docs, edge_texts, no_docs, options):
    dealer = random.Random(6)
    pool = words(40, 8)
    texts = [" ".join(dealer.choices(pool, k=dealer.randint(1, 60))) for _ in range(80)]
    texts += [texts[0]] * 9 + ["Same Terms", "same, terms!"] * 6
    extra = [(100 + i, text) for i, text in enumerate(texts)] + [(100, texts[1]), (None, texts[0]), (None, "same terms")]
    docs = edge_docs.select("doc_id", "text").union(rows(spark, extra, "doc_id long, text string")).repartition(3)
    items = [(i, " ".join(dealer.choices(pool, k=12))) for i in range(6)]
    items += [(6, None), (7, ""), (8, "same same terms"), (9, "nowhere"), (10, "HÉÉ 日本語 one"), (0, "terms"), (None, pool[0])]
    table = rows(spark, [(*item, "x") for item in items], "item_id long, text string, doc_id string")
    expected = plain_search([*enumerate(edge_texts), *extra], items, options.get("best", nra.BEST))
    assert searched(docs, table, **options) == sorted(expected, key=by_rank)
    assert searched(no_docs, table) == [] and searched(docs, table.limit(0)) == []


def test_reading_stops_early_and_is_exact(monkeypatch):
    """Lists of falling scores: the bound is met long before their ends, and ties at it are all found."""
    dealer = np.random.default_rng(2)
    for trial in range(60):
        size, lists = int(dealer.integers(1, 400)), []
        for _ in range(int(dealer.integers(1, 6))):
            docs = dealer.permutation(size)[: int(dealer.integers(0, size + 1))]
            lists.append((docs, -np.sort(-dealer.integers(1, 12 if trial % 2 else 10_000, len(docs)))))
        total = np.zeros(size, np.int64)
        for docs, scores in lists:
            total[docs] += scores
        best = int(dealer.integers(1, 20))
        bound = max(1, np.sort(total)[-best] if size > best else 1)
        names, scores = nra.best_by_nra(lists, size, best, first_step=4)
        order = np.argsort(names)
        assert np.array_equal(names[order], np.flatnonzero(total >= bound))
        assert np.array_equal(scores[order], total[total >= bound])


def plain_phrases(documents, support, top):
    out = []
    langs = {}
    for text, lang in documents:
        pieces = [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text))]
        langs.setdefault(lang or "und", []).extend(pieces)
    for lang, pieces in langs.items():
        n = sum(map(len, pieces))
        f = Counter(tuple(p[i : i + k]) for p in pieces for k in range(1, 6) for i in range(len(p) - k + 1))
        frequent = {phrase: times for phrase, times in f.items() if times >= support}
        longest = Counter()
        for phrase, times in frequent.items():
            for k in range(2, len(phrase)):
                for i in range(len(phrase) - k + 1):
                    inner = phrase[i : i + k]
                    longest[inner] = max(longest[inner], times)
        scored = []
        for phrase, a in frequent.items():
            if len(phrase) > 1 and longest[phrase] < a:
                score, k = min(((1000 * a * n) // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase)))
                scored.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n, -score) for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 2000, "shards": 3}, {"block_bytes": 400, "shards": 32}, {"block_bytes": 400, "held_counts": 50}])
def test_phrases_equal_plain_python(spark, edge_texts, options):
    dealer = random.Random(9)
    pool = ["the", "of", "new", "york", "city", "Ünder", "x\x00y", "a-b", " z", "Z"] + words(6, 1)
    texts = ["".join(dealer.choice(pool) + dealer.choice([" ", " ", "  ", "\t", ", ", "\n", ". "]) for _ in range(dealer.randint(1, 90))) for _ in range(600)]
    documents = [(text, dealer.choice(["en", "fr", None, "und"])) for text in texts] + [(text, "en") for text in edge_texts] + [(edge_texts[7], None)] * 12
    table = rows(spark, [(*one, 1, "x") for one in documents], "text string, lang string, n long, phrase string").repartition(4)
    got = phrases.top_collocations(table, support=11, top=40, **options).collect()
    expected = plain_phrases(documents, 11, 40)
    assert len(expected) > 60 and sorted(map(tuple, got)) == expected


def test_no_phrases(spark, no_docs):
    assert phrases.top_collocations(no_docs).count() == 0
    assert phrases.top_collocations(made(spark, [None, "", " . ", "one two"])).count() == 0


def test_local_supports_cover_the_support(spark):
    """Rounded up per shard, they never exceed what one shard must hold of a frequent phrase."""
    table = rows(spark, [("en", 0, 10), ("en", 0, 7), ("en", 1, 983), ("fr", 1, 1), ("de", 2, 0)], "lang string, shard int, n_words long")
    got = {(row.lang, row.shard): row.least for row in phrases.local_supports(table, 100).collect()}
    assert got == {("en", 0): 2, ("en", 1): 99, ("fr", 1): 100}


def test_long_text_is_numbered_in_slices(monkeypatch):
    text = " ".join(words(500, 3)) + ", " + "x" * 300 + " end"
    whole = phrases.numbered([text.encode()])
    monkeypatch.setattr(phrases, "SLICE_BYTES", 50)
    cut = phrases.numbered([text.encode()])
    assert np.array_equal(whole[0], cut[0]) and whole[1] == cut[1]


def test_equal_hashes_are_counted_apart():
    """Two phrases in one hash: the words decide."""
    block = object.__new__(phrases.Block)
    block.numbers = np.array([2, 3, 0, 4, 5, 0, 2, 3, 0], np.int32)
    first, times = block.counted(2, np.array([0, 3, 6]), np.array([9, 9, 9], np.uint64))
    assert sorted(zip(first.tolist(), times.tolist())) == [(0, 2), (3, 1)]


def test_phrases_short_of_the_support_are_not_counted(spark):
    text = F.when(F.col("id") == 0, "x y x y x y").otherwise("p q p q p q p q")
    table = phrases.blocks(spark.range(0, 4, 1, 4).select(text.alias("text"), F.lit("en").alias("lang"))).persist()
    assert {row.least for row in phrases.local_supports(table, 8).collect()} == {2, 3}
    cells = spark.sparkContext.broadcast(phrases.candidate_cells(table, 8, 5))
    found = {row.phrase for row in phrases._candidate_counts(table, cells, 5, 1000).collect()}
    table.unpersist()
    assert found == {"p", "q", "p q", "q p", "p q p", "q p q", "p q p q"}


def test_last_pass_gives_a_phrase_once_a_core(spark, monkeypatch):
    monkeypatch.setattr(phrases, "WORDS_PER_COUNT", 1 << 30)
    docs = spark.range(0, 200, 1, 40).select(F.lit("alpha beta gamma").alias("text"), F.lit("en").alias("lang"))
    counted, last = phrases._candidate_counts, []
    monkeypatch.setattr(phrases, "_candidate_counts", lambda *given: last.append(counted(*given)) or last[0])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        frequent, _ = phrases.frequent_phrases(docs)
        assert {(row.phrase, row.f) for row in frequent.collect()} == {(p, 200) for p in ("alpha", "beta", "gamma", "alpha beta", "beta gamma", "alpha beta gamma")}
        assert last[0].count() <= 6 * spark.sparkContext.defaultParallelism < 6 * 40
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    cells = np.array([3, 1 << 63], np.uint64)
    assert phrases.counting_tasks(cells, (1 << 30) * 3 * 7, 4) == 7 and phrases.counting_tasks(cells[:0], 0, 4) == 4
