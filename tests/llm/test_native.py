"""Quality rules, sharding and license scans on edge cases, and against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from termlift.llm import licenses, quality, sharding
from termlift.sources.tables import rows
from tests.llm.conftest import made, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    found = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    repeated = {i + k for i, window in enumerate(windows) if windows.count(window) > 1 for k in range(8)} if len(windows) < 3000 else set()
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
        len(found) < 20 or 100 * len(repeated) > 30 * len(found),
    )


def test_quality_counts_equal_plain_python(spark, edge_docs, edge_texts, no_docs):
    extra = [" ".join(words(12, 9) * 3), "a b c d e f g h " * 2, "#tag *x* | $5 <b>\n" * 5, "x\x1cy z\x85w"]
    docs = edge_docs.union(made(spark, extra, start=100))
    got = {row.doc_id: tuple(row)[1:7] for row in quality.quality_report(docs).collect()}
    assert got == {i: plain_counts(text) for i, text in [*enumerate(edge_texts), *enumerate(extra, 100)]}
    assert quality.quality_report(no_docs).count() == 0
    assert quality.quality_filter(no_docs).columns == no_docs.columns


def test_fences_follow_each_group(spark):
    """Texts full of symbols are outliers among prose, and usual where most texts are like that."""
    prose = [(i, " ".join(words(60, i)), "en", "books") for i in range(80)]
    code = [(100 + i, " ".join(w + "|" for w in words(60, i)), "en", "tables") for i in range(80)]
    odd = [(200, " ".join(w + "|" for w in words(60, 500)), "en", "books"), (201, " ".join(w + "|" for w in words(60, 501)), None, None)]
    docs = rows(spark, prose + code + odd, "doc_id long, text string, lang string, source string")
    kept = {row.doc_id for row in quality.quality_filter(docs).collect()}
    assert kept == {*range(80), *range(100, 180), 201}


def test_every_rule_can_reject(spark):
    """One outlier of each measure among plain texts of eight lines; the base rule takes none of them."""
    plain = [" ".join(words(8, 10 * i + j)) for i in range(60) for j in range(8)]
    texts = ["\n".join(plain[8 * i : 8 * i + 8]) for i in range(60)]
    odd = {
        "symbols": texts[0].replace(" ", " # ", 9),
        "word_length": texts[1].replace(" ", ""),
        "repeats": " ".join(words(400, 7)) + (" " + " ".join(words(40, 8))) * 2,
        "dup_lines": "\n".join([texts[3], *["same line"] * 6]),
        "capitals": texts[4].upper(),
        "long words": " ".join(word * 9 for word in texts[5].split()),
    }
    docs = rows(spark, [(i, text, "en", "books") for i, text in enumerate([*texts, *odd.values()])], "doc_id long, text string, lang string, source string")
    got = {row.doc_id: row for row in quality.quality_report(docs).collect()}
    assert all(got[i].kept for i in range(60))
    rejected = {name: (got[60 + i].base_failed, got[60 + i].kept) for i, name in enumerate(odd)}
    assert rejected == {name: (name == "word_length", False) for name in odd}


def plain_fences(values, measure):
    """Fences of (lang, source, value) triples by counting, each language's values at the weight of PRIOR documents."""
    made = {}
    for lang, source in {v[:2] for v in values}:
        wide = [v[2] for v in values if v[0] == lang]
        own = [v[2] for v in values if v[:2] == (lang, source)]
        weighted = sorted([(v, len(wide)) for v in own] + [(v, quality.PRIOR) for v in wide])
        total = sum(weight for _, weight in weighted)

        def quantile(part, of):
            upto = 0
            for value, weight in weighted:
                upto += weight
                if upto * of >= total * part:
                    return value

        lower, middle, upper = quantile(1, 5), quantile(1, 2), quantile(4, 5)
        low = lower - quality.SPREAD * (middle - lower) if measure in quality.LOW_SIDE else 0
        made[lang, source] = (low, upper + quality.SPREAD * (upper - middle))
    return made


def test_fences_equal_plain_python(spark):
    """Sources of 1 to 90 documents, null keys among them: one rule at every size."""
    dealer = random.Random(5)
    groups = [("en", "a", 90), ("en", "b", 49), ("en", "c", 50), ("en", None, 1), (None, "a", 7), (None, None, 3), ("fr", "d", 1)]
    docs = []
    for lang, source, count in groups:
        for _ in range(count):
            text = " ".join(w.upper() if dealer.random() < 0.1 else w + "#" * (dealer.random() < 0.2) for w in words(30, dealer.random()))
            docs.append((len(docs), text, lang, source))
    measured = quality.features(rows(spark, docs, "doc_id long, text string, lang string, source string")).cache()
    got = {(row.q_lang, row.q_source): row.q_fences for row in quality.thresholds(measured).collect()}
    assert len(got) == len(groups)
    for name in quality.MEASURES:
        values = [tuple(row) for row in measured.select("lang", "source", quality.bucket(quality._value(name))).collect()]
        assert {key: tuple(fence[name]) for key, fence in got.items()} == plain_fences(values, name)


def test_bucket_is_at_most_a_thirty_second_too_low(spark):
    table = spark.range(0, 200_000, 7).select(F.col("id"), quality.bucket(F.col("id")).alias("b"))
    assert table.filter("b > id or id - b > id / 32").count() == 0
    assert table.select("b").distinct().count() < 500


def test_merged_sketches_equal_one_sketch(spark, edge_docs):
    measured = quality.features(edge_docs.select("text")).withColumn("k", F.lit(1)).cache()
    halves = [quality.sketches(part, ["k"]) for part in (measured.filter("q_n_words % 2 = 0"), measured.filter("q_n_words % 2 = 1"))]
    assert quality.merged(halves[0].union(halves[1]), ["k"]).exceptAll(quality.sketches(measured, ["k"])).count() == 0


def plain_shards(items, limit):
    """Bucket bits of every (id, bytes), by splitting a directory by hand."""
    bits = {i: bin(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16))[2:].zfill(60) for i, _ in items}

    def split(some, depth):
        if sum(size for _, size in some) <= limit or len({bits[i] for i, _ in some}) < 2:
            return {i: bits[i][:depth] for i, _ in some}
        halves = [[item for item in some if bits[item[0]][depth] == bit] for bit in "01"]
        return split(halves[0], depth + 1) | split(halves[1], depth + 1)

    return split(items, 0)


@pytest.mark.parametrize("limit", [1, 40, 500, 10**9])
def test_shards_equal_splitting_by_hand(spark, limit):
    sizes = [(i, (i * 37) % 90) for i in range(300)]
    docs = rows(spark, [(i, "x" * size, 0) for i, size in sizes], "doc_id long, text string, depth int")
    got = sharding.shard(docs, limit=limit).collect()
    assert {row.doc_id: row.s_shard for row in got} == plain_shards(sizes, limit)
    assert all(row.s_depth == len(row.s_shard) and row.s_bytes == len(row.text) for row in got)


def test_shards_of_edge_cases(spark, edge_docs, no_docs):
    docs = edge_docs.union(edge_docs).union(rows(spark, [(None, "x", None, None, None, None, None, None)], edge_docs.schema.simpleString()[7:-1].replace(":", " ")))
    got = sharding.shard(docs, limit=500)
    assert got.count() == docs.count() and set(docs.columns) < set(got.columns)
    totals = got.groupBy("s_shard", "s_oversized").agg(F.sum("s_bytes").alias("bytes"), F.countDistinct("doc_id").alias("ids"))
    assert totals.filter("bytes > 500 and (ids > 1 or not s_oversized)").count() == 0
    assert sharding.shard(no_docs).count() == 0


def test_shard_files(spark, tmp_path):
    docs = rows(spark, [(i, "y" * 50) for i in range(40)], "doc_id long, text string")
    sharding.write_shards(docs, str(tmp_path / "shards"), limit=300)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.select("doc_id").distinct().count() == 40
    assert back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).filter("n > 300").count() == 0


def plain_licenses(text):
    text = text or ""
    cut = lambda part: re.findall(r"[^\W_]+", part.lower())
    parts = re.split(r"\n[\x20\x09-\x0D]*\n", text)
    units = [line for part in parts for line in part.split("\n")] + [part for part in parts if "\n" in part] + [text] * (len(parts) > 1)
    best, hits = (0.0, None), 0
    for unit in units:
        found = cut(unit)
        grams = {f"{a} {b}" for a, b in zip(found, found[1:])} or set(found)
        scores = []
        for name, body in licenses.TEMPLATES.items():
            other = set(licenses.template_bigrams(body))
            dice = 2 * len(grams & other) / (len(grams) + len(other))
            if grams and dice >= licenses.PERCENT / 100:
                scores.append((dice, name))
        hits += bool(scores)
        for dice, name in scores:
            if dice > best[0] or dice == best[0] and (best[1] is None or name < best[1]):
                best = (dice, name)
    return best[1], best[0], hits


def test_licenses_equal_plain_python(spark, edge_docs, edge_texts, no_docs):
    extra = [
        "Some prose.\n\nReleased under the MIT licence, the MIT License.\nReleased under the MIT License.",
        "permission is hereby granted free of charge to any person\nobtaining a copy of this software and associated documentation\nfiles (the Software), to deal in the Software without restriction",
        "All rights reserved. All rights reserved. All rights reserved.",
        "ALL RIGHTS RESERVED",
        "\n\n \n\n",
        "Licensed under the Apache License, Version 2.0\n\nand more\n\n" + "Licensed under CC BY-NC 4.0.",
    ]
    docs = edge_docs.union(made(spark, extra, start=100))
    got = {row.doc_id: (row.l_license, row.l_dice, row.l_units) for row in licenses.scan(docs).collect()}
    texts = {**dict(enumerate(edge_texts)), **dict(enumerate(extra, 100))}
    for i, text in texts.items():
        if text is None or len(text) < 20_000:
            assert got[i] == plain_licenses(text), text
    assert len(got) == len(texts) and licenses.scan(no_docs).count() == 0


@pytest.mark.parametrize("run", [lambda docs: quality.quality_report(docs), lambda docs: licenses.scan(docs), lambda docs: sharding.shard(docs)])
def test_no_python_in_native_plans(edge_docs, run):
    plan = run(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_whole_license_texts_are_templates(spark):
    """Standard texts as they are placed: the MIT paragraph, BSD conditions with another holder, ISC, GNU texts."""
    text = {name: body for name, body in licenses.TEMPLATES.items() if name.endswith(" text")}
    mit = text["MIT text"].split("\n\n")[0]
    bsd = text["BSD-3-Clause text"].replace("the copyright holder nor", "Foo Inc. nor")
    docs = made(spark, [mit, mit.replace("\n", " "), bsd, *(body for _, body in sorted(text.items()))])
    got = {row.doc_id: row.l_license or "" for row in licenses.scan(docs).collect()}
    assert [got[i] for i in range(3)] == ["MIT permission", "MIT permission", "BSD-3-Clause text"]
    # Some texts hold their own notice, which is as similar.
    assert [got[i].split(" ")[0] for i in range(3, 3 + len(text))] == [name.split(" ")[0] for name in sorted(text)]


def test_notices_inside_longer_units(spark):
    """Notices within a line, before a further paragraph, in comment blocks, and in a long text on one line."""
    text = licenses.TEMPLATES
    block = "\n *\n".join("\n".join(f" * {line}" for line in part.split("\n")) for part in text["BSD-3-Clause text"].split("\n\n"))
    cases = {
        "Copyright 2020 Foo Inc. All rights reserved.": "Proprietary",
        "Copyright (c) 2020 Foo. Released under the MIT License.": "MIT",
        "This project is released under the MIT License.": "MIT",
        "Foo is made here.\n" + text["GPL-3.0 header"].replace("will", "\nwill"): "GPL-3.0 header",
        f"/*\n * Copyright Foo\n{block}\n */\n" + "\n".join(words(300, 11)): "BSD-3-Clause text",
        " ".join([*words(2000, 12), text["Apache-2.0 header"], *words(2000, 13)]): "Apache-2.0 header",
        " ".join([*words(500, 14), text["CC-BY-4.0"], *words(500, 15)]): "CC-BY-4.0",
        " ".join([*words(2000, 16), *text["GPL-3.0 text"].split(), *words(2000, 17)]): "GPL-3.0 text",
        " ".join([*words(100, 18), "released under a license", *words(100, 19)]): None,
    }
    got = {row.doc_id: row for row in licenses.scan(made(spark, list(cases))).collect()}
    assert [got[i].l_license for i in range(len(cases))] == list(cases.values())
    assert all(row.l_dice > 0.97 for row in got.values() if row.l_license)
    both = " ".join([*words(300, 20), "Foo. All rights reserved.", *words(300, 21), *text["ISC text"].split(), *words(300, 22)])
    assert licenses.scan(made(spark, [both])).first().l_found == ["ISC text", "Proprietary"]
