"""Suffix-array removal, MinHash and lattice links against brute force."""

import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from termlift.llm import bwt, components, lattice, minhash, shingles, suffix_dedup
from termlift.plans.scale import scratch_paths
from termlift.sources.tables import rows
from tests.llm.conftest import made, words


def brute_removal(texts, least):
    """Per document: bytes, removed bytes, runs, digest of the rest."""
    first, out = {}, []
    for i, text in enumerate(texts):
        body = (text or "").encode()
        mask = bytearray(len(body))
        for at in range(len(body) - least + 1):
            if first.setdefault(body[at : at + least], i) < i:
                mask[at : at + least] = b"\1" * least
        kept = bytes(c for c, gone in zip(body, mask) if not gone)
        runs = sum(1 for k, gone in enumerate(mask) if gone and not (k and mask[k - 1]))
        out.append((len(body), sum(mask), runs, hashlib.sha256(kept).hexdigest()))
    return out


def report(docs):
    got = suffix_dedup.removal_report(docs).collect()
    return [(row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256) for row in sorted(got, key=lambda row: row.doc_id)]


def test_removal_of_edge_cases(edge_docs, edge_texts, no_docs):
    assert report(edge_docs) == brute_removal(edge_texts, suffix_dedup.LEAST)
    assert suffix_dedup.removal_report(no_docs).count() == 0


@pytest.mark.parametrize("crowd", [3, 2000])
def test_removal_of_random_texts(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    dealer = random.Random(8)
    pool = [" ".join(words(25, seed)) for seed in range(6)]
    texts = []
    for _ in range(60):
        parts = [dealer.choice(pool)[dealer.randint(0, 40) :] if dealer.random() < 0.6 else " ".join(words(9, dealer.random())) for _ in range(4)]
        texts.append(("" if dealer.random() < 0.3 else " ").join(parts))
    assert report(made(spark, texts).repartition(5)) == brute_removal(texts, suffix_dedup.LEAST)


def test_equal_ids_keep_their_bytes_and_null_ids_are_last(spark):
    body = "".join(words(30, 1))
    docs = rows(spark, [(1, body), (1, body), (None, body)], "doc_id long, text string")
    got = sorted((row.doc_id is None, row.n_removed) for row in suffix_dedup.removal_report(docs).collect())
    assert got == [(False, 0), (False, 0), (True, len(body))]


def test_texts_without_repeats_keep_their_columns(spark):
    body = "é".join(words(40, 1))
    docs = made(spark, [body, "x" + body[:100] + "ü"])
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    assert [row.text for row in left.orderBy("doc_id").collect()][0] == body


def test_common_prefixes_equal_a_plain_search():
    dealer = random.Random(2)
    texts = [bytes(dealer.choice(b"ab") for _ in range(dealer.randint(1, 60))) for _ in range(20)]
    symbols, _ = bwt.marked(texts)
    order = bwt.suffix_order(symbols, 12)
    shared = bwt.common_prefixes(symbols, order, 12)
    suffixes = [tuple(np.roll(symbols, -at)[:12].tolist()) for at in order.tolist()]
    assert suffixes == sorted(suffixes)
    for place in range(1, len(order)):
        one, other = suffixes[place - 1], suffixes[place]
        length = next((k for k, (a, b) in enumerate(zip(one, other)) if a != b), min(len(one), len(other)))
        assert shared[place] == (length if length < 12 else bwt.UNSET)


def plain_set(text, width):
    found = (text or "").encode().lower().split()
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def smallest_reachable(count, links):
    root = list(range(count))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]


def brute_minhash(texts, width, percent):
    sets = [plain_set(text, width) for text in texts]
    links = [
        (a, b)
        for b in range(len(sets))
        for a in range(b)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    roots = smallest_reachable(len(sets), links)
    return [(len(sets[i]), roots[i], roots[i] == i) for i in range(len(sets))]


def minhash_rows(docs, **options):
    got = minhash.near_duplicates(docs, **options).collect()
    return [(row.n_shingles, row.component_id, row.kept) for row in sorted(got, key=lambda row: row.doc_id)]


def test_minhash_of_edge_cases(edge_docs, edge_texts, no_docs):
    assert minhash_rows(edge_docs) == brute_minhash(edge_texts, 3, 85)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_minhash_chains_of_near_copies(spark):
    """Each copy is near its neighbours only, so stars from one centre do not reach all."""
    dealer, texts = random.Random(4), []
    for family in range(6):
        body = words(150, 100 + family)
        for step in range(12):
            body = list(body)
            for _ in range(2):
                body[dealer.randrange(len(body))] = f"edit{family}x{step}x{dealer.random()}"
            texts.append(" ".join(body))
    dealer.shuffle(texts)
    assert minhash_rows(made(spark, texts)) == brute_minhash(texts, 3, 85)


def test_one_row_of_each_group_stays(spark):
    parts = words(80, 1)
    body, near = " ".join(parts), " ".join([*parts[:40], "changed", *parts[41:]])
    docs = made(spark, [body, near, "something else entirely", None, None]).union(made(spark, [body]))
    left = minhash.without_near_duplicates(docs, width=5, percent=80)
    assert left.columns == docs.columns
    assert sorted(row.doc_id for row in left.collect()) == [0, 2, 3, 4]


def test_long_texts_hash_as_short_ones(monkeypatch):
    text = " ".join(words(4000, 1)).encode()
    whole = shingles.word_hashes(text)
    monkeypatch.setattr(shingles, "SLICE_BYTES", 100)
    assert (shingles.word_hashes(text) == whole).all()
    assert len(set(whole.tolist())) == len(set(text.split()))


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 300)]
    star = [(5, i) for i in range(1000, 1200)]
    edges = rows(spark, [*path, *star, (7, 7), (9, 8), (8, 9)], "a long, b long")
    got = {row.node: row.component_id for row in components.components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 301)}, **{i: 5 for i in (5, *range(1000, 1200))}, 8: 8, 9: 8}
    assert components.components(rows(spark, [], "a long, b long")).count() == 0


def noisy(rng, centre, cosine):
    """A unit vector at the given cosine to a unit vector."""
    other = rng.standard_normal(len(centre))
    other -= other @ centre * centre
    return cosine * centre + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def test_lattice_recall_at_the_threshold(spark):
    rng = np.random.default_rng(1)
    vectors, labels = [], []
    for _ in range(400):
        centre = rng.standard_normal(64)
        centre /= np.linalg.norm(centre)
        vectors += [centre, noisy(rng, centre, rng.uniform(0.9301, 0.95))]
        labels += [1, 1]
    table = rows(spark, [(i, list(map(float, v)), label) for i, (v, label) in enumerate(zip(vectors, labels))], "vec_id long, embedding array<double>, label int")
    found = sum(row.n_links for row in lattice.near_duplicates(table).collect()) / 2
    matrix = np.array(vectors)
    true = (np.triu(matrix @ matrix.T / np.outer(*[np.linalg.norm(matrix, axis=1)] * 2), 1) >= 0.93).sum()
    assert 0.98 * true <= found <= true


def test_lattice_edge_cases(spark, no_docs):
    rng = np.random.default_rng(3)
    a, b, c = (list(map(float, rng.standard_normal(8))) for _ in range(3))
    nan, inf = float("nan"), float("inf")
    values = [
        (0, a, 1), (1, a, 1), (2, [2 * x for x in a], 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [0.0] * 8, 1),
        (7, [nan, *a[1:]], 1), (8, [inf, *a[1:]], 1), (9, [None, *a[1:]], 1), (10, b, 1), (11, c, 2), (12, a[:4], 1), (13, [], 1),
        (14, [1e300 * x for x in a], 1), (15, [1e-300 * x for x in a], 1),
    ]
    got = {row.vec_id: (row.n_links, row.component_id, row.kept) for row in lattice.near_duplicates(rows(spark, values, "vec_id long, embedding array<double>, label int")).collect()}
    near = {0, 1, 2, 14, 15}
    assert got == {i: (4, 0, i == 0) if i in near else (0, i, True) for i in range(16)}
    assert lattice.near_duplicates(rows(spark, [], "vec_id long, embedding array<double>, label int")).count() == 0


def test_lattice_counts_groups_of_copies(spark):
    a, b = [1.0, 0.0, 0.2, 0.0], [1.0, 0.0, 0.21, 0.0]
    values = [(i, a if i % 2 else b, 1) for i in range(40)]
    got = lattice.near_duplicates(rows(spark, values, "vec_id long, embedding array<double>, label int")).collect()
    assert {(row.n_links, row.component_id) for row in got} == {(39, 0)}


def test_nearest_lattice_point_is_the_nearest():
    rng = np.random.default_rng(0)
    points = rng.standard_normal((200, 8)) * 2
    found = lattice.nearest_e8(points)
    around = found[:, None, :] + lattice.roots()[None]
    own = ((points - found) ** 2).sum(axis=1)
    assert (own[:, None] <= ((points[:, None, :] - around) ** 2).sum(axis=2) + 1e-9).all()


@pytest.mark.parametrize("scale", [1e-300, 1e-200, 1.0, 1e200, 1e300])
def test_vectors_of_any_size_are_compared(spark, scale):
    """Near copies link and unlike vectors do not, however small or large the components are."""
    dealer = np.random.default_rng(5)
    base = dealer.standard_normal((6, 16))
    near = base + 0.01 * dealer.standard_normal((6, 16))
    vectors = np.concatenate([base, near]) * scale
    table = rows(spark, [(i, vector.tolist(), 1) for i, vector in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    got = {row.vec_id: (row.n_links, row.component_id) for row in lattice.near_duplicates(table).collect()}
    assert got == {i: (1, i % 6) for i in range(12)}


def grouped_vectors(rng, count, length):
    """Random vectors, two fifths of them in groups of near copies of several sizes."""
    made = rng.standard_normal((count, length))
    at = 0
    for size in (2, 3, 5, 12, count // 5):
        made[at : at + size] = made[at] + 0.15 * rng.standard_normal((size, length)) / np.sqrt(length) * np.linalg.norm(made[at])
        at += size
    return lattice.unit_rows(made[rng.permutation(count)])


def meeting_pairs(unit):
    """The pairs x < y at the threshold that meet in a cell of any table, from all pairs."""
    own, near = lattice.cells(unit, lattice.TABLES, lattice.PROBES, lattice.WIDTH)
    looks = np.zeros((len(unit), len(unit)), bool)
    for names, roots in zip(own, near):
        for probe in (None, *range(lattice.PROBES)):
            into = names if probe is None else names + lattice.names(lattice.roots())[roots[:, probe]]
            looks |= into[:, None] == names[None, :]
    return np.argwhere(np.triu((looks | looks.T) & (unit @ unit.T >= 0.93), 1))


def chunk_of(unit):
    own, near = lattice.cells(unit, lattice.TABLES, lattice.PROBES, lattice.WIDTH)
    ones = np.ones(len(unit), np.int64)
    return lattice.Chunk(pa.array(np.arange(len(unit))), ones, ones, unit, own, near, 0.93)


@pytest.mark.parametrize("count, length, batch", [(300, 8, 64), (2500, 12, 512), (700, 70, 1 << 15)])
def test_chunks_give_each_meeting_pair_once(monkeypatch, count, length, batch):
    monkeypatch.setattr(lattice, "BATCH", batch)
    unit = grouped_vectors(np.random.default_rng(length), count, length)
    want = [tuple(pair) for pair in meeting_pairs(unit).tolist()]
    assert len(want) > count
    alone = [tuple(sorted(pair)) for x, y in lattice.links_between(*[chunk_of(unit)] * 2) for pair in zip(x.tolist(), y.tolist())]
    assert sorted(alone) == want
    half = count // 3
    across = [(i, half + j) for x, y in lattice.links_between(chunk_of(unit[:half]), chunk_of(unit[half:])) for i, j in zip(x.tolist(), y.tolist())]
    assert sorted(across) == [(i, j) for i, j in want if i < half <= j]


def test_lattice_rounds_compare_every_two_chunks(spark):
    """Labels of five, four and one chunk, and one that shares its block, count the links of all pairs that meet."""
    rng = np.random.default_rng(11)
    values, want, start = [], {}, 0
    for label, count in enumerate((200, 150, 40, 3)):
        unit = grouped_vectors(rng, count, 16) if count > 40 else lattice.unit_rows(rng.standard_normal((1, 16)) + 0.02 * rng.standard_normal((count, 16)))
        links, root = np.zeros(count, int), np.arange(count)
        for x, y in meeting_pairs(unit):
            links[[x, y]] += 1
            root[root == max(root[x], root[y])] = min(root[x], root[y])
        values += [(start + i, vector.tolist(), label) for i, vector in enumerate(unit)]
        want |= {start + i: (links[i], start + root[i]) for i in range(count)}
        start += count
    table = rows(spark, values, "vec_id long, embedding array<double>, label int")
    blocks, most, _ = lattice._written_blocks(table, "vec_id", "embedding", "label", 8, 12, 1.1, 12_000, 1)
    assert most == 5 and {row.chunks for row in spark.read.parquet(blocks).select("chunks").distinct().collect()} == {1, 4, 5}
    got = lattice.near_duplicates(table, block_bytes=12_000, chunk_blocks=1).collect()
    assert {row.vec_id: (row.n_links, row.component_id) for row in got} == want


def test_lattice_keeps_less_than_four_times_its_input(spark, monkeypatch):
    """What it writes grows with the vectors, not with the cells that they look into nor the pairs that meet there."""
    monkeypatch.setattr(lattice, "delete_scratch", lambda spark, paths: None, raising=False)
    vectors = np.random.default_rng(12).standard_normal((4000, 64)).astype(np.float32)
    table = rows(spark, [(i, vector.tolist(), 1) for i, vector in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
    before = set(scratch_paths())
    assert lattice.near_duplicates(table).count() == 4000
    folders = [path.removeprefix("file:") for path in scratch_paths() if path not in before]
    kept = sum(os.path.getsize(os.path.join(folder, name)) for path in folders for folder, _, names in os.walk(path) for name in names)
    assert vectors.nbytes < kept < 4 * vectors.nbytes
