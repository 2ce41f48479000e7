"""SpotSigs fingerprints, the next document and the similarity join against brute force."""

import hashlib
import random

import pytest

from termlift.llm import spotsigs
from termlift.sources.tables import rows
from tests.llm.conftest import made, words

SPOTS = spotsigs.ANCHORS


def prose(count, seed):
    """Words with a common one between some of them."""
    dealer = random.Random(seed)
    return " ".join(word if dealer.random() < 0.6 else dealer.choice(SPOTS) for word in words(count, seed))


def plain_words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    kept = "".join(c if not c.isascii() or c.isalnum() else " " for c in lower)
    return [w for w in kept.split(" ") if w] or [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]


def plain_chains(text):
    """The chains themselves, as tuples."""
    found = plain_words(text)
    common = set(SPOTS)
    if not any(word not in common for word in found):
        return {("all", *found)} if found else set()
    chains = set()
    for place in range(-1, len(found)):
        if place < 0 or found[place] in common:
            content = [word for word in found[place + 1 :] if word not in common][: spotsigs.CHAIN]
            if content:
                chains.add((found[place] if place >= 0 else None, *content))
    return chains


def jaccard(one, other):
    return len(one & other) / len(one | other) if one | other else 1.0


def plain_rows(documents):
    """The contract's rows, from (id, text) pairs."""
    order = sorted(documents, key=lambda d: (d[0] is None, -(d[0] or 0), (d[1] or "").encode()))
    out = []
    for place, (key, text) in enumerate(order):
        text, following = text or "", order[(place + 1) % len(order)][1] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        near = (jaccard(plain_chains(text), plain_chains(other)) for other in (changed, following))
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), *near))
    return out


def by_key(row):
    return (row[0] is None, row[0] or 0, row[1:])


def followed(docs, **options):
    got = spotsigs.followed(docs, **options).collect()
    assert all(len(row.fingerprint) == 8 * row.n_signatures for row in got)
    return [(row.doc_id, row.n_chars, row.edited_sha256, row.near_edited, row.near_next) for row in got]


@pytest.mark.parametrize("text", ["", "one", "the of and", "!!! ???", "The Cat sat on the mat", "héé the ñandú, and 日本語 😀", prose(300, 5)])
def test_signatures_are_the_chains(text):
    assert len(spotsigs.signatures(text.encode())) == len(plain_chains(text))


@pytest.mark.parametrize("range_bytes", [500, 1 << 20])
def test_rows_equal_plain_python(spark, edge_docs, edge_texts, no_docs, range_bytes):
    extra = [(i, prose(60, i)) for i in range(100, 130)]
    extra += [(100, prose(60, 100)), (100, "again"), (None, "no id"), (None, None)]
    schema = "doc_id long, text string"
    docs = edge_docs.select("doc_id", "text").union(rows(spark, extra, schema)).repartition(3)
    expected = plain_rows([*enumerate(edge_texts), *extra])
    assert sorted(followed(docs, range_bytes=range_bytes), key=by_key) == sorted(expected, key=by_key)
    assert followed(no_docs) == []
    assert followed(rows(spark, [(7, "the only one")], schema)) == plain_rows([(7, "the only one")])


def test_equal_texts_have_equal_fingerprints(edge_docs, edge_texts):
    got = {row.doc_id: row.fingerprint for row in spotsigs.followed(edge_docs).collect()}
    for i, one in enumerate(edge_texts):
        for j, other in enumerate(edge_texts):
            assert (got[i] == got[j]) == (plain_chains(one) == plain_chains(other))


def test_pruned_comparison_equals_the_similarity():
    dealer = random.Random(3)
    for _ in range(300):
        one = spotsigs.signatures(prose(dealer.randint(1, 80), dealer.random()).encode())
        other = one[dealer.randint(0, 6) :] if dealer.random() < 0.7 else spotsigs.signatures(prose(30, dealer.random()).encode())
        if len(one) and len(other):
            assert spotsigs.similar(one, other, 80) == (100 * spotsigs.likeness(one, other) >= 80 - 1e-9)


def test_similar_lengths_lie_in_neighbouring_partitions():
    bounds = spotsigs.length_bounds(80).tolist()
    number = lambda n: sum(bound <= n for bound in bounds)
    for n in range(1, 400):
        for m in range(n, 500):
            if 100 * n >= 80 * m:
                assert number(m) - number(n) <= 1


def plain_components(documents, percent):
    sets = {key: plain_chains(text) for key, text in documents}
    low = {key: key for key in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and low[i] != low[j]:
                    low[i] = low[j] = min(low[i], low[j])
                    changed = True
    return low


def test_near_duplicates_equal_brute_force(spark, edge_docs, edge_texts, no_docs):
    """Chains of near copies, where the smallest id of a band is unlike some others."""
    dealer, documents = random.Random(4), [*enumerate(edge_texts)]
    for family in range(8):
        text = prose(70, 1000 + family).split()
        for _ in range(7):
            text = text.copy()
            text[dealer.randrange(len(text))] = "changed" + str(dealer.random())
            documents.append((len(documents), " ".join(text)))
    documents.append((len(documents), documents[-1][1]))
    docs = made(spark, [text for _, text in documents]).repartition(4)
    got = {row.doc_id: (row.component_id, row.kept) for row in spotsigs.near_duplicates(docs).collect()}
    expected = plain_components(documents, spotsigs.PERCENT)
    assert got == {key: (low, key == low) for key, low in expected.items()}
    assert spotsigs.near_duplicates(no_docs).count() == 0
