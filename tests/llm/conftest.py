import random

import pytest

from termlift.sources.tables import rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, key string, block long"


def made(spark, texts, start=0):
    """A table of texts with ids from `start`, and columns whose names operators might use themselves."""
    values = [(start + i, text, "en", "a", None, None, "x", None) for i, text in enumerate(texts)]
    return rows(spark, values, SCHEMA)


def words(count, seed):
    dealer = random.Random(seed)
    return ["".join(dealer.choice("abcdefghij") for _ in range(dealer.randint(2, 9))) for _ in range(count)]


@pytest.fixture(scope="session")
def edge_texts():
    """Nulls, empties, blanks, one word, no ASCII, copies, near copies, shared passages, one long text."""
    base = words(120, 1)
    passage = " ".join(words(60, 2))
    near = base[:60] + ["changed"] + base[61:]
    return [
        None,
        "",
        " \n\t ",
        "one",
        "One",
        "two words",
        "héé ñandú 日本語 😀 " * 3,
        " ".join(base),
        " ".join(base),
        "\n".join([" ".join(base[:60]), " ".join(base[60:])]),
        " ".join(near),
        "before " + passage + " after",
        "other " + passage,
        passage.upper(),
        "line\nline\nline\n" + " ".join(words(40, 3)),
        "a" * 300,
        "a" * 300 + "b",
        " ".join(words(30_000, 4)),
        "<|endoftext|> it's <|endoftext|>'s",
        None,
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_texts):
    return made(spark, edge_texts).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return rows(spark, [], SCHEMA)
