import pytest
from pyspark.sql import functions as F

from termlift.operators.features import term_stages
from termlift.operators.tokens import add_terms, drop_stop_words, explode_terms
from termlift.plans.scale import scratch_path
from termlift.sources.reviews import (
    json_field,
    parse_lines,
    read_reviews,
    read_reviews_json,
    rejected,
)
from termlift.sources.stopwords import default_stop_words, read_stop_words, stop_word_table
from termlift.sources.tables import rows

LINES = [
    '{"category":"A","reviewText":"Good stuff"}',
    "not json",
    "[1,2]",
    '{"category":null,"reviewText":"x yy"}',
    '{"category":"B"}',
    '{"category":7,"reviewText":"no cat"}',
    "",
    "null",
    "{'category':'A','reviewText':'single'}",
    '{"category":"A"',
    '{"category":"C","other":{"x":[1]},"reviewText":"more"}',
    '{"category":"D","reviewText":"spaces after"} \t',
    '{"category":"A","reviewText":"t"} extra',
    '{"category":"A","reviewText":"t"} {"b":2}',
    '{"category":"A","reviewText":"t"},{"category":"A","reviewText":"t"}',
    '{"category":"A","reviewText":"t"}]',
    "5",
]


@pytest.fixture(scope="module")
def lines_path(spark):
    path = scratch_path(spark, "lines")
    rows(spark, [(line,) for line in LINES], "value string").coalesce(1).write.text(path)
    return path


def test_tolerant_parse_keeps_usable_lines(spark, lines_path):
    kept = {tuple(row) for row in read_reviews(spark, lines_path).collect()}
    assert kept == {("A", "Good stuff"), ("7", "no cat"), ("C", "more"), ("D", "spaces after")}


def test_rejects_are_counted(spark, lines_path):
    counts = rejected(parse_lines(spark.read.text(lines_path))).first().asDict()
    assert counts == {"lines": 17, "unparsable": 11, "no_category": 1, "no_text": 1, "kept": 4}


def test_json_scan(spark, lines_path):
    kept = {row.category for row in read_reviews_json(spark, lines_path).collect()}
    assert {"A", "7", "C"} <= kept


def test_unparsable_lines_have_no_fields(spark, lines_path):
    bad = parse_lines(spark.read.text(lines_path)).filter("not parsed")
    assert bad.filter("category is not null or reviewText is not null").count() == 0
    nothing = parse_lines(rows(spark, [(None,)], "value string")).first()
    assert (nothing.category, nothing.parsed) == (None, False)


def test_json_field(spark):
    found = rows(spark, [('{"a": 1}',), ("{}",)], "line string").select(json_field(F.col("line"), "a").alias("a"))
    assert [row.a for row in found.collect()] == ["1", None]


def test_stop_words_from_file(spark):
    path = scratch_path(spark, "stop")
    rows(spark, [("the",), ("of",), ("the",), ("",)], "value string").write.text(path)
    assert {row.term for row in read_stop_words(spark, path).collect()} == {"the", "of"}
    assert "the" in default_stop_words()


def test_smoke_rows(spark):
    table = rows(spark, [(1,), (2,), (3,), (4,), (5,)], "_1 bigint")
    assert table.count() == 5
    assert rows(spark, [], "a int, b array<string>").count() == 0


def _terms(spark, text, stop_words=()):
    table = rows(spark, [("A", text)], "category string, reviewText string")
    one = [row.term for row in explode_terms(table, stop_words=stop_words).collect()]
    two = add_terms(table, stop_words=stop_words).first().terms
    return one, two


def test_only_the_feature_class_splits_on_commas(spark):
    assert _terms(spark, "good,bad") == (["good,bad"], ["good", "bad"])


def test_apostrophes_digits_and_short_terms(spark):
    assert _terms(spark, "Don't 12good x")[0] == ["don", "good"]
    assert _terms(spark, "Don't 12good x", ["don"])[0] == ["good"]


def test_whitespace_and_digits_are_ascii(spark):
    text = "ab\u00a0cd ef\u0663gh"
    assert _terms(spark, text)[0] == ["ab\u00a0cd", "ef\u0663gh"]


def test_empty_text_has_no_terms(spark):
    assert _terms(spark, "") == ([], [])
    assert _terms(spark, " 1 a ! ") == ([], [])


def test_terms_agree_with_the_transformers(spark, reviews):
    stop = ["the", "Der", "le"]
    ours = add_terms(reviews, stop_words=stop).select("doc_id", "terms")
    tokenizer, remover = term_stages(stop)
    theirs = remover.transform(tokenizer.transform(reviews)).select("doc_id", F.col("terms").alias("other"))
    assert ours.join(theirs, "doc_id").filter("terms != other").count() == 0


def test_stop_table_and_stop_list_agree(spark, reviews):
    stop = ["the", "der", "le"]
    by_list = explode_terms(reviews, "doc_id", stop_words=stop)
    by_table = drop_stop_words(explode_terms(reviews, "doc_id"), stop_word_table(spark, stop))
    assert by_table.columns == by_list.columns
    assert by_list.exceptAll(by_table).count() == 0
    assert by_table.exceptAll(by_list).count() == 0
