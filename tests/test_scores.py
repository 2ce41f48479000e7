import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termlift.functions.scores import chi2_survival, score_text
from termlift.operators import counts
from termlift.operators.chi2 import chi2_scores, chi2_scores_by_join
from termlift.operators.dictionary import clean_terms, merged_dictionary
from termlift.operators.topk import PARTS, top_lists, top_terms
from termlift.plans.scale import checked_broadcast, scratch_path, spread, within, written
from termlift.plans.term_report import term_report, write_term_report
from termlift.operators.tokens import add_terms, explode_terms
from termlift.sinks.text import category_lines, read_category_lines, write_dictionary
from termlift.sources.reviews import read_reviews
from termlift.sources.tables import rows

FREQ = "category string, term string, freq_ct bigint"


def brute_force(freq):
    by_term, by_category = Counter(), Counter()
    for category, term, n in freq:
        by_term[term] += n
        by_category[category] += n
    total = sum(by_term.values())
    scores = {}
    for category, term, a in freq:
        b, c = by_term[term] - a, by_category[category] - a
        d = total - a - b - c
        bottom = (a + b) * (c + d) * (a + c) * (b + d)
        scores[category, term] = total * (a * d - b * c) ** 2 / bottom if bottom else 0.0
    return scores


@pytest.fixture(scope="module")
def skewed():
    """One category with most of the pairs, one term in every category."""
    rng = random.Random(7)
    pairs = {("hot", f"t{i}"): rng.randint(1, 50) for i in range(400)}
    pairs |= {(f"c{i % 20}", f"t{rng.randint(0, 500)}"): rng.randint(1, 9) for i in range(300)}
    pairs |= {(category, "everywhere"): rng.randint(1, 1000) for category in ["hot"] + [f"c{i}" for i in range(20)]}
    return [(category, term, n) for (category, term), n in pairs.items()]


@pytest.mark.parametrize(
    "scorer",
    [
        chi2_scores,
        chi2_scores_by_join,
        lambda freq: chi2_scores(freq, max_categories=5),
        lambda freq: chi2_scores_by_join(freq, max_categories=5),
    ],
)
def test_scores_equal_brute_force(spark, skewed, scorer):
    expected = brute_force(skewed)
    found = {(row.category, row.term): row.chi2 for row in scorer(rows(spark, skewed, FREQ)).collect()}
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert found[key] == pytest.approx(value, rel=1e-9, abs=1e-9)
        assert found[key] >= 0


def test_one_category_scores_zero(spark):
    freq = rows(spark, [("A", "x", 3), ("A", "y", 1)], FREQ)
    assert {row.chi2 for row in chi2_scores(freq).collect()} == {0.0}


def test_large_counts_do_not_overflow(spark):
    big = [("A", "x", 3 * 10**12), ("A", "y", 10**12), ("B", "x", 10**12), ("B", "z", 5 * 10**12)]
    expected = brute_force(big)
    for row in chi2_scores(rows(spark, big, FREQ)).collect():
        assert row.chi2 == pytest.approx(expected[row.category, row.term], rel=1e-9)


def test_margins_add_up(spark, skewed):
    freq = rows(spark, skewed, FREQ)
    total = counts.grand_total(freq).first().grand_total
    assert counts.term_totals(freq).agg(F.sum("term_total")).first()[0] == total
    assert counts.category_totals(freq).agg(F.sum("category_total")).first()[0] == total
    levels = {row.level: row.n for row in counts.all_margins(freq).groupBy("level").agg(F.sum("n").alias("n")).collect()}
    assert levels == dict.fromkeys(range(4), total)


def test_ties_at_the_cut_keep_the_lowest_terms(spark):
    scores = rows(
        spark,
        [("A", term, 1.0) for term in "dbaec"] + [("A", "z", 2.0), ("B", "q", 1.0000000001), ("B", "p", 1.0)],
        "category string, term string, chi2 double",
    )
    top = {(row.category, row.rank): row.term for row in top_terms(scores, 3).collect()}
    assert top == {("A", 1): "z", ("A", 2): "a", ("A", 3): "b", ("B", 1): "p", ("B", 2): "q"}
    lists = {row.category: row.terms for row in top_lists(top_terms(scores, 3)).collect()}
    assert lists == {"A": ["z", "a", "b"], "B": ["p", "q"]}


def test_rank_filter_prunes_before_the_shuffle(spark):
    scores = spark.range(1000).selectExpr("cast(id % 3 as string) category", "cast(id as string) term", "rand(1) chi2")
    plan = top_terms(scores, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def _shuffled_rows(df):
    """Records that each exchange of the executed plan wrote, the last exchange first."""
    df.collect()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("joined", [False, True])
def test_any_k_sends_few_rows_of_a_category_to_the_last_shuffle(spark, joined):
    freq = spark.range(120_000).selectExpr("if(id % 10 = 0, 'cold', 'hot') category", "cast(id as string) term", "id % 7 + 1 freq_ct")
    freq = written(freq.repartition(8), "hot_freq")
    scores = chi2_scores(freq, max_categories=0) if joined else chi2_scores(freq)
    top = top_terms(scores, 1500)
    last = _shuffled_rows(top)[0]
    assert last <= 2 * 1500 * PARTS < 120_000
    assert top.groupBy("category").count().filter("count != 1500").count() == 0


def test_the_shuffle_join_broadcasts_nothing(spark):
    freq = rows(spark, [("a", "x", 1), ("b", "y", 2)], FREQ)
    scores = chi2_scores(freq, max_categories=0)
    scores.collect()
    assert "BroadcastHashJoin" not in scores._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("degrees", [1, 2, 3, 4, 9, 30, 301])
def test_survival_equals_known_values(spark, degrees):
    """Against the recurrence Q(k + 2) = Q(k) + (x/2)^(k/2) exp(-x/2) / gamma(k/2 + 1), from its two starts."""
    values = [0.0, 1e-6, 0.5, 3.0, 7.9, 8.1, 40.0, 350.0, 2000.0]
    table = rows(spark, [(x, degrees) for x in values], "x double, k int")
    for row in table.select("x", chi2_survival(F.col("x"), F.col("k")).alias("q")).collect():
        half, k = row.x / 2, 2 - degrees % 2
        expected = math.exp(-half) if k == 2 else math.erfc(math.sqrt(half))
        while k < degrees and row.x > 0:
            expected += math.exp(k / 2 * math.log(half) - half - math.lgamma(k / 2 + 1))
            k += 2
        assert row.q == pytest.approx(1.0 if row.x == 0 else min(1.0, expected), abs=1e-9, rel=1e-9)


def test_cleaning(spark):
    terms = rows(spark, [('"éclair"',), ("éé",), ("a-b",), ('"a-b"',), ('""',)], "term string")
    assert [row.term for row in merged_dictionary(terms).collect()] == ["a-b", "clair"]


def _text(spark, path):
    files = sorted(spark.sparkContext.wholeTextFiles(path).collect())
    return "".join(content for _, content in files)


def test_dictionary_file_is_one_sorted_line(spark):
    path = scratch_path(spark, "dictionary")
    names = [f"w{i:04d}" for i in range(300)]
    shuffled = rows(spark, [(name,) for name in names], "term string").repartition(8)
    write_dictionary(shuffled, path)
    assert _text(spark, path).rstrip(" ").split(" ") == names


def test_report_files(spark):
    texts = [("B", "red red, blue"), ("A", "green green blue"), ("A", 'the "green" tree')]
    reviews = rows(spark, texts, "category string, reviewText string")
    report = term_report(reviews, ["the"], k=2)
    folder = scratch_path(spark, "report")
    for _ in range(2):
        write_term_report(report, folder)
    lines = _text(spark, folder + "/report").splitlines()
    assert [line.split("\t")[0] for line in lines] == ["A", "B"]
    assert _text(spark, folder + "/dictionary") == "blue green red tree "
    back = read_category_lines(spark.read.text(folder + "/report").withColumnRenamed("value", "line"))
    assert {tuple(row) for row in back.collect()} == {tuple(row) for row in report.top.collect()}


def test_line_format(spark):
    top = rows(
        spark,
        [("A", 1, "x", 12.5), ("A", 2, "y", 0.000001)],
        "category string, rank int, term string, chi2 double",
    )
    assert category_lines(top).first().line == "A\tx:12.500000 y:0.000001"
    shown = rows(spark, [(2.0 / 3,), (1e15,)], "v double").select(score_text(F.col("v")).alias("s")).collect()
    assert [row.s for row in shown] == ["0.666667", "1000000000000000.000000"]


def test_size_checks(spark):
    numbers = spark.range(10)
    assert within(numbers, 10)
    assert not within(numbers, 9)
    assert within(numbers, 10, max_bytes=80)
    assert not within(numbers, 10, max_bytes=79)
    words = rows(spark, [("éé",), (None,)], "word string")
    assert within(words, 2, max_bytes=4)
    assert not within(words, 2, max_bytes=3)
    hinted = checked_broadcast(numbers, 10)._jdf.queryExecution().logical().toString()
    plain = checked_broadcast(numbers, 9)._jdf.queryExecution().logical().toString()
    assert "hint" in hinted.lower()
    assert "hint" not in plain.lower()


def test_spread_follows_its_setting(spark):
    wanted = int(spark.conf.get("spark.termlift.inputPartitions"))
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == wanted
    spark.conf.unset("spark.termlift.inputPartitions")
    try:
        narrow = spark.range(0, 100, 1, 1)
        assert spread(narrow) is narrow
    finally:
        spark.conf.set("spark.termlift.inputPartitions", str(wanted))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_split_once_and_other_columns_not_read(reviews):
    freq = counts.term_freq(explode_terms(reviews, "category"))
    assert _plan(freq).count("split(") == 1
    assert "doc_id" not in freq._jdf.queryExecution().executedPlan().toString()
    assert _plan(counts.corpus_counts(add_terms(reviews))).count("split(") == 1
    assert _plan(clean_terms(freq)).count("regexp_replace(") == 1


def test_lines_are_parsed_once(spark):
    path = scratch_path(spark, "one_line")
    rows(spark, [('{"category":"A","reviewText":"good stuff"}',)], "value string").write.text(path)
    freq = counts.term_freq(explode_terms(read_reviews(spark, path), "category"))
    assert _plan(freq).count("from_json(") == 1
    assert freq.count() == 2


def test_clean_terms_are_distinct(spark):
    terms = rows(spark, [('"x1"',), ("x1",), ('x1"',)], "term string")
    assert [row.term for row in clean_terms(terms).collect()] == ["x1"]
