import math
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from termlift.catalog import queries, settings
from termlift.catalog.settings import STOP_WORDS
from termlift.functions.vectors import explode_vector
from termlift.operators import counts
from termlift.operators.classify import normalizer, scaler
from termlift.operators.features import (
    count_vectorizer,
    feature_pipeline,
    label_index,
    tfidf_stages,
    vocabulary,
    vocabulary_of,
)
from termlift.operators.selection import (
    feature_chi2,
    feature_chi2_test,
    pvalue_ranking,
    _row_statistic,
    rank_features,
    select_by_statistic,
    with_p_value,
)
from termlift.operators.tokens import add_terms, explode_terms
from termlift.plans import feature_ranking as ranking_plan
from termlift.plans.feature_ranking import build_features, feature_ranking
from termlift.plans.scale import written
from termlift.sources.tables import rows


def _bags(spark, *bags):
    return rows(spark, [(i, list(bag)) for i, bag in enumerate(bags)], "doc_id int, terms array<string>")


def test_corpus_counts_equal_brute_force(spark, reviews):
    documents = add_terms(reviews, stop_words=STOP_WORDS)
    n, df = Counter(), Counter()
    bags = [row.terms for row in documents.select("terms").collect()]
    for bag in bags:
        n.update(bag)
        df.update(set(bag))
    corpus = counts.corpus_counts(documents)
    found = {row.term: (row.n, row.df) for row in counts.document_freq(corpus).collect()}
    assert found == {term: (n[term], df[term]) for term in n}
    assert counts.document_count(corpus).first().documents == len(bags)


def test_empty_documents_count(spark):
    corpus = counts.corpus_counts(_bags(spark, [], ["b", "a", "b"], []))
    assert counts.document_count(corpus).first().documents == 3
    assert {tuple(row) for row in counts.document_freq(corpus).collect()} == {("a", 1, 1), ("b", 2, 1)}


def test_counts_do_not_depend_on_batches(spark, reviews):
    documents = add_terms(reviews)
    once = counts.corpus_counts(documents).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        again = counts.corpus_counts(documents.repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, once), key=str) == sorted(map(tuple, again), key=str)
    bags = counts.corpus_counts(_bags(spark, ["a", None, "a"], [])).collect()
    assert {tuple(row) for row in bags} == {("a", 2, 1), (None, 2, 2)}


def test_text_passes_call_nothing_for_each_term(reviews, monkeypatch):
    """Short pieces and stop words go when the counts are there; the vectors are those of terms without them."""
    plans = {}

    def caught(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(ranking_plan, "written", caught)
    stop = [*STOP_WORDS, "Lorem"]
    built = build_features(reviews, stop, size=300)
    assert plans and all("lambda" not in plan for plan in plans.values())
    terms = {row.term for row in built.vocabulary.collect()}
    assert not terms & {word.lower() for word in stop} and min(map(len, terms)) >= 2
    filtered = PipelineModel(list(tfidf_stages(built.vocabulary))).transform(add_terms(reviews, stop_words=stop))
    expected = {row.doc_id: row.features for row in filtered.select("doc_id", "features").collect()}
    assert {row.doc_id: row.features for row in built.vectors.select("doc_id", "features").collect()} == expected


def test_vocabulary_ties_and_weights(spark):
    corpus = counts.corpus_counts(_bags(spark, ["b", "a"], ["b", "a"], ["c", "b", "a"], ["d", "d", "d"]))
    vocab = vocabulary(corpus, size=2, min_documents=2).orderBy("featureIndex").collect()
    assert [(row.featureIndex, row.term, row.n, row.df) for row in vocab] == [(0, "a", 3, 3), (1, "b", 3, 3)]
    assert vocab[0].idf == pytest.approx(math.log(5 / 4))


def test_entries_of_sparse_and_dense_vectors(spark):
    table = spark.createDataFrame(
        [(1, Vectors.sparse(4, {1: 2.0, 3: 0.0})), (2, Vectors.dense([0.0, 5.0])), (3, Vectors.sparse(4, {}))],
        ["id", "v"],
    )
    assert {tuple(row) for row in explode_vector(table, "v", "id").collect()} == {(1, 1, 2.0), (2, 1, 5.0)}


def test_features_equal_mllibs(spark, reviews):
    """With every frequent term in the vocabulary both pipelines hold the same terms."""
    ours = build_features(reviews, STOP_WORDS, size=1 << 18)
    model = feature_pipeline(STOP_WORDS, count_vectorizer(1 << 18)).fit(reviews)
    names = vocabulary_of(model.stages[2], reviews)
    assert names.count() == ours.vocabulary.count()
    left = explode_vector(ours.vectors, "features", "doc_id", "label").join(ours.vocabulary, "featureIndex")
    right = explode_vector(model.transform(reviews), "features", "doc_id", "label").join(names, "featureIndex")
    left = left.select("doc_id", "label", "term", F.col("weight").alias("w1"))
    right = right.select("doc_id", "label", "term", F.col("weight").alias("w2"))
    both = left.join(right, ["doc_id", "label", "term"], "full")
    assert both.filter("w1 is null or w2 is null or abs(w1 - w2) > 1e-9").count() == 0
    again = ours.model.transform(reviews).select("doc_id", F.col("label").alias("l"), F.col("features").alias("f"))
    pairs = ours.vectors.join(again, "doc_id")
    assert pairs.count() == reviews.count()
    assert pairs.filter("label != l or features != f").count() == 0


def test_fitting_on_some_rows_keeps_the_rest_out(spark):
    texts = [(1, "A", "aa bb"), (2, "B", "aa bb"), (3, "A", "zz zz"), (4, "B", "zz aa")]
    reviews = rows(spark, texts, "doc_id int, category string, reviewText string")
    built = build_features(reviews, [], fit_on=reviews.filter("doc_id <= 2"))
    assert {row.term for row in built.vocabulary.collect()} == {"aa", "bb"}
    assert built.vectors.count() == 4


def test_vectors_are_built_once(reviews):
    documents = add_terms(reviews)
    vocab = vocabulary(counts.corpus_counts(documents), size=10)
    counting, weighting = tfidf_stages(vocab)
    weights = explode_vector(weighting.transform(counting.transform(documents)), "features", "doc_id")
    plan = weights._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    assert weights.count() > 0


def test_label_ties_go_by_label(spark):
    table = rows(spark, [("b",), ("a",), ("c",), ("c",)], "category string")
    assert {row.category: row.label for row in label_index(table).collect()} == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_statistics_equal_mllibs(spark, features):
    ours = feature_chi2(features.vectors).withColumnRenamed("statistic", "s1").withColumnRenamed("degreesOfFreedom", "d1")
    both = ours.join(feature_chi2_test(features.vectors), "featureIndex", "full")
    assert both.count() == 300
    assert both.filter("s1 is null or abs(s1 - statistic) > 1e-9 * (1 + statistic) or d1 != degreesOfFreedom").count() == 0


def test_feature_without_zeros(spark):
    table = spark.createDataFrame(
        [(0.0, Vectors.dense([1.0, 1.0])), (0.0, Vectors.dense([1.0, 2.0])), (1.0, Vectors.dense([2.0, 0.0]))],
        ["label", "features"],
    )
    ours = {row.featureIndex: (row.statistic, row.degreesOfFreedom) for row in feature_chi2(table).collect()}
    for row in feature_chi2_test(table).collect():
        assert ours[row.featureIndex] == (pytest.approx(row.statistic), row.degreesOfFreedom)


def test_pvalue_ranking_picks_what_the_selector_picks(features):
    selector = UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="selected", selectionMode="numTopFeatures")
    selector = selector.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(40)
    selected = selector.fit(features.vectors).selectedFeatures
    assert sorted(pvalue_ranking(features.vectors, 40)) == sorted(selected)


def test_p_values_equal_mllibs(features):
    ours = with_p_value(feature_chi2(features.vectors)).select("featureIndex", F.col("pValue").alias("ours"))
    both = ours.join(feature_chi2_test(features.vectors), "featureIndex")
    assert both.filter("abs(ours - pValue) > 1e-9").count() == 0


def test_statistics_of_large_counts_do_not_cancel(spark):
    """Labels of 10^10 rows each but for a few: against exact fractions."""
    n, counts = 10**10, {0: 3, 1: 10**6, 2: 10**6 + 7}
    labels = {0: n, 1: n + 1, 2: n + 2}
    cells = rows(spark, [(float(o), float(labels[label])) for label, o in counts.items()], "o double, c double")
    total, r = Fraction(sum(labels.values())), Fraction(sum(counts.values()))
    exact = sum((o - r * labels[label] / total) ** 2 / (r * labels[label] / total) for label, o in counts.items())
    row = cells.agg(F.collect_list(F.struct("o", "c")).alias("row"))
    found = row.select(_row_statistic("row", F.lit(float(r)), F.lit(float(total))).alias("s")).first().s
    assert found == pytest.approx(float(exact), rel=1e-9)


def test_stop_words_as_a_table(spark, reviews):
    table = rows(spark, [("the",), ("und",)], "term string")
    listed = explode_terms(reviews, "doc_id", stop_words=["the", "und"])
    assert explode_terms(reviews, "doc_id", stop_words=table).exceptAll(listed).count() == 0
    as_lists = add_terms(reviews, stop_words=["the", "und"]).select("doc_id", "terms")
    assert add_terms(reviews, stop_words=table).select("doc_id", "terms").exceptAll(as_lists).count() == 0


def test_ranking_and_statistic_selection(features):
    ranked = feature_ranking(features, 20).collect()
    assert len(ranked) == 20
    assert [row.statistic for row in ranked] == sorted((row.statistic for row in ranked), reverse=True)
    tested = feature_chi2(features.vectors)
    assert {row.featureIndex for row in select_by_statistic(tested, 20).collect()} == {
        row.featureIndex for row in rank_features(tested, features.vocabulary, 20).collect()
    }


def test_unit_lengths(features):
    scaled = scaler(True, "features").fit(features.vectors).transform(features.vectors)
    entries = explode_vector(normalizer().transform(scaled), "normal", "doc_id")
    lengths = entries.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("length"))
    assert lengths.filter("abs(length - 1) > 1e-9").count() == 0


def test_scaling_without_std_is_the_identity(features):
    scaled = scaler(False, "features").fit(features.vectors).transform(features.vectors)
    assert scaled.filter("features != scaled").count() == 0


def test_query_selects_by_full_p_values(spark, monkeypatch):
    """Both p-values are 0 at six decimals; the second is lower."""
    monkeypatch.setattr(settings, "SELECTED_FEATURES", 1)
    tested = rows(spark, [(0, 40.0, 1), (1, 60.0, 1)], "featureIndex int, statistic double, degreesOfFreedom int")
    got = queries._selected_by_pvalue(tested).collect()
    assert [(row.featureIndex, row.pValue) for row in got] == [(1, 0.0)]
