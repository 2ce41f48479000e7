"""The shared trainer, exact draws, distributed numbering, raw-text scoring and rejected lines."""

import hashlib

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from termlift.catalog import queries
from termlift.operators import classify, selection, split, svm, tuning
from termlift.operators import features as feature_ops
from termlift.operators.numbering import numbered
from termlift.plans.classifier import randomly_tuned_classifier
from termlift.plans.feature_ranking import build_features
from termlift.plans.scale import scratch_path, storage_room
from termlift.plans.scoring import score_texts, text_classifier
from termlift.sinks.models import load_model, save_model
from termlift.sources.reviews import read_reviews, read_with_rejects
from termlift.sources.tables import rows
from tests.test_sources import LINES


@pytest.fixture(scope="module")
def normal(features):
    scaled = classify.scaler(True, "features").fit(features.vectors).transform(features.vectors)
    data = classify.normalizer().transform(scaled).select("label", "normal").persist()
    yield data
    data.unpersist()


def test_coefficients_equal_mllib(normal):
    settings = [svm.Setting(reg, most) for reg in (0.01, 0.1, 1.0) for most in (1, 2)]
    trained = svm.fit_all(normal, settings)
    for one in settings:
        mllib = classify.one_vs_rest(classify.linear_svm(one.reg_param, one.max_iter), 4).fit(normal)
        assert len(mllib.models) == len(trained[one].models)
        for theirs, ours in zip(mllib.models, trained[one].models):
            assert np.abs(theirs.coefficients.toArray() - ours.coefficients.toArray()).max() < 1e-6
            assert abs(theirs.intercept - ours.intercept) < 1e-6


def test_long_runs_score_like_mllib(normal):
    settings = [svm.Setting(reg, most) for reg in (0.01, 1.0) for most in (5, 10)]
    trained = svm.fit_all(normal, settings)
    for one in settings:
        mllib = classify.one_vs_rest(classify.linear_svm(one.reg_param, one.max_iter), 4).fit(normal)
        ours = [row.prediction for row in trained[one].transform(normal).collect()]
        theirs = [row.prediction for row in mllib.transform(normal).collect()]
        assert np.mean(np.array(ours) == np.array(theirs)) >= 0.98


def test_a_pass_serves_all_machines(normal, monkeypatch):
    """As many passes as the longest machine needs, however many classes and settings there are."""
    passes = []
    real = svm._added
    monkeypatch.setattr(svm, "_added", lambda *a: passes.append(a) or real(*a))
    svm.fit_all(normal, [svm.Setting(0.1, 4)])
    alone = len(passes)
    passes.clear()
    svm.fit_all(normal, [svm.Setting(0.1, most) for most in (1, 2, 3, 4)])
    assert len(passes) == alone
    assert alone <= 4 * 4 + 2


def test_blocks_and_partitions_change_nothing(normal, monkeypatch):
    setting = svm.Setting(0.1, 5)
    once = svm.fit_all(normal.repartition(1), [setting])[setting]
    monkeypatch.setattr(svm, "BLOCK_ROWS", 7)
    again = svm.fit_all(normal.repartition(5), [setting])[setting]
    for one, other in zip(once.models, again.models):
        assert np.abs(one.coefficients.toArray() - other.coefficients.toArray()).max() < 1e-9


def test_dense_and_sparse_passes_agree(normal, monkeypatch):
    batch = svm.packed(normal.coalesce(1), "normal", "label").toArrow().combine_chunks().to_batches()[0]
    block = svm._Block(batch, 0)
    coefficients = np.random.default_rng(3).normal(size=(4, normal.first().normal.size))
    found = []
    for share in (0.0, 2.0):
        monkeypatch.setattr(svm, "DENSE_SHARE", share)
        found.append(block.slopes(coefficients, np.arange(4) / 10, np.arange(4.0)))
    assert len(block.label) > svm.DENSE_ROWS
    assert np.allclose(*found, rtol=0, atol=1e-9)


def test_rows_are_not_dealt_anew_by_label(spark, monkeypatch):
    class Caught(Exception):
        pass

    dealt = []

    def caught(df, name):
        dealt.append(df)
        raise Caught

    vectors = spark.range(0, 4000, 1, 4).select(F.col("id").alias("doc_id"), F.lit(0.0).alias("label"), F.lit(1).alias("features"))
    monkeypatch.setattr(queries, "_vectors", lambda *a: vectors)
    monkeypatch.setattr(queries, "randomly_tuned_classifier", lambda *a, **k: None)
    monkeypatch.setattr(queries, "written", caught)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(Caught):
            queries.random_tuning(spark, "")
        sizes = [row["count"] for row in dealt[0].groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) > 1 and max(sizes) < 0.6 * 4000


def test_points_are_fitted_at_a_time_as_memory_allows(spark):
    assert queries._at_a_time(1 << 20, 1 << 40) == (queries.POINTS, queries.PARALLELISM)
    assert queries._at_a_time(0, 0) == queries._at_a_time(1 << 40, 1 << 30) == (1, 1)
    for size in (3, 10, 33, 100, 200, 500):
        points, classes = queries._at_a_time(size, 1000)
        assert points * (classes + 1) * size <= 1000
    assert 0 < storage_room(spark) < 1 << 40


def test_all_points_are_checked_alone_at_the_same_time(spark, features, monkeypatch):
    """Every point has its own whole fit, and fits overlap."""
    running, most, fitted = [], [], []
    real = classify.classifier_pipeline

    class Watched:
        def __init__(self, *values):
            self.values, self.pipeline = values, real(*values)

        def fit(self, train):
            running.append(self)
            most.append(len(running))
            try:
                return self.pipeline.fit(train)
            finally:
                running.remove(self)
                fitted.append(self.values[1:5])

    monkeypatch.setattr(queries.classify, "classifier_pipeline", Watched)
    data = features.vectors.select("label", "features")
    points = [(40, std, reg, 2) for std in (True, False) for reg in (0.1, 1.0)]
    metrics = rows(spark, [(*point, 2.0) for point in points], "numTopFeatures int, withStd boolean, regParam double, maxIter int, f1 double")
    found = queries._checked_alone(metrics, data, data).collect()
    assert [tuple(row) for row in found] == [(*point, False) for point in points]
    assert sorted(fitted) == sorted(points) and max(most) > 1


def test_selection_equals_a_vector_slicer(features):
    ranking = [7, 3, 250, 0, 12, 99]
    sliced = VectorSlicer(inputCol="features", outputCol="other", indices=[0, 3, 7, 250]).transform(features.vectors)
    both = selection.pvalue_slicer(ranking, 4).transform(sliced).select("selected", "other").collect()
    assert both and all(row.selected == row.other for row in both)
    model = selection.pvalue_slicer(ranking, 4)
    path = scratch_path(features.vectors.sparkSession, "selector")
    save_model(PipelineModel([model]), path)
    assert load_model(path).stages[0].selectedFeatures == model.selectedFeatures == [0, 3, 7, 250]


def test_dense_empty_and_constant_features(spark):
    vectors = [Vectors.dense(1.0, 2.0, 5.0), Vectors.sparse(3, [], []), Vectors.dense(0.5, 0.0, 5.0), Vectors.sparse(3, [1], [4.0])]
    data = spark.createDataFrame([(float(i % 3 == 0), vectors[i % 4]) for i in range(20)], ["label", "normal"])
    setting = svm.Setting(0.1, 3)
    ours = svm.fit_all(data, [setting])[setting]
    mllib = classify.one_vs_rest(classify.linear_svm(0.1, 3)).fit(data)
    for theirs, own in zip(mllib.models, ours.models):
        assert np.allclose(theirs.coefficients.toArray(), own.coefficients.toArray(), atol=1e-6)
    with pytest.raises(ValueError):
        svm.fit_all(data.limit(0), [setting])


def test_draws_have_exact_sizes_and_ignore_partitions(spark):
    keys = spark.range(0, 3001, 1, 7).withColumnRenamed("id", "key")
    once = {row.key: row.part for row in split.drawn_split(keys, "key").collect()}
    again = {row.key: row.part for row in split.drawn_split(keys.repartition(3), "key").collect()}
    other = {row.key: row.part for row in split.drawn_split(keys, "key", seed=7).collect()}
    assert once == again and once != other
    place = lambda key: (int(hashlib.md5(f"42:{key}".encode()).hexdigest()[:8], 16), str(key))
    order = sorted(range(3001), key=place)
    assert [once[key] for key in order] == ["train"] * 2400 + ["validation"] * 300 + ["test"] * 301


def test_draws_of_repeated_null_and_no_keys(spark):
    table = rows(spark, [(1,)] * 6 + [(None,)] * 3 + [(2,), (3,)], "key long")
    drawn = split.drawn_split(table, "key").collect()
    assert all(len({row.part for row in drawn if row.key == key}) == 1 for key in (1, None, 2, 3))
    assert split.drawn_split(table.limit(0), "key").count() == 0


def test_random_tuning_ignores_partitions(features):
    grid = tuning.Grid((30,), (True,), (0.1, 1.0), (2,))
    vectors = features.vectors.select("doc_id", "label", "features")
    once, again = (randomly_tuned_classifier(one, "doc_id", grid, parallelism=2) for one in (vectors, vectors.repartition(3)))
    assert once.best.first()[:4] == again.best.first()[:4]
    assert once.metrics.count() == 2
    assert {row.f1 for row in once.metrics.collect()} == {row.f1 for row in again.metrics.collect()}


def test_numbers_follow_the_order(spark):
    table = spark.range(0, 5000, 1, 9).select((F.col("id") * 7919 % 5003).alias("x"))
    got = [(row.x, row.n) for row in numbered(table, "n", F.desc("x")).collect()]
    expected = sorted((row.x for row in table.collect()), reverse=True)
    assert sorted(got, key=lambda one: one[1]) == [(x, n) for n, x in enumerate(expected)]
    assert numbered(table.limit(0), "n", F.desc("x")).count() == 0


def test_many_labels_stay_on_the_executors(spark, monkeypatch):
    labels = spark.range(0, 300_000, 1, 8).select(F.concat(F.lit("l"), F.col("id") % 200_000).alias("category"))
    monkeypatch.setattr(feature_ops, "label_indexer", None)
    index = feature_ops.label_index(labels.unionByName(labels.filter("category = 'l5'"))).persist()
    assert index.count() == 200_000
    summary = index.agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count_distinct("label").alias("many")).first()
    assert tuple(summary) == (0.0, 199_999.0, 200_000)
    assert index.orderBy("label").first().category == "l5"
    joined = feature_ops.with_label(labels.limit(1000), index)
    assert joined.filter("label IS NULL").count() == 0
    unseen = rows(spark, [("nowhere",), (None,)], "category string")
    assert [row.label for row in feature_ops.with_label(unseen, index).collect()] == [None, None]
    index.unpersist()


def test_label_index_equals_mllib(features):
    vectors = features.vectors
    ours = {row.category: row.label for row in feature_ops.label_index(vectors.select("category")).collect()}
    assert ours == {label: float(n) for n, label in enumerate(feature_ops.label_indexer(vectors.select("category")).labels)}


def test_raw_texts_are_scored_by_one_stored_model(spark, features, reviews):
    fitted = tuning.fit_point(features.vectors, tuning.Point(60, True, 0.1, 5))
    path = scratch_path(spark, "text_model")
    save_model(text_classifier(features, fitted), path)
    model = load_model(path)
    extra = rows(spark, [(-1, None, "en"), (-2, "", "xx"), (-3, "qqq zzz", None)], "doc_id long, text string, terms string")
    texts = reviews.select("doc_id", F.col("reviewText").alias("text"), F.col("category").alias("terms")).unionByName(extra)
    scored = score_texts(model, texts, "text", ["doc_id", "terms"])
    assert scored.columns == ["doc_id", "terms", "prediction", "predicted"]
    got = {row.doc_id: row for row in scored.collect()}
    vectors = {row.doc_id: row.prediction for row in classify.score(fitted, features.vectors, "doc_id").collect()}
    assert {key: row.prediction for key, row in got.items() if key >= 0} == vectors
    intercepts = [machine.intercept for machine in fitted.stages[-1].models]
    assert {got[key].prediction for key in (-1, -2, -3)} == {float(np.argmax(intercepts))}
    names = features.model.stages[-1].labels
    assert all(row.predicted == names[int(row.prediction)] for row in got.values())


def test_heldout_rows_do_not_shape_the_vocabulary(spark):
    train = rows(spark, [(1, "a", "apple pear"), (2, "b", "apple plum"), (3, "a", "pear plum")], "doc_id long, category string, reviewText string")
    test = rows(spark, [(4, "a", "apple kiwi kiwi"), (5, "b", "fig")], "doc_id long, category string, reviewText string")
    built = build_features(test, [], size=10, min_documents=1, fit_on=train)
    assert {row.term for row in built.vocabulary.collect()} == {"apple", "pear", "plum"}
    assert {row.doc_id: row.features.numNonzeros() for row in built.vectors.collect()} == {4: 1, 5: 0}


def test_rejected_lines_come_with_reason_and_place(spark):
    path = scratch_path(spark, "lines")
    rows(spark, [(line,) for line in LINES], "value string").coalesce(1).write.text(path)
    scan = read_with_rejects(spark, path)
    assert sorted(map(tuple, scan.reviews.collect())) == sorted(map(tuple, read_reviews(spark, path).collect()))
    found = {row.place: (row.reason, row.line) for row in scan.rejects.collect()}
    assert all(LINES[place] == line for place, (_, line) in found.items())
    assert {place for place in found} == set(range(len(LINES))) - {0, 5, 10, 11}
    assert found[3][0] == "no_category" and found[4][0] == "no_text" and found[1][0] == "unparsable"
    assert {(row.block, row.file.endswith(".txt")) for row in scan.rejects.collect()} == {(0, True)}


def test_rejected_lines_of_several_files_and_of_none(spark, tmp_path):
    for name, lines in (("a", ["x", '{"category":"A","reviewText":"t"}', "y"]), ("b", ["z"]), ("c", [])):
        (tmp_path / f"{name}.txt").write_text("".join(line + "\n" for line in lines))
    found = {(row.file[-5:], row.place, row.line) for row in read_with_rejects(spark, str(tmp_path)).rejects.collect()}
    assert found == {("a.txt", 0, "x"), ("a.txt", 2, "y"), ("b.txt", 0, "z")}
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "c.txt").write_text("")
    scan = read_with_rejects(spark, str(empty))
    assert scan.rejects.count() == 0 and scan.reviews.count() == 0
