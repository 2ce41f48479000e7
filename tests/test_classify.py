import itertools

import pytest
from pyspark.sql import functions as F

from termlift.catalog import queries
from termlift.operators import classify, evaluate, split, tuning
from termlift.plans.classifier import randomly_tuned_classifier, tuned_classifier
from termlift.plans.scale import scratch_path
from termlift.sinks.models import load_model, save_model
from termlift.sources.tables import rows


@pytest.fixture(scope="module")
def parts(features):
    data = split.stable_split(features.vectors, "doc_id").persist()
    yield [data.filter(F.col("part") == name) for name in split.PARTS]
    data.unpersist()


def test_parts_are_disjoint_complete_and_stable(reviews):
    once = split.stable_split(reviews.select("doc_id"), "doc_id")
    again = split.stable_split(reviews.select("doc_id").repartition(3), "doc_id")
    assert once.exceptAll(again).count() == 0
    assert once.count() == reviews.count()
    assert {row.part for row in once.select("part").distinct().collect()} == set(split.PARTS)


def test_random_parts_are_disjoint_and_complete(reviews):
    keys = reviews.select("doc_id")
    parts = split.random_split(keys)
    merged = split.union_all(split.union_all(parts[0], parts[1]), parts[2])
    assert merged.count() == merged.distinct().count() == keys.count()


def test_small_weights_leave_no_part_empty(spark):
    keys = spark.range(200_000).withColumnRenamed("id", "key")
    counted = split.stable_split(keys, "key", weights=(0.9993, 0.0004, 0.0003)).groupBy("part").count()
    sizes = {row.part: row["count"] for row in counted.collect()}
    assert 40 < sizes["validation"] < 130 and 25 < sizes["test"] < 110


def test_the_test_part_does_not_depend_on_the_size_of_the_table(spark):
    """The same partitions give the same parts, whether other rows make the table large or not."""
    keys = spark.range(0, 4000, 1, 4)
    parts = [{row.id for row in part.collect()} for part in split.random_split(keys)]
    again = [{row.id for row in part.collect()} for part in split.random_split(spark.range(0, 4000, 1, 4))]
    assert parts == again


def test_the_feature_test_runs_once_for_all_points(parts, monkeypatch):
    calls = []
    real = tuning.pvalue_ranking
    monkeypatch.setattr(tuning, "pvalue_ranking", lambda *a: calls.append(a) or real(*a))
    train, validation, _ = parts
    tuning.tune_with_random_split(split.union_all(train, validation), "doc_id", tuning.Grid((20, 30), (True,), (0.1,), (2,)))
    assert len(calls) == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_weighted_f1_equals_the_evaluator(spark, seed):
    pairs = spark.range(500).select(
        F.floor(F.rand(seed) * 4).cast("double").alias("label"),
        F.floor(F.rand(seed + 10) * 5).cast("double").alias("prediction"),
    ).persist()
    ours = evaluate.weighted_f1(pairs).first()
    assert ours.rows == 500
    assert ours.f1 == pytest.approx(evaluate.f1_evaluator().evaluate(pairs), abs=1e-12)


def test_f1_of_labels_never_predicted(spark):
    pairs = rows(spark, [(0.0, 1.0), (0.0, 1.0)], "label double, prediction double")
    assert evaluate.weighted_f1(pairs).first().f1 == 0.0


def test_grid_is_the_product(spark):
    grid = tuning.Grid()
    expected = set(itertools.product(grid.num_top_features, grid.with_std, grid.reg_param, grid.max_iter))
    assert {tuple(row) for row in tuning.param_grid(spark, grid).collect()} == expected
    assert len(expected) == 12


def test_shared_tuning_equals_whole_pipelines(parts):
    train, validation, _ = parts
    grid = tuning.Grid((20, 40), (True,), (0.1,), (2, 3))
    found = {
        tuning.Point(row.numTopFeatures, row.withStd, row.regParam, row.maxIter): row.f1
        for row in tuning.tune_on_parts(train, validation, grid, parallelism=4).collect()
    }
    assert len(found) == 4
    for point, f1 in found.items():
        model = tuning.fit_point(train, point)
        assert evaluate.f1_evaluator().evaluate(model.transform(validation)) == pytest.approx(f1, abs=1e-9)


def test_best_point_prefers_f1_then_the_cheaper_point(spark):
    schema = "numTopFeatures int, withStd boolean, regParam double, maxIter int, f1 double"
    metrics = rows(spark, [(20, False, 0.1, 5, 0.9), (20, True, 0.1, 5, 0.9), (40, True, 0.1, 5, 0.8)], schema)
    assert tuning.best_point(metrics) == tuning.Point(20, True, 0.1, 5)


def test_tuned_model_beats_the_majority_and_reloads(spark, features, parts):
    test = parts[2]
    tuned = tuned_classifier(features.vectors, "doc_id", tuning.Grid((60,), (True,), (0.1,), (5,)), parallelism=4)
    majority = evaluate.weighted_f1(test.select("label", F.lit(0.0).alias("prediction"))).first().f1
    best = tuned.best.first()
    assert best.f1 > majority
    path = scratch_path(spark, "model")
    save_model(tuned.model, path)
    save_model(tuned.model, path)
    assert tuning.best_params(load_model(path), test).first() == best
    assert classify.score(tuned.model, test, "doc_id").count() == test.count()


def test_random_tuning_repeats_with_the_seed(features):
    grid = tuning.Grid((30,), (True,), (0.1, 1.0), (2,))
    once, again = (randomly_tuned_classifier(features.vectors, "doc_id", grid, parallelism=2) for _ in range(2))
    assert once.best.first() == again.best.first()
    assert once.metrics.count() == 2
    assert {row.f1 for row in once.metrics.collect()} == {row.f1 for row in again.metrics.collect()}


def test_a_wrong_f1_of_any_point_is_seen(parts):
    train, validation, _ = parts
    metrics = tuning.tune_on_parts(train, validation, tuning.Grid((30,), (True,), (0.1, 1.0), (2,)))
    least = metrics.orderBy("f1", F.desc("regParam")).first().regParam
    wrong = metrics.withColumn("f1", F.when(F.col("regParam") == least, F.col("f1") * 0.9).otherwise(F.col("f1")))
    assert all(row.same for row in queries._checked_alone(metrics, train, validation).collect())
    got = {row.regParam: row.same for row in queries._checked_alone(wrong, train, validation).collect()}
    assert got == {reg: reg != least for reg in (0.1, 1.0)}
