"""Feature-level chi-square tests and feature selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.ml.feature import ChiSqSelector, ChiSqSelectorModel
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlift.functions.scores import chi2_survival
from termlift.functions.vectors import explode_vector
from termlift.operators.topk import top_rows
from termlift.plans.scale import checked_broadcast, written


def feature_chi2(vectors: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """Chi-square of each feature's values, taken as categories, against the label.

    Gives `featureIndex, statistic, degreesOfFreedom` for each feature with a
    non-zero value. Zero is a value as well; its counts follow from the label
    totals and are never listed. Only the cells that occur are needed, with no
    limit on distinct values. With r of the n records in a row and c in a column
    E is r * c / n, and cells that do not occur add E each, in all
    r * (n - the c of those that do) / n. All terms are positive, so nothing
    cancels however large n is. A row's cells, one per label, are gathered.
    """
    cells = written(
        explode_vector(vectors, features, label)
        .groupBy("featureIndex", label, "weight")
        .agg(F.count(F.lit(1)).cast("double").alias("observed")),
        "contingency",
    )
    labels = checked_broadcast(written(_label_totals(vectors, label), "label_totals"))
    counted = cells.join(labels, label)
    row = F.collect_list(F.struct(F.col("observed").alias("o"), F.col("label_total").alias("c"))).alias("row")
    total, labels_seen = F.any_value("total").alias("total"), F.any_value("labels").alias("labels")

    by_value = (
        counted.groupBy("featureIndex", "weight")
        .agg(F.sum("observed").alias("r"), row, total)
        .select("featureIndex", _row_statistic("row", F.col("r"), F.col("total")).alias("part"))
        .groupBy("featureIndex")
        .agg(F.sum("part").alias("non_zero"), F.count(F.lit(1)).alias("values"))
    )
    by_label = (
        counted.groupBy("featureIndex", label)
        .agg(F.sum("observed").alias("present"), F.any_value("label_total").alias("label_total"), total, labels_seen)
        .groupBy("featureIndex")
        .agg(
            F.sum("present").alias("present"),
            F.collect_list(F.struct((F.col("label_total") - F.col("present")).alias("o"), F.col("label_total").alias("c"))).alias("row"),
            F.any_value("total").alias("total"),
            F.any_value("labels").alias("labels"),
        )
    )
    n, present = F.col("total"), F.col("present")
    absent = n - present
    listed = F.aggregate("row", F.lit(0.0), lambda seen, cell: seen + cell["c"])
    # Labels without the feature have O = c and E = absent * c / n.
    unlisted = (n - listed) * present * present / (n * absent)
    zero_row = F.when(absent > 0, _cells_statistic("row", absent, n) + unlisted).otherwise(F.lit(0.0))
    distinct = F.col("values") + F.when(absent > 0, 1).otherwise(0)
    return by_value.join(by_label, "featureIndex").select(
        "featureIndex",
        (F.col("non_zero") + zero_row).alias("statistic"),
        ((distinct - 1) * (F.col("labels") - 1)).cast("int").alias("degreesOfFreedom"),
    )


def _cells_statistic(row: str, r: Column, n: Column) -> Column:
    """Sum of (O - E)^2 / E over the listed cells of a row."""

    def part(cell: Column) -> Column:
        expected = r * cell["c"] / n
        return (cell["o"] - expected) * (cell["o"] - expected) / expected

    return F.aggregate(row, F.lit(0.0), lambda seen, cell: seen + part(cell))


def _row_statistic(row: str, r: Column, n: Column) -> Column:
    """The same over all cells of a row, those that do not occur included."""
    listed = F.aggregate(row, F.lit(0.0), lambda seen, cell: seen + cell["c"])
    return _cells_statistic(row, r, n) + r * (n - listed) / n


def _label_totals(vectors: DataFrame, label: str) -> DataFrame:
    """Rows per label, with the number of rows and of labels on each row."""
    totals = vectors.groupBy(label).agg(F.count(F.lit(1)).cast("double").alias("label_total"))
    total = totals.agg(F.sum("label_total")).scalar()
    labels = totals.agg(F.count(F.lit(1))).scalar()
    return totals.withColumn("total", total).withColumn("labels", labels)


def with_p_value(tested: DataFrame) -> DataFrame:
    """Append `pValue`, for any number of degrees of freedom."""
    return tested.withColumn("pValue", chi2_survival(F.col("statistic"), F.col("degreesOfFreedom")))


def feature_chi2_test(vectors: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """MLlib's test with p-values: `featureIndex, pValue, degreesOfFreedom, statistic`.

    It accepts at most 10,000 distinct values per feature; `feature_chi2` has no such limit.
    """
    return ChiSquareTest.test(vectors, features, label, flatten=True)


def rank_features(tested: DataFrame, vocab: DataFrame, k: int) -> DataFrame:
    """Terms of the k largest statistics, best first: `featureIndex, term, statistic, ...`.

    Both tables have at most one row per vocabulary entry.
    """
    return top_rows(tested.join(vocab.select("featureIndex", "term"), "featureIndex"), k, "statistic")


def select_by_statistic(tested: DataFrame, k: int) -> DataFrame:
    """The k features with the largest statistic, ties by index."""
    return top_rows(tested, k, "statistic", tie="featureIndex")


def select_by_pvalue(tested: DataFrame, k: int) -> DataFrame:
    """The k features with the lowest p-value, ties by index, best first: `featureIndex, pValue, ...`."""
    return with_p_value(tested).orderBy("pValue", "featureIndex").limit(k)


def pvalue_ranking(vectors: DataFrame, k: int, features: str = "features", label: str = "label") -> list[int]:
    """Indexes of the k features of lowest p-value, best first.

    Features without any non-zero value have a p-value of one and follow in index order.
    """
    best = select_by_pvalue(feature_chi2(vectors, features, label), k).select("featureIndex")
    ranked = [row.featureIndex for row in best.collect()]
    if len(ranked) < k:
        first = vectors.select(features).first()
        size = first[0].size if first else 0
        ranked += [index for index in range(size) if index not in set(ranked)][: k - len(ranked)]
    return ranked


def pvalue_slicer(ranking: Sequence[int], k: int, features: str = "features", output: str = "selected") -> ChiSqSelectorModel:
    """Keeps the k first features of a ranking, in index order.

    It is the model that MLlib's own selection by this test gives. It walks through a row's entries
    and the kept indexes together, where a vector slicer searches the row for every kept index.
    """
    kept = sorted(ranking[:k])
    gateway = SparkContext._active_spark_context._gateway
    indexes = gateway.new_array(gateway.jvm.int, len(kept))
    for place, index in enumerate(kept):
        indexes[place] = int(index)
    java = ChiSqSelectorModel._new_java_obj("org.apache.spark.ml.feature.ChiSqSelectorModel", ChiSqSelector().uid, indexes)
    return ChiSqSelectorModel(java).setFeaturesCol(features).setOutputCol(output)
