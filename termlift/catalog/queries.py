"""One Spark query per operator. Each takes the session and the folder of tables."""

from __future__ import annotations

from dataclasses import astuple
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from termlift.catalog import settings
from termlift.functions.scores import rounded
from termlift.functions.text import TERM_DELIMITERS, raw_terms
from termlift.functions.vectors import explode_vector
from termlift.operators import classify, counts, evaluate, features, selection, split, tuning
from termlift.operators.chi2 import chi2_scores, chi2_scores_by_join
from termlift.operators.dictionary import clean_terms, merged_dictionary
from termlift.operators.tokens import add_terms, drop_stop_words, explode_terms
from termlift.operators.topk import top_lists, top_rows, top_terms
from termlift.plans.classifier import KEPT, randomly_tuned_classifier, tuned_classifier
from termlift.plans.scoring import score_texts, text_classifier
from termlift.plans.feature_ranking import Features, build_features
from termlift.plans.scale import checked_broadcast, scratch_path, spread, storage_room, written
from termlift.plans.term_report import counted, term_report
from termlift.sinks.models import load_model, save_model
from termlift.sinks.text import category_lines, read_category_lines, report_lines, write_report, write_scores
from termlift.sources.reviews import (
    REVIEW_SCHEMA,
    as_reviews,
    json_field,
    parse_lines,
    read_reviews,
    read_reviews_json,
    read_with_rejects,
    rejected,
)
from termlift.sources.stopwords import read_stop_words, stop_word_table
from termlift.sources.tables import rows, table

STOP = list(settings.STOP_WORDS)


def _reviews(spark: SparkSession, sf: str, category: str = "lang") -> DataFrame:
    return as_reviews(table(spark, sf, "documents"), category, "text", "doc_id")


def _freq(spark: SparkSession, sf: str, category: str = "lang") -> DataFrame:
    return counted(_reviews(spark, sf, category), STOP)


def _scores(spark: SparkSession, sf: str, category: str = "lang") -> DataFrame:
    return chi2_scores(_freq(spark, sf, category))


def _with_terms(spark: SparkSession, sf: str) -> DataFrame:
    return add_terms(spread(_reviews(spark, sf)), stop_words=STOP)


def _vocabulary(with_terms: DataFrame) -> DataFrame:
    corpus = written(counts.corpus_counts(with_terms), "corpus_counts")
    return features.vocabulary(corpus, settings.VOCABULARY_SIZE, settings.MIN_DOCUMENTS)


def _features(spark: SparkSession, sf: str) -> Features:
    return build_features(_reviews(spark, sf), STOP, settings.VOCABULARY_SIZE, settings.MIN_DOCUMENTS)


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).vectors


def _long(vectors: DataFrame, column: str) -> DataFrame:
    weights = explode_vector(vectors, column, "doc_id")
    return weights.select("doc_id", "featureIndex", rounded(F.col("weight")).alias("weight"))


# Sources


def json_parse(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType())])
    parsed = parse_lines(table(spark, sf, "events").select("event_id", "props"), schema, "props")
    return parsed.select("event_id", "k", json_field(F.col("props"), "k").alias("k_text"), "parsed")


def json_rejects(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    good = documents.select(F.to_json(F.struct(F.col("lang").alias("category"), F.col("text").alias("reviewText"))).alias("value"))
    other = documents.select(F.to_json(F.struct(F.col("lang").alias("category"), "source")).alias("value"))
    markup = table(spark, sf, "pages").select(F.col("html").alias("value"))
    return rejected(parse_lines(good.unionByName(other).unionByName(markup)))


def rejected_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each different rejected line with its reason, how often it occurs and in how many positions; usable lines as one row."""
    path = scratch_path(spark, "mixed_lines")
    documents = table(spark, sf, "documents")
    good = documents.select(F.to_json(F.struct(F.col("lang").alias("category"), F.col("text").alias("reviewText"))).alias("value"))
    no_text = documents.select(F.to_json(F.struct(F.col("lang").alias("category"), "doc_id")).alias("value"))
    no_label = documents.select(F.to_json(F.struct(F.col("text").alias("reviewText"))).alias("value"))
    markup = table(spark, sf, "pages").select(F.translate("html", "\r\n", "  ").alias("value"))
    good.unionByName(no_text).unionByName(no_label).unionByName(markup).write.text(path)
    scan = read_with_rejects(spark, path)
    lines = scan.rejects.groupBy("reason", F.md5("line").alias("digest")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("file", "block", "place").alias("positions")
    )
    n = F.count(F.lit(1)).alias("n")
    kept = scan.reviews.agg(n).select(F.lit("kept").alias("reason"), F.lit("").alias("digest"), "n", F.col("n").alias("positions"))
    return lines.unionByName(kept)


def _written_lines(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "review_lines")
    records = F.struct("doc_id", F.col("lang").alias("category"), F.col("text").alias("reviewText"))
    table(spark, sf, "documents").select(F.to_json(records).alias("value")).write.text(path)
    return path


KEYED_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), *REVIEW_SCHEMA.fields])


def _digests(reviews: DataFrame) -> DataFrame:
    return reviews.select("doc_id", "category", F.md5("reviewText").alias("digest"))


def text_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _digests(read_reviews(spark, _written_lines(spark, sf), KEYED_SCHEMA))


def json_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _digests(read_reviews_json(spark, _written_lines(spark, sf), KEYED_SCHEMA))


def stopword_table(spark: SparkSession, sf: str) -> DataFrame:
    stop = checked_broadcast(stop_word_table(spark, STOP))
    pieces = F.explode_outer(raw_terms(F.col("reviewText"), TERM_DELIMITERS)).alias("term")
    found = spread(_reviews(spark, sf)).select(pieces).join(stop, "term", "left_semi")
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


# Terms and counts


def tokens_task1(spark: SparkSession, sf: str) -> DataFrame:
    return explode_terms(spread(_reviews(spark, sf)), "doc_id", "category", stop_words=STOP)


def tokens_task2(spark: SparkSession, sf: str) -> DataFrame:
    return _with_terms(spark, sf).select(
        "doc_id", F.size("terms").alias("n_terms"), F.array_join("terms", " ").alias("terms")
    )


def stopword_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    exploded = explode_terms(spread(_reviews(spark, sf)), "category")
    return counts.term_freq(drop_stop_words(exploded, stop_word_table(spark, STOP)))


def stopword_file(spark: SparkSession, sf: str) -> DataFrame:
    """Pair counts with the stop words read from a file."""
    path = scratch_path(spark, "stop_words")
    stop_word_table(spark, STOP).write.text(path)
    return counted(_reviews(spark, sf), read_stop_words(spark, path))


def term_freq(spark: SparkSession, sf: str) -> DataFrame:
    return counts.term_freq(explode_terms(spread(_reviews(spark, sf)), "category", stop_words=STOP))


def term_total(spark: SparkSession, sf: str) -> DataFrame:
    return counts.term_totals(_freq(spark, sf))


def category_total(spark: SparkSession, sf: str) -> DataFrame:
    return counts.category_totals(_freq(spark, sf))


def grand_total(spark: SparkSession, sf: str) -> DataFrame:
    freq = _freq(spark, sf)
    pairs = counts.row_count(freq).select(F.col("rows").alias("pairs")).scalar()
    return counts.grand_total(freq).withColumn("pairs", pairs)


def marginals_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    return counts.all_margins(_freq(spark, sf))


def _rounded_scores(scores: DataFrame) -> DataFrame:
    return scores.withColumn("chi2", rounded(F.col("chi2")))


def chi2_by_window(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_scores(_scores(spark, sf))


def chi2_broadcast_join(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_scores(chi2_scores_by_join(_freq(spark, sf)))


def chi2_shuffle_join(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_scores(chi2_scores(_freq(spark, sf), max_categories=0))


# Best terms and report


def topk_terms(spark: SparkSession, sf: str) -> DataFrame:
    return top_terms(_scores(spark, sf), settings.TOP_TERMS)


def topk_terms_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return top_terms(_scores(spark, sf, "source"), settings.TOP_TERMS)


def topk_lists(spark: SparkSession, sf: str) -> DataFrame:
    lists = top_lists(topk_terms(spark, sf))
    return lists.select("category", F.size("terms").alias("n"), F.array_join("terms", " ").alias("terms"))


def cleaned_terms(spark: SparkSession, sf: str) -> DataFrame:
    return clean_terms(counts.distinct_terms(_freq(spark, sf)))


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return merged_dictionary(_freq(spark, sf))


def report(spark: SparkSession, sf: str) -> DataFrame:
    made = term_report(_reviews(spark, sf), STOP, settings.TOP_TERMS)
    return report_lines(made.top, made.dictionary).orderBy("section", "category", "line")


def text_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "category_lines")
    stop_word_table(spark, STOP).write.mode("overwrite").text(path)
    write_report(topk_terms(spark, sf), path)
    return read_category_lines(spark.read.text(path).withColumnRenamed("value", "line"))


def report_from_json(spark: SparkSession, sf: str) -> DataFrame:
    made = term_report(read_reviews(spark, _written_lines(spark, sf)), STOP, settings.TOP_TERMS)
    return category_lines(made.top)


# Features


def doc_freq(spark: SparkSession, sf: str) -> DataFrame:
    frequent = counts.document_freq(counts.corpus_counts(_with_terms(spark, sf)))
    return frequent.filter(F.col("df") >= settings.MIN_DOCUMENTS)


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return _vocabulary(_with_terms(spark, sf)).drop("idf")


def idf_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _vocabulary(_with_terms(spark, sf)).select("term", "df", rounded(F.col("idf")).alias("idf"))


def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    documents = _with_terms(spark, sf)
    return _long(PipelineModel(list(features.tfidf_stages(_vocabulary(documents)))).transform(documents), "features")


def feature_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """MLlib's own stages over the vocabulary whose ties are decided."""
    reviews = spread(_reviews(spark, sf))
    vectorizer, _ = features.tfidf_stages(_vocabulary(_with_terms(spark, sf)))
    model = features.feature_pipeline(STOP, vectorizer).fit(reviews)
    vocab = features.vocabulary_of(model.stages[2], reviews)
    weights = explode_vector(model.transform(reviews), "features", "doc_id", "label")
    return weights.join(checked_broadcast(vocab), "featureIndex").select(
        "doc_id", "label", "term", rounded(F.col("weight")).alias("weight")
    )


def count_vectorizer(spark: SparkSession, sf: str) -> DataFrame:
    """What MLlib's estimator learns, without the terms whose count is that of the cut: ties there are open."""
    documents = _with_terms(spark, sf)
    model = features.count_vectorizer(settings.VOCABULARY_SIZE, settings.MIN_DOCUMENTS).fit(documents)
    learnt = checked_broadcast(features.vocabulary_of(model, documents))
    known = counts.corpus_counts(documents).join(learnt, "term").select("term", "n")
    if len(model.vocabulary) < settings.VOCABULARY_SIZE:
        return known
    known = written(known, "learnt_terms")
    return known.filter(F.col("n") > known.agg(F.min("n")).scalar())


def _part_of_terms(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Training documents, and test documents with the counts of the terms that the training ones have."""
    parts = split.stable_split(_with_terms(spark, sf), "doc_id")
    return parts.filter("part = 'train'"), parts.filter("part = 'test'")


def heldout_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of the test part by the vocabulary and weights of the training part."""
    parts = split.stable_split(_reviews(spark, sf), "doc_id")
    train, test = (parts.filter(F.col("part") == name).drop("part") for name in ("train", "test"))
    built = build_features(test, STOP, settings.VOCABULARY_SIZE, settings.MIN_DOCUMENTS, fit_on=train)
    return _long(built.vectors, "features")


def heldout_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """How many terms of each test document the vocabulary of the training part does not hold."""
    train, test = _part_of_terms(spark, sf)
    counting, _ = features.tfidf_stages(_vocabulary(train))
    return features.known_terms(counting.transform(test), "doc_id")


def term_counts(spark: SparkSession, sf: str) -> DataFrame:
    documents = _with_terms(spark, sf)
    counting, _ = features.tfidf_stages(_vocabulary(documents))
    return _long(counting.transform(documents), "counts")


def label_index(spark: SparkSession, sf: str) -> DataFrame:
    return features.label_index(_reviews(spark, sf))


def label_index_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return features.label_index(_reviews(spark, sf, "source"))


def labelled_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the index of its source, by a join with the label table."""
    reviews = _reviews(spark, sf, "source")
    index = written(features.label_index(reviews), "label_index")
    return features.with_label(reviews.select("doc_id", "category"), index)


def _rounded_statistics(tested: DataFrame) -> DataFrame:
    return tested.select("featureIndex", rounded(F.col("statistic")).alias("statistic"), "degreesOfFreedom")


def feature_chi2(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_statistics(selection.feature_chi2(_vectors(spark, sf)))


def _role_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of conversations by role. Three roles make every number of degrees of freedom even."""
    turns = table(spark, sf, "conversations").withColumn("turn_id", F.concat_ws(":", "conv_id", "turn"))
    reviews = as_reviews(turns, "role", "text", "turn_id")
    return build_features(reviews, STOP, settings.VOCABULARY_SIZE, settings.MIN_DOCUMENTS).vectors


def _rounded_p_values(tested: DataFrame) -> DataFrame:
    return _rounded_statistics(tested.filter("degreesOfFreedom > 0")).join(
        tested.select("featureIndex", rounded(F.col("pValue")).alias("pValue")), "featureIndex"
    )


def feature_chi2_test(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_p_values(selection.feature_chi2_test(_role_vectors(spark, sf)))


def feature_p_values(spark: SparkSession, sf: str) -> DataFrame:
    tested = selection.with_p_value(selection.feature_chi2(_role_vectors(spark, sf)))
    return _rounded_p_values(written(tested, "p_values"))


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    built = _features(spark, sf)
    tested = _rounded_statistics(selection.feature_chi2(built.vectors))
    return selection.rank_features(tested, built.vocabulary, settings.VOCABULARY_SIZE)


def feature_chi2_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf).select("term", "statistic")


def top_feature(spark: SparkSession, sf: str) -> DataFrame:
    return top_rows(feature_chi2_rank(spark, sf), 1, "statistic")


def score_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "score_lines")
    write_scores(_ranked(spark, sf), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def select_by_statistic(spark: SparkSession, sf: str) -> DataFrame:
    tested = _rounded_statistics(selection.feature_chi2(_vectors(spark, sf)))
    return selection.select_by_statistic(tested, settings.SELECTED_FEATURES)


def select_by_pvalue(spark: SparkSession, sf: str) -> DataFrame:
    """Features of the conversation turns selected by full p-values; only the columns returned are rounded."""
    return _selected_by_pvalue(selection.feature_chi2(_role_vectors(spark, sf)))


def _selected_by_pvalue(tested: DataFrame) -> DataFrame:
    possible = tested.filter("degreesOfFreedom > 0")
    return _rounded_p_values(written(selection.select_by_pvalue(possible, settings.SELECTED_FEATURES), "selected_by_pvalue"))


def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf)
    return _long(classify.scaler(True, "features").fit(vectors).transform(vectors), "scaled")


def l2_features(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf)
    scaled = classify.scaler(True, "features").fit(vectors).transform(vectors)
    return _long(classify.normalizer().transform(scaled), "normal")


# Splits, training, evaluation


def stable_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.stable_split(_reviews(spark, sf).select("doc_id", "category"), "doc_id")


def random_split(spark: SparkSession, sf: str) -> DataFrame:
    """All parts together, and whether each row falls in the same part when the split is drawn again."""
    reviews = written(_reviews(spark, sf).select("doc_id", "category"), "split_input")

    def drawn(column: str) -> DataFrame:
        parts = split.random_split(reviews)
        named = [part.withColumn(column, F.lit(name)) for part, name in zip(parts, split.PARTS)]
        return split.union_all(split.union_all(named[0], named[1]), named[2])

    again = drawn("again").select("doc_id", "again")
    return drawn("part").join(again, "doc_id").select("doc_id", "category", (F.col("part") == F.col("again")).alias("same"))


def random_split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of the random split, and whether each has its share of the rows, give or take five deviations."""
    reviews = written(_reviews(spark, sf).select("doc_id"), "split_sizes")
    counted = None
    for part, name, weight in zip(split.random_split(reviews), split.PARTS, split.WEIGHTS):
        one = part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n", F.lit(weight).alias("weight"))
        counted = one if counted is None else counted.unionByName(one)
    total = F.sum("n").over(Window.partitionBy())  # three rows
    away = F.abs(F.col("n") - total * F.col("weight"))
    allowed = 5 * F.sqrt(total * F.col("weight") * (1 - F.col("weight")))
    return counted.select("part", total.alias("rows"), (away <= allowed).alias("in_bounds"))


def drawn_split(spark: SparkSession, sf: str) -> DataFrame:
    """The random draw of exact sizes, and the second draw that the tuner makes of train and validation."""
    reviews = _reviews(spark, sf).select("doc_id", "category")
    parts = split.drawn_split(reviews, "doc_id")
    merged = parts.filter("part != 'test'").select("doc_id")
    again = split.drawn_split(merged, "doc_id", split.WEIGHTS[:2], split.TUNING_SEED, split.PARTS[:2])
    return parts.join(again.withColumnRenamed("part", "tuning_part"), "doc_id", "left")


def train_val_union(spark: SparkSession, sf: str) -> DataFrame:
    parts = stable_split(spark, sf)
    train, validation = (parts.filter(F.col("part") == name) for name in split.PARTS[:2])
    return split.union_all(train, validation).select("doc_id", "category")


def param_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Each grid point with the number of features it selects and the lowest statistic among them."""
    grid = tuning.Grid(settings.GRID_FEATURES, settings.GRID_STD, settings.GRID_REG, settings.GRID_ITER)
    best = written(select_by_statistic(spark, sf), "selected")
    chosen = None
    for k in settings.GRID_FEATURES:
        one = selection.select_by_statistic(best, k).agg(
            F.count(F.lit(1)).alias("n_features"), F.min("statistic").alias("lowest_statistic")
        ).withColumn("numTopFeatures", F.lit(k))
        chosen = one if chosen is None else chosen.unionByName(one)
    return tuning.param_grid(spark, grid).join(chosen, "numTopFeatures")


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    vectors = _vectors(spark, sf)
    parts = split.stable_split(vectors, "doc_id")
    return parts.filter("part != 'test'"), parts.filter("part = 'test'")


def svm_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows with their label, and whether the prediction is the largest of margins computed here."""
    train, test = _parts(spark, sf)
    model = _fitted(train)
    scored = model.transform(test).select("doc_id", "label", "prediction", "normal")
    return scored.select("doc_id", "label", "prediction").join(_largest_margin(model, scored), "doc_id").select(
        "doc_id", "label", (F.col("prediction") == F.col("largest")).alias("agrees")
    )


def _fitted(train: DataFrame) -> PipelineModel:
    return tuning.fit_point(train, tuning.Point(settings.SELECTED_FEATURES, True, 0.1, 5))


def _largest_margin(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """Each row's class of largest margin, from the vectors' entries and every class's coefficients."""
    machines = model.stages[-1].models
    entries = [
        (float(label), index, float(weight))
        for label, machine in enumerate(machines)
        for index, weight in enumerate(machine.coefficients.toArray())
    ]
    weights = rows(scored.sparkSession, entries, "class double, featureIndex int, coefficient double")
    sums = (
        explode_vector(scored, "normal", "doc_id")
        .join(checked_broadcast(weights), "featureIndex")
        .groupBy("doc_id", "class")
        .agg(F.sum(F.col("weight") * F.col("coefficient")).alias("product"))
    )
    offsets = F.array(
        *(F.struct(F.lit(float(label)).alias("class"), F.lit(machine.intercept).alias("offset")) for label, machine in enumerate(machines))
    )
    every = scored.select("doc_id", F.inline(offsets)).join(sums, ["doc_id", "class"], "left")
    margin = F.coalesce("product", F.lit(0.0)) + F.col("offset")
    return every.groupBy("doc_id").agg(F.max_by("class", margin).alias("largest"))


def weighted_f1(spark: SparkSession, sf: str) -> DataFrame:
    text = F.lower("reviewText")
    guess = (
        F.when(text.contains(" der "), "de")
        .when(text.contains(" les "), "fr")
        .when(text.contains(" los "), "es")
        .otherwise("en")
    )
    pairs = _reviews(spark, sf).select(F.col("category").alias("label"), guess.alias("prediction"))
    return evaluate.weighted_f1(pairs).select("rows", rounded(F.col("f1")).alias("f1"))


def weighted_f1_binary(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))
    return evaluate.weighted_f1(pairs).select("rows", rounded(F.col("f1")).alias("f1"))


PARALLELISM = 4
# Two trainings that differ in rounding may judge a row or two differently.
CLOSE = 0.02
# Bytes of a vector's entry in MLlib's rows and blocks, and points fitted at a time at most.
ENTRY_BYTES = 16
POINTS = 4


def tuning_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The points tried, and whether each F1 is in range and that of the point's own pipeline, fitted alone."""
    parts = split.stable_split(_vectors(spark, sf), "doc_id").select("part", "label", "features").persist(KEPT)
    try:
        train, validation = (parts.filter(F.col("part") == name).drop("part") for name in split.PARTS[:2])
        metrics = tuning.tune_on_parts(train, validation, tuning.Grid(), PARALLELISM)
        return _checked_alone(metrics, train, validation)
    finally:
        parts.unpersist()


def _checked_alone(metrics: DataFrame, train: DataFrame, validation: DataFrame) -> DataFrame:
    """Every point with `same`: its F1 is in range and that of MLlib's own pipeline, fitted with it alone, give or take CLOSE.

    A fit is many short passes, which leave cores idle, so several run at a time if the executors can hold their rows.
    """
    spark = metrics.sparkSession
    tried = metrics.collect()
    ranking = selection.pvalue_ranking(train, max(row.numTopFeatures for row in tried))
    entries = train.agg(F.sum(F.size(F.unwrap_udt("features")["values"]))).first()[0] or 0
    points, classes = _at_a_time(entries * ENTRY_BYTES, storage_room(spark) // 2)

    def checked(point: tuple) -> tuple:
        *values, f1 = point
        scored = classify.classifier_pipeline(ranking, *values, classes).fit(train).transform(validation)
        alone = evaluate.weighted_f1(scored.select("label", "prediction")).first().f1
        return *values, 0 <= f1 <= 1 and abs(f1 - alone) <= CLOSE

    with ThreadPool(points) as pool:
        found = pool.map(inheritable_thread_target(spark)(checked), tried, chunksize=1)
    return rows(spark, found, "numTopFeatures int, withStd boolean, regParam double, maxIter int, same boolean")


def _at_a_time(size: int, room: int) -> tuple[int, int]:
    """How many points to fit at a time and how many classes in each, with rows of so many bytes.

    MLlib holds a fit's rows once for the fit and once for each class in training; at least one of either is fitted.
    """
    copies = room // max(size, 1)
    classes = min(max(copies - 1, 1), PARALLELISM)
    return min(max(copies // (classes + 1), 1), POINTS), classes


def best_params(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the best point is the best of its metrics, and beats guessing the most frequent label."""
    vectors = _vectors(spark, sf)
    tuned = tuned_classifier(vectors, "doc_id", tuning.Grid(), PARALLELISM)
    best, top = tuned.best.first(), tuning.best_point(tuned.metrics)
    test = split.stable_split(vectors, "doc_id").filter("part = 'test'")
    guess = evaluate.weighted_f1(test.select("label", F.lit(0.0).alias("prediction")))
    chosen = (best.numTopFeatures, best.withStd, best.regParam, best.maxIter) == astuple(top)
    return guess.select(
        "rows", rounded(F.col("f1")).alias("guess_f1"), (F.lit(best.f1) > F.col("f1")).alias("beats_guess"), F.lit(chosen).alias("is_best")
    )


def random_tuning(spark: SparkSession, sf: str) -> DataFrame:
    """All points tuned on random draws, with the drawn sizes, and whether the rows dealt anew give the same F1."""
    vectors = _vectors(spark, sf).select("doc_id", "label", "features")
    tuned = randomly_tuned_classifier(vectors, "doc_id", tuning.Grid(), parallelism=PARALLELISM)
    # Dealt by key, to as many tasks as there is work for; by label, one task would have the largest label.
    dealt = written(vectors.repartition("doc_id"), "dealt_vectors")
    merged = split.drawn_split(dealt, "doc_id").filter("part != 'test'").drop("part")
    drawn = split.drawn_split(merged, "doc_id", split.WEIGHTS[:2], split.TUNING_SEED, split.PARTS[:2])
    parts = [drawn.filter(F.col("part") == name).drop("part") for name in split.PARTS[:2]]
    again = {tuple(row)[:4]: row.f1 for row in tuning.tune_on_parts(*parts, tuning.Grid(), PARALLELISM).collect()}
    sizes = [part.count() for part in parts]
    chosen = tuple(tuned.best.first())[:4] == astuple(tuning.best_point(tuned.metrics))
    checked = []
    for *values, f1 in tuned.metrics.collect():
        checked.append((*values, *sizes, chosen and 0 <= f1 <= 1 and abs(f1 - again[tuple(values)]) <= CLOSE))
    schema = "numTopFeatures int, withStd boolean, regParam double, maxIter int, train long, validation long, same boolean"
    return rows(spark, checked, schema)


def raw_text_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every document scored from its raw text by a stored and reloaded model, and whether the vector path agrees."""
    built = _features(spark, sf)
    parts = split.stable_split(built.vectors, "doc_id")
    fitted = _fitted(parts.filter("part != 'test'"))
    path = scratch_path(spark, "text_model")
    save_model(text_classifier(built, fitted), path)
    texts = score_texts(load_model(path), spread(table(spark, sf, "documents")), "text", ["doc_id", "lang"])
    vectors = classify.score(fitted, built.vectors, "doc_id").withColumnRenamed("prediction", "by_vector")
    joined = texts.join(vectors, "doc_id", "left")
    index = written(features.label_index(_reviews(spark, sf)), "label_index").withColumnRenamed("label", "number")
    named = joined.join(checked_broadcast(index.select(F.col("category").alias("predicted"), "number")), "predicted", "left")
    return named.select(
        "doc_id",
        F.coalesce(F.col("prediction") == F.col("by_vector"), F.lit(True)).alias("same"),
        (F.col("prediction") == F.col("number")).alias("named"),
    )


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _parts(spark, sf)
    model = _fitted(train)
    path = scratch_path(spark, "model")
    save_model(model, path)
    before = classify.score(model, test, "doc_id")
    after = classify.score(load_model(path), test, "doc_id").withColumnRenamed("prediction", "reloaded")
    return before.join(after, "doc_id").select("doc_id", (F.col("prediction") == F.col("reloaded")).alias("same"))


QUERIES = {
    "json_parse": json_parse,
    "json_rejects": json_rejects,
    "rejected_lines": rejected_lines,
    "text_scan": text_scan,
    "json_scan": json_scan,
    "stopword_table": stopword_table,
    "tokens_task1": tokens_task1,
    "tokens_task2": tokens_task2,
    "stopword_anti_join": stopword_anti_join,
    "stopword_file": stopword_file,
    "term_freq": term_freq,
    "term_total": term_total,
    "category_total": category_total,
    "grand_total": grand_total,
    "marginals_grouping_sets": marginals_grouping_sets,
    "chi2_scores": chi2_by_window,
    "chi2_broadcast_join": chi2_broadcast_join,
    "chi2_shuffle_join": chi2_shuffle_join,
    "topk_terms": topk_terms,
    "topk_terms_by_source": topk_terms_by_source,
    "topk_lists": topk_lists,
    "clean_terms": cleaned_terms,
    "merged_dictionary": dictionary,
    "category_lines": report,
    "report_from_json": report_from_json,
    "text_sink_roundtrip": text_sink_roundtrip,
    "doc_freq": doc_freq,
    "vocabulary": vocabulary,
    "count_vectorizer": count_vectorizer,
    "term_counts": term_counts,
    "idf_weights": idf_weights,
    "tfidf": tfidf,
    "feature_pipeline": feature_pipeline,
    "label_index": label_index,
    "label_index_by_source": label_index_by_source,
    "labelled_rows": labelled_rows,
    "heldout_tfidf": heldout_tfidf,
    "heldout_vocabulary": heldout_vocabulary,
    "feature_chi2": feature_chi2,
    "feature_chi2_test": feature_chi2_test,
    "feature_p_values": feature_p_values,
    "feature_chi2_rank": feature_chi2_rank,
    "top_feature": top_feature,
    "score_sink_roundtrip": score_sink_roundtrip,
    "select_by_statistic": select_by_statistic,
    "select_by_pvalue": select_by_pvalue,
    "scaled_features": scaled_features,
    "l2_features": l2_features,
    "stable_split": stable_split,
    "random_split": random_split,
    "random_split_sizes": random_split_sizes,
    "drawn_split": drawn_split,
    "train_val_union": train_val_union,
    "param_grid": param_grid,
    "svm_predictions": svm_predictions,
    "weighted_f1": weighted_f1,
    "weighted_f1_binary": weighted_f1_binary,
    "tuning_metrics": tuning_metrics,
    "random_tuning": random_tuning,
    "raw_text_scores": raw_text_scores,
    "best_params": best_params,
    "model_roundtrip": model_roundtrip,
}
