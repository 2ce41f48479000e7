"""Vocabulary, TF-IDF vectors and label indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from termlift.functions.text import FEATURE_DELIMITERS, MIN_TERM_LENGTH, spelled_out
from termlift.operators.counts import document_count, document_freq
from termlift.operators.numbering import numbered
from termlift.plans.scale import checked_broadcast
from termlift.sources.tables import rows

VOCABULARY_SIZE = 2000
MIN_DOCUMENTS = 2


def vocabulary(corpus: DataFrame, size: int = VOCABULARY_SIZE, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The `size` most frequent terms found in enough documents: `featureIndex, term, n, df, idf`.

    Reads a written `corpus_counts` table. Equal counts go by term, so the
    result does not depend on partitioning. The weight `idf` is
    ln((documents + 1) / (df + 1)). The numbering window holds `size` rows at most.
    """
    frequent = document_freq(corpus).filter(F.col("df") >= min_documents)
    order = (F.desc("n"), F.asc("term"))
    number = F.row_number().over(Window.orderBy(*order)) - 1
    documents = document_count(corpus).scalar()
    idf = F.log((documents + F.lit(1.0)) / (F.col("df") + 1))
    return frequent.orderBy(*order).limit(size).select(
        number.alias("featureIndex"), "term", "n", "df", idf.alias("idf")
    )


def tfidf_stages(vocab: DataFrame, terms: str = "terms") -> tuple[CountVectorizerModel, ElementwiseProduct]:
    """Transformers from `terms` to `counts` to `features` (TF-IDF), both over a `vocabulary` table.

    The vocabulary's rows, as many as its size, go to the driver, as they do in
    a fitted count vectorizer. The weights come with them, so no pass fits them.
    """
    ordered = sorted(vocab.select("featureIndex", "term", "idf").collect())
    counting = CountVectorizerModel.from_vocabulary([row.term for row in ordered], terms, "counts")
    weights = Vectors.dense([row.idf for row in ordered])
    return counting, ElementwiseProduct(scalingVec=weights, inputCol="counts", outputCol="features")


def term_stages(stop_words: Sequence[str], text: str = "reviewText") -> tuple[RegexTokenizer, StopWordsRemover]:
    """Transformers from a text column to `tokens` to `terms`.

    Stop words match whatever their case: the tokens are lower-cased once, by the tokenizer, and the words here.
    """
    tokenizer = RegexTokenizer(
        inputCol=text, outputCol="tokens", pattern=spelled_out(FEATURE_DELIMITERS), minTokenLength=MIN_TERM_LENGTH
    )
    lowered = sorted({word.lower() for word in stop_words})
    return tokenizer, StopWordsRemover(inputCol="tokens", outputCol="terms", stopWords=lowered, caseSensitive=True)


def count_vectorizer(size: int = VOCABULARY_SIZE, min_documents: int = MIN_DOCUMENTS) -> CountVectorizer:
    """MLlib's own estimator; which of equally frequent terms at the cut are kept is up to the partitioning."""
    return CountVectorizer(inputCol="terms", outputCol="counts", vocabSize=size, minDF=min_documents)


def feature_pipeline(
    stop_words: Sequence[str],
    vectorizer: CountVectorizer | CountVectorizerModel,
    text: str = "reviewText",
    label: str = "category",
) -> Pipeline:
    """Tokenizer, stop-word remover, vectorizer, IDF and label indexer in one estimator.

    Fitting reads the texts once for each stage that learns; `build_features` shares passes.
    """
    return Pipeline(
        stages=[
            *term_stages(stop_words, text),
            vectorizer,
            IDF(inputCol="counts", outputCol="features"),
            StringIndexer(inputCol=label, outputCol="label"),
        ]
    )


def label_indexer(labelled: DataFrame, label: str = "category"):
    """Fitted indexer: 0 is the most frequent label, equal counts go by label."""
    return StringIndexer(inputCol=label, outputCol="label").fit(labelled)


def label_index(labelled: DataFrame, label: str = "category") -> DataFrame:
    """One row per label: the label, its row count `n` and its index `label`, as `label_indexer` numbers them.

    For any number of labels: they are numbered where they lie, and none goes to the driver.
    """
    counts = labelled.select(label).filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return numbered(counts, "label", F.desc("n"), F.asc(label)).withColumn("label", F.col("label").cast("double"))


def with_label(labelled: DataFrame, index: DataFrame, label: str = "category") -> DataFrame:
    """Add the index of each row's label by a join with a `label_index` table; null for a label that is not in it.

    A short table goes to the rows; a long one meets them by a shuffle, where adaptive
    execution splits the rows of a frequent label.
    """
    return labelled.join(checked_broadcast(index.select(label, "label")), label, "left")


def vocabulary_of(model: CountVectorizerModel, like: DataFrame) -> DataFrame:
    """A fitted vectorizer's vocabulary as `featureIndex, term`."""
    one = rows(like.sparkSession, [(model.vocabulary,)], "terms array<string>")
    return one.select(F.posexplode("terms").alias("featureIndex", "term"))


def known_terms(counted: DataFrame, *keep: str) -> DataFrame:
    """The kept columns with each row's number of terms, `n_terms`, and of those outside the vocabulary, `n_unknown`.

    `counted` has `terms` and their `counts` by the vocabulary; the entries of a row's vector add up to its known terms.
    """
    known = F.aggregate(F.unwrap_udt("counts")["values"], F.lit(0.0), lambda total, x: total + x).cast("int")
    return counted.select(*keep, F.size("terms").alias("n_terms"), (F.size("terms") - known).alias("n_unknown"))
