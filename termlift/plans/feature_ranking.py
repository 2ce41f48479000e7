"""Job 2: TF-IDF features and their chi-square ranking."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from termlift.operators.counts import corpus_counts
from termlift.operators.features import (
    MIN_DOCUMENTS,
    VOCABULARY_SIZE,
    label_indexer,
    term_stages,
    tfidf_stages,
    vocabulary,
)
from termlift.operators.selection import feature_chi2, rank_features
from termlift.operators.tokens import add_pieces, kept_terms
from termlift.plans.scale import spread, written
from termlift.sources.stopwords import stop_word_list


@dataclass(frozen=True)
class Features:
    """A fitted feature pipeline, its vocabulary, and the vectors it gives."""

    model: PipelineModel
    vocabulary: DataFrame
    vectors: DataFrame


def build_features(
    reviews: DataFrame,
    stop_words: Sequence[str] | DataFrame,
    size: int = VOCABULARY_SIZE,
    min_documents: int = MIN_DOCUMENTS,
    fit_on: DataFrame | None = None,
) -> Features:
    """Vocabulary, TF-IDF vectors and label indexes of `category, reviewText` rows.

    The texts are read twice: once for the vocabulary with its weights, once
    for the vectors. The vectors are written with every column of `reviews` but
    the text, and the labels are counted on that table. Both passes split the
    texts by SQL expressions; the model does the same by MLlib stages, so that
    it can be saved and applied to raw texts. Stop words and short pieces are
    dropped from the counts: what the vocabulary has not, no vector has.
    By default all rows make the vocabulary and weights. To keep test rows out
    of them, pass the training rows as `fit_on`.
    """
    if isinstance(stop_words, DataFrame):
        stop_words = stop_word_list(stop_words)
    documents = add_pieces(spread(reviews))
    fitted = documents if fit_on is None else add_pieces(spread(fit_on))
    corpus = written(kept_terms(corpus_counts(fitted), stop_words), "corpus_counts")
    vocab = vocabulary(corpus, size, min_documents)
    weighting = tfidf_stages(vocab)
    keep = [column for column in reviews.columns if column != "reviewText"]
    vectors = written(PipelineModel(list(weighting)).transform(documents).select(*keep, "features"), "vectors")
    indexer = label_indexer(vectors)
    model = PipelineModel([*term_stages(stop_words), *weighting, indexer])
    return Features(model, vocab, indexer.transform(vectors))


def feature_ranking(features: Features, k: int = VOCABULARY_SIZE) -> DataFrame:
    """The k terms with the largest statistic, best first."""
    return rank_features(feature_chi2(features.vectors), features.vocabulary, k)
