"""From raw documents to packed training sequences: rules, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again before the next one. All stages but the last return the columns
of `documents`. What a stage keeps in the scratch folder is needed until its result
is written, so the next stage deletes it when it begins; results are not deleted by
stages, and `run` deletes each when the one after it is written. Files of shuffles that
no table refers to any more go when the next stage begins.

Defined results: an empty table gives an empty result; rows with a null id stay in
all stages but are not compared with others; of rows with equal ids the near-duplicate
stage keeps one; null texts fail the quality rules; further columns of `documents`
pass through all stages but the last, whatever their names. Ids are whole numbers.
"""

from __future__ import annotations

import functools
import gc
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlift.llm import bpe, minhash, packing, quality, suffix_dedup
from termlift.llm.queries import TOKENIZER
from termlift.plans.scale import delete_scratch, scratch_paths, written
from termlift.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80

# Stages that learn from the corpus and exact removal of byte strings have no SQL form here.
ORACLE_SQL = None


# What the last stage that ran has put into the scratch folder.
_left: list[str] = []


def _freeing(stage: Stage) -> Stage:
    """The stage, which first frees what the one before it kept for itself: its scratch tables and its shuffles' files."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_scratch(spark, _left)
        # Spark deletes a shuffle's files once nothing in the driver refers to it, which it notices when it collects garbage.
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        before = set(scratch_paths())
        result = stage(spark, docs, sf_dir)
        _left[:] = [path for path in scratch_paths() if path not in before]
        return result

    return run_stage


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the thresholds of their language and source."""
    return quality.quality_filter(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates."""
    return minhash.without_near_duplicates(docs, width=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds; `n_chars` counts what is left."""
    cut = suffix_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every encoded document in the training sequences."""
    return packing.pack(docs, bpe.read_definition(TOKENIZER))


STAGES = [
    ("quality_rules", _freeing(keep_good_quality)),
    ("minhash_near_dedup", _freeing(keep_one_of_near_duplicates)),
    ("suffix_array_dedup", _freeing(cut_repeated_passages)),
    ("packing", _freeing(pack_sequences)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is a written table."""
    docs, former = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        before = set(scratch_paths())
        docs = written(result, name)
        delete_scratch(spark, former)
        former = [path for path in scratch_paths() if path not in before]
    delete_scratch(spark, _left)
    return docs
