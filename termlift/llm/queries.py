"""One query per operator, over the whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlift.llm import bpe, ctw, lattice, licenses, minhash, nra, packing, phrases, quality, sharding, spotsigs, suffix_dedup, token_counts
from termlift.sources.tables import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# The byte limit of a shard here. Small enough that tables of a few megabytes split too; 64 MiB is the default.
SHARD_BYTES = 512 * 1024


def _documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return table(spark, sf, "documents").select(*columns)


def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.removal_report(_documents(spark, sf, "doc_id", "text"))


def op2_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encoding_digests(_documents(spark, sf, "doc_id", "text"), bpe.read_definition(TOKENIZER))


def op3_ctw(spark: SparkSession, sf: str) -> DataFrame:
    return ctw.scores(_documents(spark, sf, "doc_id", "text"))


def op4_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shard(_documents(spark, sf, "doc_id", "text"), limit=SHARD_BYTES)
    return placed.select(
        "doc_id",
        F.col("s_shard").alias("shard"),
        F.col("s_depth").alias("depth"),
        F.col("s_bytes").alias("n_bytes"),
        F.col("s_oversized").alias("oversized"),
    )


def op5_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf, "doc_id", "text"))


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_documents(spark, sf, "doc_id", "text"), bpe.read_definition(TOKENIZER))


def op7_lattice(spark: SparkSession, sf: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf, "embeddings").select("vec_id", "embedding", "label"))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf, "text"), bpe.read_definition(TOKENIZER))


def op9_licenses(spark: SparkSession, sf: str) -> DataFrame:
    scanned = licenses.scan(_documents(spark, sf, "doc_id", "text"))
    return scanned.select(
        "doc_id", F.col("l_license").alias("license"), F.col("l_dice").alias("dice"), F.col("l_units").alias("n_units")
    )


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(table(spark, sf, "documents"))


def op11_spotsigs(spark: SparkSession, sf: str) -> DataFrame:
    return spotsigs.followed(_documents(spark, sf, "doc_id", "text"))


def op12_nra_search(spark: SparkSession, sf: str) -> DataFrame:
    return nra.search(_documents(spark, sf, "doc_id", "text"), table(spark, sf, "benchmark").select("item_id", "text"))


def op13_son_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.top_collocations(_documents(spark, sf, "text", "lang"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_bpe": op2_bpe,
    "op3_ctw": op3_ctw,
    "op4_sharding": op4_sharding,
    "op5_minhash": op5_minhash,
    "op6_packing": op6_packing,
    "op7_lattice": op7_lattice,
    "op8_token_counts": op8_token_counts,
    "op9_licenses": op9_licenses,
    "op10_quality": op10_quality,
    "op11_spotsigs": op11_spotsigs,
    "op12_nra_search": op12_nra_search,
    "op13_son_phrases": op13_son_phrases,
}
