"""Shards of bounded size by extendible hashing.

A row's hash is the first HASH_BITS bits of md5 of its key. The directory starts
with one bucket; a bucket above the byte limit splits on its next bit, its
halves again, until each fits. So a row's bucket is its shortest hash prefix
whose rows fit, and only oversized prefixes need counting: the rows are summed
once into cells of a common depth, and cells that are still oversized are
refined by more bits until none is left.

Defined results: a null text has no bytes; a null key hashes as the empty
string; rows of equal key share a hash, so a bucket that holds a single hash
value stays whole even above the limit (`oversized` marks it); an empty table
gives an empty result. Everything is SQL expressions; no Python runs on rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlift.plans.scale import checked_broadcast, written

HASH_BITS = 60
SHARD_BYTES = 64 * 1024 * 1024
# Each round looks this many bits further than the last; a cell then holds 1/256 of what was too large.
ROUND_BITS = 8


def hash_bits(key: Column) -> Column:
    """The first 60 bits of md5 as a string of zeros and ones."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return F.lpad(F.conv(digits, 16, 2), HASH_BITS, "0")


def _prefix_sizes(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Bytes and distinct hashes below every prefix of `low` to `high` bits.

    The rows are summed to cells of `high` bits first, so that the prefixes are
    made from one row per cell.
    """
    cells = rows.groupBy(F.substring("s_bits", 1, high).alias("cell")).agg(
        F.sum("s_bytes").alias("bytes"), F.min("s_bits").alias("first"), F.max("s_bits").alias("last")
    )
    depths = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")
    prefixes = cells.select("*", depths).withColumn("prefix", F.expr("substring(cell, 1, depth)"))
    return prefixes.groupBy("depth", "prefix").agg(
        F.sum("bytes").alias("bytes"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def directory(keys: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """All prefixes that a bucket had on the way: depth, prefix, bytes, settled.

    `keys` has `s_bits` and `s_bytes`. A prefix is settled if it fits the limit
    or holds one hash value only.
    """
    low, parts, rest = 0, None, keys
    while True:
        high = min(low + ROUND_BITS, HASH_BITS)
        fits = (F.col("bytes") <= limit) | (F.col("first") == F.col("last")) | (F.col("depth") == HASH_BITS)
        sizes = written(_prefix_sizes(rest, low, high).select("depth", "prefix", "bytes", fits.alias("settled")), "shard_sizes")
        parts = sizes if parts is None else parts.unionByName(sizes)
        open_cells = sizes.filter((F.col("depth") == high) & ~F.col("settled")).select("prefix")
        if not open_cells.take(1):
            return parts
        rest = rest.join(open_cells, F.substring("s_bits", 1, high) == F.col("prefix"), "left_semi")
        low = high + 1


def buckets(parts: DataFrame) -> DataFrame:
    """The final buckets: settled prefixes whose parent was split. The root has no parent."""
    split = parts.filter(~F.col("settled")).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    root = parts.filter((F.col("depth") == 0) & F.col("settled"))
    parent = F.expr("substring(prefix, 1, depth - 1)").alias("parent")
    settled = parts.filter((F.col("depth") > 0) & F.col("settled")).select("*", parent)
    return settled.join(split, ["depth", "parent"], "left_semi").drop("parent").unionByName(root)


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """Append `s_shard` (the bucket's bits), `s_depth`, `s_bytes` (of the row) and `s_oversized` to every row.

    A row tries its prefix at each depth in use, a few neighbouring numbers;
    one of them is a bucket.
    """
    sized = docs.withColumn("s_bits", hash_bits(F.col(key))).withColumn(
        "s_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    )
    final = written(buckets(directory(sized.select("s_bits", "s_bytes"), limit)), "shard_buckets")
    depths = [row.depth for row in final.select("depth").distinct().collect()]  # at most HASH_BITS + 1 numbers
    large = (F.col("bytes") > limit).alias("s_oversized")
    table = final.select(F.col("prefix").alias("s_shard"), F.col("depth").alias("s_depth"), large)
    options = F.array(*(F.lit(depth) for depth in sorted(depths))).cast("array<int>")
    tried = sized.withColumn("s_depth", F.explode(options)).withColumn("s_shard", F.expr("substring(s_bits, 1, s_depth)"))
    return tried.join(checked_broadcast(table), ["s_depth", "s_shard"]).drop("s_bits")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> None:
    """Write each shard to a folder of its own; a shard's rows meet in one task, which the limit bounds."""
    names = [f"`{name}`" for name in docs.columns]
    placed = shard(docs, key, text, limit).select(*names, F.concat(F.lit("b"), "s_shard").alias("shard"))
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
