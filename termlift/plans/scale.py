"""Written intermediate tables, checked broadcasts and input spreading."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table within both bounds may be broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Session setting: partitions to deal the input of a text pass to.
INPUT_PARTITIONS = "spark.termlift.inputPartitions"


def scratch_dir(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables, which all executors share.

    It lies below `spark.checkpoint.dir`, else the folder given to
    `SparkContext.setCheckpointDir`. Unset, it lies below the warehouse where driver and
    executors are one process; on a cluster the warehouse may be a folder of the driver's
    machine, so there one of the two must be set.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/termlift/{context.applicationId}"


def discard_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. DataFrames that still read them can no longer run."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the scratch folder that no other call gets."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


# The scratch paths that this process has given out and not yet deleted, in order.
_given: list[str] = []


def scratch_paths() -> list[str]:
    """The scratch paths given out so far that were not deleted."""
    return list(_given)


def delete_scratch(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete some scratch paths. DataFrames that still read them can no longer run."""
    jvm = spark.sparkContext._jvm
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        if name in _given:
            _given.remove(name)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a parquet table and return a scan of it.

    Cuts the lineage, survives lost executors, lets several consumers share one
    expensive pass, and gives the optimizer true file sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def within(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True if a table is within both bounds; stops reading just beyond the first.

    Strings and binaries count with their bytes, arrays, maps and structs with those of
    their JSON form, all else with eight.

    The check is an action: give it a scan or another cheap plan.
    """
    size = F.lit(0)
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = F.octet_length(column)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = F.octet_length(F.to_json(F.struct(column)))
        else:
            width = F.lit(8)
        size = size + F.coalesce(width, F.lit(0))
    seen = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).first()
    return seen.rows <= max_rows and (seen.bytes or 0) <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if the table is proven small.

    Beyond the bounds the table comes back without a hint, so the join shuffles
    and adaptive execution may split its skewed partitions.
    """
    return F.broadcast(df) if within(df, max_rows) else df


def storage_room(spark: SparkSession) -> int:
    """Bytes that all executors can hold in memory, for cached rows and for running tasks together."""
    room = 0
    managers = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    while managers.hasNext():
        room += managers.next()._1()
    return room


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows to as many partitions as the session setting INPUT_PARTITIONS says; unset, leave them.

    A few small files would otherwise be tokenised on a few cores. Large inputs
    have splits enough and need no setting.
    """
    wanted = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted else df
