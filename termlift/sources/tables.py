"""Parquet tables and in-memory rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan of one parquet table in a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rows(spark: SparkSession, values: Sequence[tuple], schema: str) -> DataFrame:
    """Small in-memory table with an explicit schema.

    It goes through Arrow, so Spark plans it as a local table and starts no Python worker.
    """
    fields = T.StructType.fromDDL(schema)
    columns = zip(*values) if values else [()] * len(fields)
    arrays = [pa.array(list(column), to_arrow_type(field.dataType)) for column, field in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=fields.names), fields)
