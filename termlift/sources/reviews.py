"""Labelled text records from JSON lines or from tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termlift.plans.scale import checked_broadcast, scratch_path, written

REVIEW_SCHEMA = T.StructType(
    [T.StructField("category", T.StringType()), T.StructField("reviewText", T.StringType())]
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in column `value`, from any path Spark can read."""
    return spark.read.text(path)


def parse_lines(lines: DataFrame, schema: T.StructType = REVIEW_SCHEMA, line: str = "value") -> DataFrame:
    """Parse one JSON object per line and mark the lines that are none.

    Adds the schema's fields and `parsed`. Blank lines, broken JSON, JSON that
    is not an object and text after the object give `parsed = false` and null
    fields. Alone, Spark's parser stops at the end of the first object; read as
    the only element of an array, a line must be one object and nothing else.
    Passing the result through a generator keeps later filters from being
    pushed below it, where each would parse the line again.
    """
    text = F.col(line)
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    records = F.from_json(wrapped, T.ArrayType(schema), {"allowSingleQuotes": "false"})
    closed = F.endswith(F.rtrim(text, F.lit(" \t\r\n")), F.lit("}"))
    one = F.array(F.struct(records.alias("_records"), closed.alias("_closed")))
    found = lines.select("*", F.inline(one))
    first = F.get("_records", F.lit(0))
    parsed = F.coalesce((F.size("_records") == 1) & first.isNotNull() & F.col("_closed"), F.lit(False))
    fields = [F.when(F.col("parsed"), first[field.name]).alias(field.name) for field in schema.fields]
    return found.withColumn("parsed", parsed).select(*lines.columns, *fields, "parsed")


def json_field(line: Column, field: str) -> Column:
    """One top-level field of a JSON line as text; null if missing."""
    return F.get_json_object(line, f"$.{field}")


def usable(reviews: DataFrame) -> DataFrame:
    """Rows with both a category and a text."""
    return reviews.filter(F.col("category").isNotNull() & F.col("reviewText").isNotNull())


def rejected(parsed: DataFrame) -> DataFrame:
    """One row that counts lines, unparsable lines, missing categories, missing texts and kept lines."""
    good = F.col("parsed")
    no_category = good & F.col("category").isNull()
    no_text = good & F.col("category").isNotNull() & F.col("reviewText").isNull()
    kept = good & F.col("category").isNotNull() & F.col("reviewText").isNotNull()
    return parsed.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~good).alias("unparsable"),
        F.count_if(no_category).alias("no_category"),
        F.count_if(no_text).alias("no_text"),
        F.count_if(kept).alias("kept"),
    )


def reject_reason() -> Column:
    """Why a parsed line is not used; null for a usable one. The reasons are those that `rejected` counts."""
    return (
        F.when(~F.col("parsed"), "unparsable")
        .when(F.col("category").isNull(), "no_category")
        .when(F.col("reviewText").isNull(), "no_text")
    )


@dataclass(frozen=True)
class Scan:
    """The usable records of a scan, and its rejected lines with reason and position."""

    reviews: DataFrame
    rejects: DataFrame


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType = REVIEW_SCHEMA) -> Scan:
    """Tolerant scan with a side output: both come out of one pass over the lines.

    The pass writes a table in two parts. `reviews` is what `read_reviews` gives. `rejects`
    has a row per other line: `file`, `block` (the byte at which the line's split of the
    file begins), `place` (the line's number in that split, from 0), `reason` and `line`.
    Lines of a split are numbered as they are read, so file, block and place name one
    line, and are the same whenever the file is split alike.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("_line"),
    )
    parsed = parse_lines(lines, schema, "_line")
    reason = reject_reason().alias("_reason")
    line = F.when(reason.isNotNull(), F.col("_line")).alias("_line")
    fields = [F.when(reason.isNull(), F.col(name)).alias(name) for name in schema.names]
    where = scratch_path(spark, "scanned_lines")
    parsed.select("_file", "_block", "_id", line, reason, *fields).withColumn(
        "_rejected", F.col("_reason").isNotNull()
    ).write.partitionBy("_rejected").parquet(where)
    kinds = [T.StructField("_file", T.StringType()), T.StructField("_block", T.LongType()), T.StructField("_id", T.LongType())]
    kinds += [T.StructField("_line", T.StringType()), T.StructField("_reason", T.StringType()), *schema.fields]
    scanned = spark.read.schema(T.StructType([*kinds, T.StructField("_rejected", T.BooleanType())])).parquet(where)
    # A row per split.
    starts = scanned.groupBy("_file", "_block").agg(F.min("_id").alias("_first"))
    found = scanned.filter("_rejected").join(checked_broadcast(written(starts, "splits")), ["_file", "_block"])
    rejects = found.select(
        F.col("_file").alias("file"),
        F.col("_block").alias("block"),
        (F.col("_id") - F.col("_first")).alias("place"),
        F.col("_reason").alias("reason"),
        F.col("_line").alias("line"),
    )
    return Scan(scanned.filter("NOT _rejected").select(*schema.names), rejects)


def read_reviews(spark: SparkSession, path: str, schema: T.StructType = REVIEW_SCHEMA) -> DataFrame:
    """Tolerant scan: the schema's fields of the usable lines.

    Another schema may add fields, such as a key, to `category` and `reviewText`.
    """
    parsed = parse_lines(read_lines(spark, path), schema)
    return usable(parsed.filter("parsed").select(*schema.names))


def read_reviews_json(spark: SparkSession, path: str, schema: T.StructType = REVIEW_SCHEMA) -> DataFrame:
    """JSON scan with a fixed schema, so no pass over the data infers one."""
    return usable(spark.read.schema(schema).json(path))


def as_reviews(df: DataFrame, category: str, text: str, *keep: str) -> DataFrame:
    """Rename a table's label and text columns; drop rows that miss either."""
    return usable(df.select(*keep, F.col(category).alias("category"), F.col(text).alias("reviewText")))
