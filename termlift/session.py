"""Session defaults for the jobs in this package."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(
    app_name: str = "termlift", master: str | None = None, initial_partitions: int | None = None, **conf: str
) -> SparkSession:
    """Build or reuse a session.

    `master` stays unset on a cluster, where spark-submit supplies it. Extra
    settings use `__` for the dots: `session(spark__driver__memory="8g")`. Shuffles
    start with `initial_partitions`, some 100 MB each of the largest, and adaptive
    execution merges them where there is less.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    extra = {key.replace("__", "."): value for key, value in conf.items()}
    if initial_partitions is not None:
        extra.setdefault("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
