"""Session settings the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Results hold zone-less times; this only concerns what else the session prints.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partitioned write keeps a file open per partition value, up to this many,
    # instead of sorting every task's rows first. A task of the incident table
    # has one city only, so the sort would buy nothing.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a running session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
