"""Small frame helpers the operators share."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.sources.shared import shared_folder, stored

__all__ = [
    "give_back",
    "running_total",
    "shared_folder",
    "small_batches",
    "stored",
    "table",
    "text_of",
    "unused",
]

#: Rows and bytes of an Arrow batch at most, where Spark hands whole texts to Python.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches are no larger than BATCH.

    A batch stands in the JVM, in buffers of the next power of two that grow by copying,
    and once more in the Python worker. Limits that the session names stay.
    """
    named = spark.conf.getAll
    for key, most in BATCH.items():
        if key not in named:
            spark.conf.set(key, most)


def give_back() -> None:
    """Gives the system the memory that Arrow's pool and the C library's allocator hold unused.

    Spark uses Python workers again, so what one stage leaves would stand beside the next.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_of(column: str = "text") -> Column:
    """The column as text, empty where it is null."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    amount: Column,
    name: str,
    buckets: int = 4096,
) -> DataFrame:
    """Adds column `name`: the sum of `amount` over the rows of the same keys that come before.

    Rows are ordered by (hash bucket, `order`) within their keys, so that no task
    needs all the rows of a hot key: a bucket's rows are summed in one task, and
    the sums of at most `buckets` buckets per key in another. `order` must name
    columns whose ties are interchangeable rows.
    """
    salted = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    salted = salted.withColumn("_amount", amount)
    per_bucket = salted.groupBy(*keys, "_bucket").agg(F.sum("_amount").alias("_sum"))
    by_keys = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = F.sum("_sum").over(by_keys.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_bucket.select(*keys, "_bucket", F.coalesce(before, F.lit(0)).alias("_offset"))
    inside = F.sum("_amount").over(
        Window.partitionBy(*keys, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        salted.withColumn("_inside", F.coalesce(inside, F.lit(0)))
        .join(offsets, [*keys, "_bucket"])
        .withColumn(name, (F.col("_offset") + F.col("_inside")).cast("long"))
        .drop("_bucket", "_amount", "_inside", "_offset")
    )


def unused(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
