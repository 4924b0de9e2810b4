"""Catalog tables: create, replace, preview, describe."""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from blotter.functions.sqltext import quoted


def create_database(spark: SparkSession, name: str) -> None:
    """Create the database if it is not there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def _parts(name: str) -> tuple[str | None, str]:
    """Database and table of a name, without quotes."""
    parts = [p.replace("``", "`") for p in re.findall(r"`((?:[^`]|``)+)`|([^.`]+)", name) for p in p if p]
    return (parts[0] if len(parts) > 1 else None), parts[-1]


def _versions(spark: SparkSession, database: str | None, table: str) -> list[str]:
    """The stored versions of a table, from old to new."""
    within = f" IN {quoted(database)}" if database else ""
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES{within}").collect()]
    mark = f"{table.lower()}__v"
    return sorted(n for n in names if n.startswith(mark) and n[len(mark) :].isdigit())


def _full(database: str | None, table: str) -> str:
    return f"{quoted(database)}.{quoted(table)}" if database else quoted(table)


def _is_table(spark: SparkSession, full: str) -> bool:
    """Whether the name is that of a table, and not of a view or of nothing."""
    return spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "VIEW"


def save_view(spark: SparkSession, name: str, query: str) -> None:
    """Give `name` to a query over tables. A table of that name goes."""
    full = _full(*_parts(name))
    if _is_table(spark, full):
        spark.sql(f"DROP TABLE {full}")
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS {query}")


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Write `df` as a Parquet table, replacing an earlier one.

    The rows are written as a version of their own, `<name>__v<number>`, and `name` is a
    view that one catalog step turns to it: a reader sees all of the old rows or all of
    the new, at every time, and the old ones stay if the write fails. The version
    before is kept for readers that have begun, until the next replacement; older
    ones, and what a failed write left, go. A plain table of that name, as an earlier release
    wrote it, first becomes a version itself, which takes two steps, once.
    Rows are not sorted: order in a table binds no later reader.
    """
    spark = df.sparkSession
    database, table = _parts(name)
    full = partial(_full, database)
    version = f"{table.lower()}__v{time.time_ns():020d}"
    writer = df.write.format("parquet").mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(full(version))
    if _is_table(spark, full(table)):
        spark.sql(f"ALTER TABLE {full(table)} RENAME TO {full(f'{table.lower()}__v{0:020d}')}")
    spark.sql(f"CREATE OR REPLACE VIEW {full(table)} AS SELECT * FROM {full(version)}")
    for old in _versions(spark, database, table)[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {full(old)}")


def save_counted(
    incidents: DataFrame,
    name: str,
    cities: Sequence[str],
    partition_by: Sequence[str] = ("city",),
) -> dict[str, int]:
    """`save_table`, and the number of rows written per city.

    The counts are taken while writing and cost no further pass.
    """
    seen = Observation("ingested_rows")
    counts = [F.count_if(F.col("city") == city).alias(city) for city in cities]
    save_table(incidents.observe(seen, *counts), name, partition_by)
    return {city: seen.get[city] for city in cities}


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Any n rows."""
    return df.limit(n)
