"""Products that follow their landed files, delivery by delivery.

`build_products` reads everything each time. Here a run reads the files only that the
ledger does not know, adds their rows, and counts again only the months that these rows
belong to. Tables in the database:

- `landed`: incidents with their file, by city, month and delivery. A delivery writes
  partitions of its own and touches no other.
- `ledger`: the files taken in. A row of `landed` counts if the ledger names its file with
  its delivery, so the one step that turns the ledger is the one that makes a delivery seen.
- `pending`: months whose counts are still to be made again.
- `times`, `violence`, `offenses`: counts by month, of which whole months are replaced.

A run may end anywhere. Before the ledger is turned, nothing of it is seen, and the next
run takes the same files again; after that, the months it left are still pending, and the
next run counts them. One run at a time writes to a database.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blotter.functions.sqltext import unused
from blotter.functions.timeparse import month_start
from blotter.model import INCIDENT_COLUMNS, Source
from blotter.operators import rollups
from blotter.operators.conform import conform, distinct_cities
from blotter.sources.ledger import LEDGER, globless, landed_files, not_taken
from blotter.sources.readers import read_csv
from blotter.sources.shared import stored
from blotter.sources.tables import create_database, save_table

#: A year and month in one number; 0 for what has no readable time.
MONTH = ("city", "month_id")
_PENDING = "city string, month_id int"
_LANDED = (
    "ts timestamp_ntz, ts_strict timestamp_ntz, offense_type string, offense_group string,"
    " longitude double, latitude double, file string, city string, month_id int, delivery bigint"
)
# The counts' own keys; city and month come on top.
_COUNTS = {
    "times": "month_start date, weekday int, hour int",
    "violence": "month_start_strict date, is_violent boolean",
    "offenses": "offense_type string",
}

Reader = Callable[[SparkSession, list[str]], DataFrame]


def _table(database: str, name: str) -> str:
    return f"`{database}`.`{name}`"


def _month_id(month: Column) -> Column:
    return F.coalesce(F.year(month) * 100 + F.month(month), F.lit(0))


def _prepare(spark: SparkSession, database: str) -> None:
    """Creates what is not there yet."""
    create_database(spark, database)
    for name, schema in (("ledger", LEDGER), ("pending", _PENDING)):
        if not spark.catalog.tableExists(_table(database, name)):
            save_table(spark.createDataFrame([], schema), _table(database, name))
    partitioned = {"landed": (_LANDED, (*MONTH, "delivery"))}
    for name, keys in _COUNTS.items():
        partitioned[name] = (f"{keys}, crime_count bigint, city string, month_id int", MONTH)
    for name, (schema, keys) in partitioned.items():
        if not spark.catalog.tableExists(_table(database, name)):
            # Whoever overwrites replaces the partitions that it has rows for.
            writer = spark.createDataFrame([], schema).write.format("parquet")
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
            writer.saveAsTable(_table(database, name))


def _put(df: DataFrame, table: str, overwrite: bool) -> None:
    """Rows into a partitioned table, few files a month; a hot month is split over several tasks."""
    columns = df.sparkSession.table(table).columns
    df.hint("rebalance", *MONTH).select(*columns).write.insertInto(table, overwrite=overwrite)


def _arrived(spark: SparkSession, source: Source, paths: list[str], read: Reader) -> DataFrame:
    """A source's new rows as incidents with the file each is from."""
    raw = read(spark, [globless(path) for path in paths])
    (file,) = unused(raw.columns, "_file")
    named = raw.select("*", raw.metadataColumn("_metadata")["file_path"].alias(file))
    found = conform(named, source, keep=(file,))
    return found.withColumn("month_id", _month_id(month_start("ts"))).withColumnRenamed(file, "file")


def deliver(
    spark: SparkSession,
    database: str,
    landings: Sequence[tuple[Source, str]],
    read: Reader = read_csv,
) -> dict[str, int]:
    """Takes in what has landed since the last run; returns the rows taken in per city.

    `landings` are the sources and the folder of each; `read` makes rows of file paths
    with one of Spark's file readers (it must leave `_metadata` at hand). A file that
    has changed replaces the rows that it gave before; one that is gone leaves them.
    The names of new files come to the driver, where Spark's readers need them.
    """
    sources = [source for source, _ in landings]
    taken = dict.fromkeys(distinct_cities(sources), 0)
    _prepare(spark, database)
    table = partial(_table, database)
    ledger = spark.table(table("ledger"))
    delivery = time.time_ns()
    files, rows = [], []
    for source, folder in landings:
        new = stored(not_taken(landed_files(spark, folder), ledger, source.city))
        paths = [row["path"] for row in new.select("path").toLocalIterator()]
        if paths:
            files.append(new.select(F.lit(source.city).alias("city"), "file", "bytes", "modified"))
            rows.append(_arrived(spark, source, paths, read))
    if files:
        new = reduce(DataFrame.unionByName, files).withColumn("delivery", F.lit(delivery))
        found = reduce(DataFrame.unionByName, rows).withColumn("delivery", F.lit(delivery))
        _put(found, table("landed"), overwrite=False)
        landed = spark.table(table("landed"))
        # Partition columns only: no value is read from the files.
        arrived = landed.filter(F.col("delivery") == delivery).select(*MONTH)
        taken |= {row["city"]: row["count"] for row in arrived.groupBy("city").count().collect()}
        months = spark.table(table("pending")).union(arrived)
        replaced = ledger.join(new, ["city", "file"], "left_semi")
        if not replaced.isEmpty():
            of_them = landed.join(replaced, ["city", "file", "delivery"], "left_semi")
            months = months.union(of_them.select(*MONTH))
        save_table(months.distinct(), table("pending"))
        kept = ledger.join(new, ["city", "file"], "left_anti")
        save_table(kept.unionByName(new), table("ledger"))
    _count_pending(spark, database, sources)
    return taken


def delivered(spark: SparkSession, database: str) -> DataFrame:
    """The incidents of all deliveries, with city and month as partitions to prune by."""
    ledger = spark.table(_table(database, "ledger")).select("city", "file", "delivery")
    landed = spark.table(_table(database, "landed"))
    return landed.join(ledger, ["city", "file", "delivery"], "left_semi").select(
        *INCIDENT_COLUMNS, "month_id"
    )


def _count_pending(spark: SparkSession, database: str, sources: Sequence[Source]) -> None:
    """Counts the pending months from their incidents, and replaces them.

    A month that has lost all its rows keeps a row that counts 0, which stands for nothing
    when counts are read: without it, its old partition would stay.
    """
    # Every month passes the filter; a filtered side lets Spark prune the other's partitions.
    pending = spark.table(_table(database, "pending")).filter("month_id >= 0")
    if pending.isEmpty():
        return
    facts = delivered(spark, database).join(pending, [*MONTH], "left_semi")
    keyed = rollups.keyed(facts).withColumn("month_id", _month_id(F.col("month_start")))
    keyed = rollups.ruled(keyed, sources)
    nothing = pending.withColumn("crime_count", F.lit(0).cast("long"))
    for name, schema in _COUNTS.items():
        keys = [field.split()[0] for field in schema.split(", ")]
        counts = keyed.groupBy(*MONTH, *keys).agg(F.sum("crime_count").alias("crime_count"))
        counts = counts.unionByName(nothing, allowMissingColumns=True)
        _put(counts, _table(database, name), overwrite=True)
    save_table(pending.limit(0), _table(database, "pending"))


def month_counts(spark: SparkSession, database: str, name: str) -> DataFrame:
    """The counts `times`, `violence` or `offenses`, as the rollups take them."""
    return spark.table(_table(database, name)).filter("crime_count > 0")


def delivered_products(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The count products of `build_products` by their names there, from the months' counts.

    Comparisons and rankings take these as they take the stored ones.
    """
    times, violence, offenses = (month_counts(spark, database, name) for name in _COUNTS)
    by_offense = rollups.offense_counts(offenses)
    return {
        "crime_monthly": rollups.monthly(times),
        "crime_hourly": rollups.hourly(times),
        "crime_monthly_strict": rollups.monthly(violence, strict=True),
        "crime_vp_monthly": rollups.violent_monthly(violence),
        "crime_by_offense": by_offense,
        "crime_by_offense_norm": rollups.offense_share(by_offense),
    }
