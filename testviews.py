"""Two raw incident sources derived from the supplied test tables.

Each has the columns and the irregularities of a landed file: several time
layouts in one text column, unreadable and missing times, mixed-case, empty and
missing offenses, missing coordinates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from blotter.model import CHICAGO, COMMA_FORMAT, DC, SPACE_FORMAT, Source

# The columns used. Stating them saves the job that reads a schema from the files.
_LINEITEM = (
    "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_shipdate TIMESTAMP_NTZ"
)
_ORDERS = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ"

PRIMARY_TYPE = """
CASE l_partkey % 12 WHEN 0 THEN 'THEFT' WHEN 1 THEN 'Theft' WHEN 2 THEN 'MOTOR VEHICLE THEFT'
  WHEN 3 THEN 'BATTERY' WHEN 4 THEN 'ASSAULT' WHEN 5 THEN 'CRIMINAL DAMAGE' WHEN 6 THEN 'ROBBERY'
  WHEN 7 THEN 'BURGLARY' WHEN 8 THEN 'HOMICIDE' WHEN 9 THEN 'NARCOTICS' WHEN 10 THEN '' ELSE NULL END"""
CHICAGO_LATITUDE = "CASE WHEN l_linenumber = 7 THEN NULL ELSE 41.65e0 + (l_orderkey % 100) / 250e0 END"
CHICAGO_LONGITUDE = "CASE WHEN l_linenumber = 6 THEN NULL ELSE -87.9e0 + (l_suppkey % 100) / 250e0 END"

OFFENSE = """
CASE o_custkey % 8 WHEN 0 THEN 'THEFT/OTHER' WHEN 1 THEN 'THEFT F/AUTO' WHEN 2 THEN 'MOTOR VEHICLE THEFT'
  WHEN 3 THEN 'ASSAULT W/DANGEROUS WEAPON' WHEN 4 THEN 'SEX ABUSE' WHEN 5 THEN 'BURGLARY'
  WHEN 6 THEN 'ROBBERY' ELSE NULL END"""
OFFENSEGROUP = """
CASE o_orderstatus WHEN 'F' THEN 'violent' WHEN 'O' THEN 'Property crime' ELSE NULL END"""
DC_LATITUDE = "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE 38.8e0 + (o_custkey % 100) / 500e0 END"
DC_LONGITUDE = "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE -77.1e0 + (o_orderkey % 100) / 500e0 END"


def report_dat(comma: str, space: str, iso: str) -> str:
    """REPORT_DAT from the three spellings of a record's time."""
    return f"""
CASE o_orderkey % 8 WHEN 4 THEN {space} WHEN 5 THEN {iso} WHEN 6 THEN 'not a date'
  WHEN 7 THEN NULL ELSE {comma} END"""


POPULATIONS = """
SELECT CASE c_nationkey % 2 WHEN 0 THEN 'Chicago' ELSE 'DC' END AS city,
       make_date(CAST(1996 + c_custkey % 5 AS INT), CAST(1 + c_nationkey % 7 AS INT), 1) AS valid_from,
       CAST(500000 + 1000 * count(*) AS BIGINT) AS population
FROM {customer} WHERE c_custkey IS NOT NULL AND c_nationkey IS NOT NULL GROUP BY 1, 2"""


def chicago_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source with a typed time, from `lineitem`."""
    lineitem = spark.read.schema(_LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")
    return lineitem.selectExpr(
        "l_shipdate + ((l_orderkey + l_linenumber) % 24) * INTERVAL '1' HOUR AS date",
        f"{PRIMARY_TYPE} AS primary_type",
        f"{CHICAGO_LATITUDE} AS latitude",
        f"{CHICAGO_LONGITUDE} AS longitude",
    )


def dc_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source with times as text in three layouts, from `orders`."""
    time = (
        "o_orderdate + ((o_orderkey % 24) * INTERVAL '1' HOUR"
        " + (o_custkey % 60) * INTERVAL '1' MINUTE)"
    )
    text = report_dat(
        comma=f"date_format({time}, '{COMMA_FORMAT}')",
        space=f"date_format({time}, '{SPACE_FORMAT}')",
        iso=f"date_format({time}, 'yyyy-MM-dd HH:mm:ss')",
    )
    orders = spark.read.schema(_ORDERS).parquet(f"{sf_dir}/orders.parquet")
    return orders.selectExpr(
        f"{text} AS REPORT_DAT",
        f"{OFFENSE} AS OFFENSE",
        f"{OFFENSEGROUP} AS OFFENSEGROUP",
        f"{DC_LATITUDE} AS LATITUDE",
        f"{DC_LONGITUDE} AS LONGITUDE",
    )


def populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Populations by city and date, from `customer`: the first of them begin in 1996."""
    customer = spark.read.schema("c_custkey BIGINT, c_nationkey INT").parquet(f"{sf_dir}/customer.parquet")
    return spark.sql(POPULATIONS, customer=customer)


_RAW = {CHICAGO: chicago_raw, DC: dc_raw}


def raw_sources(
    spark: SparkSession, sf_dir: str, sources: Sequence[Source] = (CHICAGO, DC)
) -> list[tuple[Source, DataFrame]]:
    return [(source, _RAW[source](spark, sf_dir)) for source in sources]
