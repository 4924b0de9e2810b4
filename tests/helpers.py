"""Small builders shared by the tests."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

INCIDENTS = (
    "city string, ts timestamp_ntz, ts_strict timestamp_ntz, offense_type string,"
    " offense_group string, longitude double, latitude double"
)


def rows(df: DataFrame) -> Counter:
    return Counter(tuple(row) for row in df.collect())


def ordered(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def incidents_of(spark: SparkSession, *records: dict) -> DataFrame:
    """Incidents from partial records; `ts_strict` follows `ts` unless given."""
    fields = [field.split()[0] for field in INCIDENTS.split(", ")]
    full = [{"ts_strict": r.get("ts")} | r for r in records]
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in full], INCIDENTS)


def plan(df: DataFrame) -> str:
    """The physical plan before execution, ids left out."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)
