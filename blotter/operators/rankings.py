"""Sums and per-city extremes over the rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def row_count(df: DataFrame) -> int:
    """Number of rows."""
    return df.count()


def row_count_frame(df: DataFrame) -> DataFrame:
    """`row_count` as a one-row DataFrame, for use inside a plan."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def crimes_by_hour(hourly: DataFrame) -> DataFrame:
    """(hour, crime_count) over all cities and days, by hour."""
    return hourly.groupBy("hour").agg(F.sum("crime_count").alias("crime_count")).orderBy("hour")


def crimes_by_day(hourly: DataFrame) -> DataFrame:
    """(day_of_week, crime_count) over all cities and hours, by the day's name."""
    days = hourly.groupBy("day_of_week").agg(F.sum("crime_count").alias("crime_count"))
    return days.orderBy("day_of_week")


def sum_crimes(monthly: DataFrame) -> DataFrame:
    """(city, sum(crime_count))."""
    return monthly.groupBy("city").sum("crime_count")


def sum_violent_crimes(violent: DataFrame) -> DataFrame:
    """(city, crime_group, sum(crime_count))."""
    return violent.groupBy("city", "crime_group").sum("crime_count")


def _first_per_city(df: DataFrame, numbering: Column, *order: Column) -> DataFrame:
    """Rows numbered 1 within their city.

    With the filter right above the window, each input partition passes on only
    its own first rows, so a large city does not arrive whole in one task.
    """
    place = numbering.over(Window.partitionBy("city").orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def _month_columns(keep_year: bool) -> list[str]:
    return ["city", "year", "month"] if keep_year else ["city", "month"]


def max_crimes(monthly: DataFrame, keep_year: bool = False) -> DataFrame:
    """Each city's highest month; ties all stay. The year is shown on request."""
    top = _first_per_city(monthly, F.rank(), F.desc("crime_count"))
    return top.select(*_month_columns(keep_year), "crime_count")


def min_crimes(monthly: DataFrame, keep_year: bool = False) -> DataFrame:
    """Each city's lowest month among those with incidents; ties all stay."""
    low = _first_per_city(monthly, F.rank(), F.asc("crime_count"))
    return low.select(*_month_columns(keep_year), "crime_count")


def max_crimes_violent(violent: DataFrame, keep_year: bool = False) -> DataFrame:
    """Each city's one highest (month, group); ties all stay."""
    top = _first_per_city(violent, F.rank(), F.desc("crime_count"))
    return top.select(*_month_columns(keep_year), "crime_count", "crime_group")


def _one_offense(offenses: DataFrame, by_count: Column) -> DataFrame:
    # The name breaks ties, so that a rerun picks the same offense.
    one = _first_per_city(
        offenses, F.row_number(), by_count, F.asc_nulls_last("offense_type")
    )
    return one.select("city", "offense_type", "crime_count").orderBy("city")


def most_offense_committed(offenses: DataFrame) -> DataFrame:
    """Each city's most frequent offense, one row per city."""
    return _one_offense(offenses, F.desc("crime_count"))


def least_offense_committed(offenses: DataFrame) -> DataFrame:
    """Each city's least frequent offense, one row per city."""
    return _one_offense(offenses, F.asc("crime_count"))
