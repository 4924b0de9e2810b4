"""Plot-ready datasets, prepared on the cluster; the caller collects and draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from blotter.functions.classify import OTHER, CategoryRule, category, offense_in
from blotter.functions.timeparse import WEEKDAYS, weekday_name

# Latitude that parts north from south, and the offenses mapped.
NORTH_BOUNDARY = 41.85
THEFT = ("THEFT",)
BATTERY_ASSAULT = ("BATTERY", "ASSAULT")


def load_coordinates(coordinates: DataFrame, city: str, year: int, month: int) -> DataFrame:
    """The located incidents of one city and month.

    Over the stored table, which is partitioned by these three columns, the
    filter reads one directory.
    """
    return coordinates.filter(
        (F.col("city") == city) & (F.col("year") == year) & (F.col("month") == month)
    )


def _frequent_offenses(offenses: DataFrame, k: int) -> DataFrame:
    """The k most frequent offenses; the name breaks ties.

    Null is sorted behind all names, and if it gets in, joins with nothing.
    Filtering it out instead would be pushed below the counting, which could
    then not be shared with other users of the same counts.
    """
    unnamed = F.col("offense_type").isNull()
    top = offenses.orderBy(unnamed, F.desc("crime_count"), "offense_type").limit(k)
    return top.select("offense_type", F.col("offense_type").alias("offense_group"))


def _grouped(df: DataFrame, offenses: DataFrame, k: int) -> DataFrame:
    """`df` with `offense_group`: the offense if among the k most frequent, else Other."""
    top = F.broadcast(_frequent_offenses(offenses, k))  # k rows at most
    return df.join(top, "offense_type", "left").withColumn(
        "offense_group", F.coalesce("offense_group", F.lit(OTHER))
    )


def _offense_sizes(points: DataFrame) -> DataFrame:
    return points.groupBy("offense_type").agg(F.count(F.lit(1)).alias("crime_count"))


def cluster_points(points: DataFrame, k: int = 5) -> DataFrame:
    """Every point with its offense group."""
    return _grouped(points, _offense_sizes(points), k).select(
        "longitude", "latitude", "offense_type", "offense_group"
    )


def offense_groups(points: DataFrame, k: int = 5) -> DataFrame:
    """The groups of `cluster_points` with their sizes, by name (the map's legend).

    Counts once and labels the counted offenses rather than the points.
    """
    sizes = _offense_sizes(points)
    return (
        _grouped(sizes, sizes, k)
        .groupBy("offense_group")
        .agg(F.sum("crime_count").alias("crime_count"))
        .orderBy("offense_group")
    )


def zone_points(
    points: DataFrame, offenses: Sequence[str], boundary: float = NORTH_BOUNDARY
) -> DataFrame:
    """Points of the named offenses, in any case, with their side of the boundary."""
    zone = F.when(F.col("latitude") >= boundary, F.lit("North")).otherwise(F.lit("South"))
    return points.filter(offense_in(offenses)()).select(
        "longitude", "latitude", "offense_type", zone.alias("zone")
    )


def zone_summary(
    points: DataFrame, offenses: Sequence[str], boundary: float = NORTH_BOUNDARY
) -> DataFrame:
    """(zone, incidents, min_longitude) for both sides, also when one is empty.

    `min_longitude` is that of all points, where both zone labels are placed.
    One global aggregate; its single row is then turned into two.
    """
    north = F.col("zone") == "North"
    totals = zone_points(points, offenses, boundary).agg(
        F.count_if(north).alias("north"),
        F.count_if(~north).alias("south"),
        F.min("longitude").alias("min_longitude"),
    )
    return totals.select(
        F.inline(
            F.array(
                F.struct(F.lit("North").alias("zone"), F.col("north").alias("incidents")),
                F.struct(F.lit("South").alias("zone"), F.col("south").alias("incidents")),
            )
        ),
        "min_longitude",
    )


def heatmap(hourly: DataFrame, city: str) -> DataFrame:
    """One city's counts as a Mon..Sun by 0..23 matrix, null where none happened.

    All 7 x 24 cells are there whatever the data holds: seven rows without a
    count are added before the hours are turned into columns.
    """
    days = hourly.sparkSession.range(0, len(WEEKDAYS), 1, 1).selectExpr("CAST(id AS INT) AS weekday")
    days = days.withColumn("day_of_week", weekday_name("weekday"))
    cells = hourly.filter(F.col("city") == city).select("day_of_week", "hour", "crime_count")
    hours = [
        F.expr(f"max(crime_count) FILTER (WHERE hour = {hour})").alias(str(hour))
        for hour in range(24)
    ]
    return (
        days.unionByName(cells, allowMissingColumns=True)
        .groupBy("day_of_week")
        .agg(F.max("weekday").alias("weekday"), *hours)
        .filter(F.col("weekday").isNotNull())
        .orderBy("weekday")
    )


def population_line(adjusted: DataFrame, year: int) -> DataFrame:
    """One year of `population_adjusted` by month, with a YYYY-MM label.

    Over raw sources, cut the incidents to the year first (`timeparse.in_year`).
    """
    label = F.format_string("%d-%02d", "year", "month")
    return (
        adjusted.filter(F.col("year") == year)
        .withColumn("month_label", label)
        .orderBy("month")
    )


def categorised(offenses: DataFrame, rules: Sequence[CategoryRule]) -> DataFrame:
    """One city's offense counts with the unified category of each offense."""
    return offenses.withColumn("category", category(F.col("offense_type"), rules))


def _category_totals(
    offenses: DataFrame, rules: Sequence[CategoryRule], name: str
) -> DataFrame:
    return (
        categorised(offenses, rules).groupBy("category").agg(F.sum("crime_count").alias(name))
    )


def category_distribution(
    left_offenses: DataFrame,
    left,
    right_offenses: DataFrame,
    right,
    how: str = "left",
) -> DataFrame:
    """Category counts of two sources on the left one's categories, largest first.

    The right city's missing categories are 0, its additional ones dropped;
    `how="full"` keeps them. Both sides are at most the rules' categories and
    Other, so Spark has a small join to plan by its own measure.
    """
    a, b = f"{left.label}_crime_count", f"{right.label}_crime_count"
    joined = _category_totals(left_offenses, left.categories, a).join(
        _category_totals(right_offenses, right.categories, b), "category", how
    )
    return joined.na.fill(0, [a, b]).orderBy(F.desc(a), "category")
