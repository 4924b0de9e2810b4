"""Additive rollups of the incident table, and products computed from them.

A rollup takes any frame with the key columns it groups by and an additive
`crime_count`: `keyed` incidents, where each row counts 1, or one of the small
cubes, where those have been summed once for several rollups.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from blotter.functions.classify import violent_label
from blotter.functions.timeparse import month_start, weekday_name
from blotter.model import Source

def keyed(incidents: DataFrame) -> DataFrame:
    """Incidents with the rollups' keys and a count of 1; unused keys are pruned."""
    return incidents.select(
        "city",
        month_start("ts").alias("month_start"),
        month_start("ts_strict").alias("month_start_strict"),
        F.weekday("ts").alias("weekday"),
        F.hour("ts").alias("hour"),
        "offense_type",
        "offense_group",
        F.lit(1).cast("long").alias("crime_count"),
    )


def time_cube(incidents: DataFrame) -> DataFrame:
    """Counts by city, month, weekday and hour: at most 168 a month and city."""
    return _total(keyed(incidents), "city", "month_start", "weekday", "hour")


def strict_cube(incidents: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """Counts by city, strictly read month and violence: at most 2 a month and city.

    The rule is applied to incidents, so no offense name becomes a key.
    """
    return _total(ruled(keyed(incidents), sources), "city", "month_start_strict", "is_violent")


def ruled(counts: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """Keyed incidents with `is_violent`, by the rule of each one's source."""
    return counts.withColumn("is_violent", _is_violent(sources))


def _total(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("crime_count").alias("crime_count"))


def _dated_total(counts: DataFrame, time_key: str, *keys: str) -> DataFrame:
    """`_total` over the incidents whose `time_key` is known.

    The key is handed on as an aggregate. A filter on a grouping column, here
    or in a later step, would be pushed down to the raw rows and parse each
    time twice: once to test it and once to use it.
    """
    totals = counts.groupBy("city", F.col(time_key).alias("_group"), *keys).agg(
        F.max(time_key).alias(time_key), F.sum("crime_count").alias("crime_count")
    )
    return totals.filter(F.col(time_key).isNotNull())


def monthly(counts: DataFrame, strict: bool = False) -> DataFrame:
    """(city, year, month, crime_count) over incidents with a readable time.

    `strict` reads times in each source's declared layout only. Grouping by the
    month's first day and splitting it afterwards does the calendar work once
    per incident instead of twice, and the split once per group.
    """
    key = "month_start_strict" if strict else "month_start"
    return _dated_total(counts, key).select(
        "city", F.year(key).alias("year"), F.month(key).alias("month"), "crime_count"
    )


def hourly(counts: DataFrame) -> DataFrame:
    """(city, day_of_week, hour, crime_count), all years pooled.

    Groups by the weekday's number; names are put on the groups, not the rows.
    """
    return _dated_total(counts, "hour", "weekday").select(
        "city", weekday_name("weekday").alias("day_of_week"), "hour", "crime_count"
    )


def offense_counts(counts: DataFrame) -> DataFrame:
    """(city, offense_type, crime_count); spelling kept, null is a group, dates unused."""
    return _total(counts, "city", "offense_type")


def city_offense_counts(offenses: DataFrame, city: str) -> DataFrame:
    """`offense_counts` of one city, without the city column."""
    return offenses.filter(F.col("city") == city).select("offense_type", "crime_count")


def offense_share(offenses: DataFrame) -> DataFrame:
    """`offense_counts` with the city's total and each offense's share of it.

    The totals are joined, one row per city. A window by city would put all
    offenses of a city into one task, and free text has no bound on them.
    """
    totals = offenses.groupBy("city").agg(F.sum("crime_count").alias("total_crime"))
    return offenses.join(totals, "city").select(
        "city",
        "offense_type",
        "crime_count",
        "total_crime",
        (F.col("crime_count").cast("double") / F.col("total_crime")).alias("offense_share"),
    )


def _is_violent(sources: Sequence[Source]) -> Column:
    """By the rule of the incident's source; what the rule says nothing of, null included, is not."""
    found = F.lit(False)
    for source in sources:
        found = F.when(F.col("city") == source.city, source.violent()).otherwise(found)
    return F.coalesce(found, F.lit(False))


def violent_monthly(counts: DataFrame, sources: Sequence[Source] = ()) -> DataFrame:
    """(city, year, month, crime_group, crime_count), by each source's own rule.

    Uses strictly read times. Takes keyed incidents and the sources, or the
    `strict_cube`, where the rule has been applied.
    """
    if "is_violent" not in counts.columns:
        counts = ruled(counts, sources)
    return _dated_total(counts, "month_start_strict", "is_violent").select(
        "city",
        F.year("month_start_strict").alias("year"),
        F.month("month_start_strict").alias("month"),
        violent_label(F.col("is_violent")).alias("crime_group"),
        "crime_count",
    )


def _guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is 0."""
    return F.when(denominator > 0, numerator / denominator)


def monthly_compare(months: DataFrame, left: Source, right: Source) -> DataFrame:
    """Two cities' monthly counts side by side, with difference and ratio.

    A month known to one city only shows 0 for the other. Conditional
    aggregates give the pivot in one shuffle.
    """

    def count_of(source: Source) -> Column:
        own = F.max(F.when(F.col("city") == source.city, F.col("crime_count")))
        return F.coalesce(own, F.lit(0)).alias(f"{source.label}_crime_count")

    a = F.col(f"{left.label}_crime_count")
    b = F.col(f"{right.label}_crime_count")
    return (
        months.groupBy("year", "month")
        .agg(count_of(left), count_of(right))
        .withColumn(f"diff_{left.short}_minus_{right.short}", a - b)
        .withColumn(
            f"{left.short}_to_{right.short}_ratio",
            _guarded_ratio(a.cast("double"), b.cast("double")),
        )
    )


def population_adjusted(compared: DataFrame, left: Source, right: Source) -> DataFrame:
    """`monthly_compare` per 100,000 residents, by month (not annualised)."""
    a = F.col(f"{left.label}_crime_count")
    b = F.col(f"{right.label}_crime_count")

    def per_100k(count: Column, source: Source) -> Column:
        return count.cast("double") * F.lit(100000.0) / F.lit(float(source.population))

    def per_head(count: Column, source: Source) -> Column:
        return count.cast("double") / F.lit(float(source.population))

    return compared.select(
        "year",
        "month",
        a,
        b,
        per_100k(a, left).alias(f"{left.short}_per_100k"),
        per_100k(b, right).alias(f"{right.short}_per_100k"),
        (a - b).alias("diff_raw"),
        (per_100k(a, left) - per_100k(b, right)).alias("diff_per_100k"),
        _guarded_ratio(per_head(a, left), per_head(b, right)).alias(
            f"{left.short}_to_{right.short}_rate_ratio"
        ),
    )


def compare_all(months: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """Every two cities' monthly counts side by side, a row per pair and month.

    Columns: left_city, right_city, year, month, left_crime_count, right_crime_count,
    diff, ratio; pairs in the sources' order. Like `monthly_compare`, a month known to
    one city of a pair shows 0 for the other, and one known to neither is left out. All
    counts of a month are gathered in one shuffle, as an array in the order of the
    sources, and its pairs unfolded from that.
    """
    if len(sources) < 2:
        raise ValueError("a comparison needs two cities")
    counts = [F.max(F.when(F.col("city") == s.city, F.col("crime_count"))) for s in sources]
    by_month = months.groupBy("year", "month").agg(F.array(*counts).alias("counts"))
    pairs = [
        F.struct(
            F.lit(a.city).alias("left_city"),
            F.lit(b.city).alias("right_city"),
            F.col("counts")[i].alias("left"),
            F.col("counts")[j].alias("right"),
        )
        for (i, a), (j, b) in combinations(enumerate(sources), 2)
    ]
    unfolded = by_month.select("year", "month", F.inline(F.array(*pairs)))
    unfolded = unfolded.filter(F.col("left").isNotNull() | F.col("right").isNotNull())
    left, right = (F.coalesce(name, F.lit(0)) for name in ("left", "right"))
    return unfolded.select(
        "left_city",
        "right_city",
        "year",
        "month",
        left.alias("left_crime_count"),
        right.alias("right_crime_count"),
        (left - right).alias("diff"),
        _guarded_ratio(left.cast("double"), right.cast("double")).alias("ratio"),
    )


def with_population(months: DataFrame, populations: DataFrame) -> DataFrame:
    """Rows of (city, year, month) with the population that held on the month's first day.

    `populations` has city, valid_from (a date) and population. Each of its rows holds until
    the city's next one; of rows of one date the largest population holds. A
    month before a city's first row has no population, nor has one of a city
    that is not there. The join is by city, with bounds on the date; a rollup's
    months are few, whatever the number of incidents.
    """
    dated = populations.filter("valid_from IS NOT NULL").groupBy("city", "valid_from").agg(
        F.max("population").alias("population")
    )
    upto = F.lead("valid_from").over(Window.partitionBy("city").orderBy("valid_from"))
    spans = dated.withColumn("valid_upto", upto).withColumnRenamed("city", "of_city")
    first = F.make_date("year", "month", F.lit(1))
    held = (
        (F.col("city") == F.col("of_city"))
        & (first >= F.col("valid_from"))
        & (F.col("valid_upto").isNull() | (first < F.col("valid_upto")))
    )
    return months.join(spans, held, "left").select(*[months[c] for c in months.columns], "population")


def population_adjusted_by_date(
    compared: DataFrame, left: Source, right: Source, populations: DataFrame
) -> DataFrame:
    """`population_adjusted` with the populations that held in each month.

    The columns are the same. Where a city has no population yet, what rests on it is null.
    """
    names = {s.city: f"{s.label}_crime_count" for s in (left, right)}
    cities = [F.struct(F.lit(city).alias("city"), F.col(name).alias("n")) for city, name in names.items()]
    months = compared.select("year", "month", F.inline(F.array(*cities)))
    held = with_population(months, populations)

    def of(source: Source, name: str) -> Column:
        return F.max(F.when(F.col("city") == source.city, F.col(name)))

    both = held.groupBy("year", "month").agg(
        of(left, "n").alias("a"),
        of(right, "n").alias("b"),
        of(left, "population").cast("double").alias("a_people"),
        of(right, "population").cast("double").alias("b_people"),
    )
    rate = lambda n: F.col(n).cast("double") * F.lit(100000.0) / F.col(f"{n}_people")
    head = lambda n: F.col(n).cast("double") / F.col(f"{n}_people")
    return both.select(
        "year",
        "month",
        F.col("a").alias(names[left.city]),
        F.col("b").alias(names[right.city]),
        rate("a").alias(f"{left.short}_per_100k"),
        rate("b").alias(f"{right.short}_per_100k"),
        (F.col("a") - F.col("b")).alias("diff_raw"),
        (rate("a") - rate("b")).alias("diff_per_100k"),
        _guarded_ratio(head("a"), head("b")).alias(f"{left.short}_to_{right.short}_rate_ratio"),
    )


def coordinates(incidents: DataFrame) -> DataFrame:
    """One row per dated and located incident, with its year and month."""
    return incidents.filter(
        F.col("ts").isNotNull() & F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    ).select(
        "city",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        "longitude",
        "latitude",
        "offense_type",
    )


def ingested_rows(incidents: DataFrame) -> DataFrame:
    """(city, ingested_rows): how many rows each source delivered, unreadable ones too."""
    return incidents.groupBy("city").agg(F.count(F.lit(1)).alias("ingested_rows"))
