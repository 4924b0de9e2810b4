"""All stored products, from raw sources to tables.

The raw sources are stored as they came, and parsed once, into the incident table.
That is laid out by city and month; two small cubes and the offense counts come from
it, and every other count product from those or from another product. Each step reads
what the one before has written, so a lost executor costs at most the step it worked on.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, functions as F

from blotter.functions.sqltext import quoted, string
from blotter.functions.timeparse import month_start
from blotter.model import Source
from blotter.operators import rollups
from blotter.operators.conform import distinct_cities, incidents
from blotter.sources.tables import create_database, save_counted, save_table, save_view

INCIDENT_PARTITIONS = ("city", "month_start")
COORDINATE_PARTITIONS = ("city", "year", "month")

# The products that are shown in an order, and that order.
PRODUCT_ORDER = {
    "crime_by_offense_norm": ("crime_count", "city"),
    "crime_monthly_compare": ("year", "month"),
    "crime_vp_monthly": ("year", "month"),
    "crime_hourly": ("day_of_week",),
}


def read_product(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A stored product, in its order if it has one.

    Order is not kept in tables, so it is applied here; the remaining columns
    decide between rows that the order leaves equal.
    """
    found = spark.table(f"`{database}`.`{name}`")
    order = PRODUCT_ORDER.get(name)
    if order is None and name.startswith("crime_monthly_compare_"):
        order = PRODUCT_ORDER["crime_monthly_compare"]
    if order is None:
        return found
    return found.orderBy(*order, *[c for c in found.columns if c not in order])


def _pair_view(everything: str, left: Source, right: Source) -> str:
    """SQL for one pair of `compare_all`, as `monthly_compare` has it."""
    return f"""
        SELECT year, month, left_crime_count AS {quoted(f"{left.label}_crime_count")},
            right_crime_count AS {quoted(f"{right.label}_crime_count")},
            diff AS {quoted(f"diff_{left.short}_minus_{right.short}")},
            ratio AS {quoted(f"{left.short}_to_{right.short}_ratio")}
        FROM {everything}
        WHERE left_city = {string(left.city)} AND right_city = {string(right.city)}"""


def _adjusted_view(compared: str, left: Source, right: Source) -> str:
    """SQL for `population_adjusted` over a stored comparison."""
    a, b = (quoted(f"{s.label}_crime_count") for s in (left, right))
    rate_a, rate_b = (
        f"CAST({n} AS DOUBLE) * 100000D / {s.population}D" for n, s in ((a, left), (b, right))
    )
    head_a, head_b = (f"CAST({n} AS DOUBLE) / {s.population}D" for n, s in ((a, left), (b, right)))
    return f"""
        SELECT year, month, {a}, {b}, {rate_a} AS {quoted(f"{left.short}_per_100k")},
            {rate_b} AS {quoted(f"{right.short}_per_100k")}, {a} - {b} AS diff_raw,
            {rate_a} - {rate_b} AS diff_per_100k,
            CASE WHEN {head_b} > 0 THEN ({head_a}) / ({head_b}) END
                AS {quoted(f"{left.short}_to_{right.short}_rate_ratio")}
        FROM {compared}"""


def build_products(
    spark: SparkSession, database: str, raws: Sequence[tuple[Source, DataFrame]]
) -> dict[str, int]:
    """Write every product into `database`; returns the rows ingested per city.

    Any number of sources, each of another city. The first two are compared under the
    plain names. `crime_monthly_compare_all` has every two of them, from one job; pairs
    after the first are views of it, with both cities' short names added.
    """
    sources = [source for source, _ in raws]
    cities = distinct_cities(sources)
    create_database(spark, database)

    def table(name: str) -> str:
        return f"`{database}`.`{name}`"

    def stored(name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        save_table(df, table(name), partition_by)
        return spark.table(table(name))

    kept = [(source, stored(f"{source.short}_raw", raw)) for source, raw in raws]

    # Rebalancing gives each month few files, and splits the month that holds much of
    # the data over several tasks.
    by_month = incidents(kept).withColumn("month_start", month_start("ts"))
    by_month = by_month.hint("rebalance", *INCIDENT_PARTITIONS)
    ingested = save_counted(by_month, table("incidents"), cities, INCIDENT_PARTITIONS)
    facts = spark.table(table("incidents"))

    times = stored("incident_times", rollups.time_cube(facts))
    months = stored("crime_monthly", rollups.monthly(times))
    stored("crime_hourly", rollups.hourly(times))
    strict = stored("incident_violence", rollups.strict_cube(facts, sources))
    stored("crime_monthly_strict", rollups.monthly(strict, strict=True))
    stored("crime_vp_monthly", rollups.violent_monthly(strict))

    offenses = stored("crime_by_offense", rollups.offense_counts(rollups.keyed(facts)))
    stored("crime_by_offense_norm", rollups.offense_share(offenses))
    for source in sources:
        stored(
            f"{source.short}_offense_counts",
            rollups.city_offense_counts(offenses, source.city),
        )

    # The first two under the plain names; every pair in one table, from one job.
    if len(sources) > 1:
        left, right = sources[:2]
        compared = stored("crime_monthly_compare", rollups.monthly_compare(months, left, right))
        stored("crime_monthly_pop_adjusted", rollups.population_adjusted(compared, left, right))
        stored("crime_monthly_compare_all", rollups.compare_all(months, sources))
        for a, b in list(combinations(sources, 2))[1:]:
            suffix = f"{a.short}_{b.short}"
            compared = _pair_view(table("crime_monthly_compare_all"), a, b)
            save_view(spark, table(f"crime_monthly_compare_{suffix}"), compared)
            adjusted = _adjusted_view(table(f"crime_monthly_compare_{suffix}"), a, b)
            save_view(spark, table(f"crime_monthly_pop_adjusted_{suffix}"), adjusted)

    # The incidents lie by month already: each task writes the months it reads.
    located = facts.filter(F.col("month_start").isNotNull())
    stored("crime_coordinates_monthly", rollups.coordinates(located), COORDINATE_PARTITIONS)
    return ingested
