"""Invariants between products on the supplied tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def get(spark):
    return lambda key: registry.queries()[key](spark, SF_DIR)


def total(df, column="crime_count"):
    return df.agg(F.sum(column)).first()[0]


def test_monthly_counts_every_dated_incident(get):
    assert total(get("monthly")) == get("incidents").filter("ts IS NOT NULL").count()


def test_strict_counts_are_a_part_of_the_tolerant_ones(get):
    wide, narrow = get("monthly"), get("monthly_narrow").withColumnRenamed("crime_count", "n")
    joined = narrow.join(wide, ["city", "year", "month"], "left")
    assert joined.filter("crime_count IS NULL OR n > crime_count").count() == 0
    assert total(get("monthly_narrow")) < total(wide)


def test_shares_sum_to_one(get):
    for row in get("offense_share").groupBy("city").agg(F.sum("offense_share")).collect():
        assert row[1] == pytest.approx(1.0)


def test_heatmap_holds_every_count_of_its_city(get):
    cells = sum(v for row in get("heatmap").collect() for v in tuple(row)[2:] if v is not None)
    assert cells == total(get("hourly").filter("city = 'DC'"))


def test_violent_groups_add_up_to_the_months(get):
    both = get("violent_monthly").groupBy("city", "year", "month").agg(F.sum("crime_count").alias("n"))
    joined = both.join(get("monthly_narrow"), ["city", "year", "month"], "full")
    assert joined.filter("NOT (n <=> crime_count)").count() == 0


def test_groups_and_zones_cover_their_points(get):
    assert total(get("top_offense_groups")) == get("load_coordinates").count()
    assert get("cluster_map").count() == get("load_coordinates").count()
    assert total(get("theft_zone"), "incidents") == get("theft_points").count()


def test_category_totals(get):
    assert total(get("category_distribution_full"), "dc_crime_count") == total(get("offense_counts_dc"))
    assert total(get("category_distribution"), "chicago_crime_count") == total(
        get("offense_counts_chicago")
    )
