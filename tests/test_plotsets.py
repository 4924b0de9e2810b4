from dataclasses import replace

import pytest

from blotter.functions.classify import CategoryRule
from blotter.model import CHICAGO, DC
from blotter.operators import plotsets
from tests.helpers import ordered, rows

COORDINATES = (
    "city string, year int, month int, longitude double, latitude double, offense_type string"
)


@pytest.fixture(scope="module")
def points(spark):
    sizes = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 1, None: 9}
    records = [
        ("Chicago", 2025, 7, -87.0 - n, 41.0, offense)
        for offense, size in sizes.items()
        for n in range(size)
    ]
    return spark.createDataFrame(records, COORDINATES)


def test_load_coordinates(spark):
    df = spark.createDataFrame(
        [("Chicago", 2025, 7, 1.0, 2.0, "A"), ("Chicago", 2025, 8, 1.0, 2.0, "A"),
         ("Chicago", 2024, 7, 1.0, 2.0, "A"), ("DC", 2025, 7, 1.0, 2.0, "A")],
        COORDINATES,
    )
    assert ordered(plotsets.load_coordinates(df, "Chicago", 2025, 7)) == [
        ("Chicago", 2025, 7, 1.0, 2.0, "A")
    ]


def test_offense_groups_are_the_five_largest_and_other(points):
    assert ordered(plotsets.offense_groups(points)) == [
        ("B", 2), ("C", 3), ("D", 4), ("E", 5), ("F", 6), ("Other", 11)
    ]


def test_every_point_gets_its_group(points):
    out = plotsets.cluster_points(points)
    assert out.count() == points.count()
    groups = rows(out.select("offense_type", "offense_group"))
    assert groups[(None, "Other")] == 9
    assert groups[("A", "Other")] == 1 and groups[("G", "Other")] == 1
    assert groups[("F", "F")] == 6


def test_ties_for_the_last_group_go_by_name(spark):
    df = spark.createDataFrame(
        [("X", 1, 1, 0.0, 0.0, t) for t in ("b", "a", "c", None, None, None)], COORDINATES
    )
    assert ordered(plotsets.offense_groups(df, k=2)) == [("Other", 4), ("a", 1), ("b", 1)]


def test_fewer_offenses_than_groups(spark):
    df = spark.createDataFrame([("X", 1, 1, 0.0, 0.0, t) for t in ("a", None)], COORDINATES)
    assert ordered(plotsets.offense_groups(df)) == [("Other", 1), ("a", 1)]


def test_zones(spark):
    df = spark.createDataFrame(
        [("Chicago", 2025, 7, -87.5, 41.85, "Theft"), ("Chicago", 2025, 7, -87.9, 41.84, "THEFT"),
         ("Chicago", 2025, 7, -87.1, 42.0, "theft"), ("Chicago", 2025, 7, -99.0, 42.0, "ARSON"),
         ("Chicago", 2025, 7, -99.0, 42.0, None)],
        COORDINATES,
    )
    assert rows(plotsets.zone_points(df, plotsets.THEFT)) == {
        (-87.5, 41.85, "Theft", "North"): 1,
        (-87.9, 41.84, "THEFT", "South"): 1,
        (-87.1, 42.0, "theft", "North"): 1,
    }
    assert rows(plotsets.zone_summary(df, plotsets.THEFT)) == {
        ("North", 2, -87.9): 1, ("South", 1, -87.9): 1
    }
    assert rows(plotsets.zone_summary(df, plotsets.BATTERY_ASSAULT)) == {
        ("North", 0, None): 1, ("South", 0, None): 1
    }


def test_heatmap_is_dense_and_ordered(spark):
    df = spark.createDataFrame(
        [("DC", "Sun", 23, 4), ("DC", "Mon", 0, 7), ("Chicago", "Mon", 0, 1), ("DC", None, 1, 9)],
        "city string, day_of_week string, hour int, crime_count long",
    )
    out = plotsets.heatmap(df, "DC")
    assert out.columns == ["day_of_week", "weekday"] + [str(h) for h in range(24)]
    matrix = ordered(out)
    assert [row[0] for row in matrix] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    cells = {(r[0], h): v for r in matrix for h, v in enumerate(r[2:]) if v is not None}
    assert cells == {("Mon", 0): 7, ("Sun", 23): 4}


def test_population_line(spark):
    df = spark.createDataFrame(
        [(2025, 11, 1.0), (2025, 2, 2.0), (2024, 1, 3.0)], "year int, month int, chi_per_100k double"
    )
    assert ordered(plotsets.population_line(df, 2025)) == [
        (2025, 2, 2.0, "2025-02"), (2025, 11, 1.0, "2025-11")
    ]


def test_category_distribution(spark):
    schema = "offense_type string, crime_count long"
    chi = spark.createDataFrame([("THEFT", 3), ("Theft", 2), ("BATTERY", 9), ("ROBBERY", 5)], schema)
    dc = spark.createDataFrame([("THEFT/OTHER", 4), ("ROBBERY", 2), ("SEX ABUSE", 8)], schema)
    left = plotsets.category_distribution(chi, CHICAGO, dc, DC)
    assert left.columns == ["category", "chicago_crime_count", "dc_crime_count"]
    assert ordered(left) == [("Violent Crime", 9, 2), ("Robbery", 5, 0), ("Theft", 5, 4)]
    assert left.dtypes[2][1] == "bigint"
    full = plotsets.category_distribution(chi, CHICAGO, dc, DC, how="full")
    assert ordered(full)[-1] == ("Sex Crime", 0, 8)


def test_categories_are_the_sources_own(spark):
    own = replace(CHICAGO, categories=(CategoryRule("Any", has=("a",)),))
    df = spark.createDataFrame([("bat", 1), ("cot", 2)], "offense_type string, crime_count long")
    assert rows(plotsets.categorised(df, own.categories)) == {("bat", 1, "Any"): 1, ("cot", 2, "Other"): 1}
