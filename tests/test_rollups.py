from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from blotter.model import CHICAGO, DC
from blotter.operators import rollups
from tests.helpers import incidents_of, plan, rows

JAN = datetime(2024, 1, 5, 10)
FEB = datetime(2024, 2, 29, 23, 59)
SUNDAY = datetime(2024, 3, 3, 0)


@pytest.fixture(scope="module")
def sample(spark):
    return incidents_of(
        spark,
        {"city": "Chicago", "ts": JAN, "offense_type": "THEFT", "longitude": -87.0, "latitude": 41.0},
        {"city": "Chicago", "ts": JAN, "offense_type": "Theft", "longitude": -87.0},
        {"city": "Chicago", "ts": SUNDAY, "offense_type": "robbery", "latitude": 41.0},
        {"city": "Chicago", "offense_type": None, "longitude": -87.0, "latitude": 41.0},
        {"city": "DC", "ts": JAN, "ts_strict": None, "offense_type": "ROBBERY",
         "offense_group": "Property", "longitude": -77.0, "latitude": 38.0},
        {"city": "DC", "ts": FEB, "offense_type": "ARSON", "offense_group": "violent crime"},
        {"city": "DC", "ts": FEB, "offense_type": "ARSON", "offense_group": None},
    )


@pytest.fixture
def counts(sample):
    return rollups.keyed(sample)


@pytest.fixture(params=["rows", "cube"])
def times(request, sample):
    """The rollups over times give the same from incidents and from their cube."""
    return rollups.keyed(sample) if request.param == "rows" else rollups.time_cube(sample)


@pytest.fixture(params=["rows", "cube"])
def strict(request, sample):
    """So do those over strictly read times, from theirs."""
    return rollups.keyed(sample) if request.param == "rows" else rollups.strict_cube(sample, (CHICAGO, DC))


def test_monthly(times):
    assert rows(rollups.monthly(times)) == {
        ("Chicago", 2024, 1, 2): 1,
        ("Chicago", 2024, 3, 1): 1,
        ("DC", 2024, 1, 1): 1,
        ("DC", 2024, 2, 2): 1,
    }


def test_monthly_strict(strict):
    assert rows(rollups.monthly(strict, strict=True)) == {
        ("Chicago", 2024, 1, 2): 1,
        ("Chicago", 2024, 3, 1): 1,
        ("DC", 2024, 2, 2): 1,
    }


def test_monthly_types(times):
    assert rollups.monthly(times).dtypes == [
        ("city", "string"), ("year", "int"), ("month", "int"), ("crime_count", "bigint")
    ]


def test_hourly(times):
    assert rows(rollups.hourly(times)) == {
        ("Chicago", "Fri", 10, 2): 1,
        ("Chicago", "Sun", 0, 1): 1,
        ("DC", "Fri", 10, 1): 1,
        ("DC", "Thu", 23, 2): 1,
    }


def test_offense_counts_keep_spelling_null_and_undated(counts):
    offenses = rollups.offense_counts(counts)
    assert rows(offenses) == {
        ("Chicago", "THEFT", 1): 1,
        ("Chicago", "Theft", 1): 1,
        ("Chicago", "robbery", 1): 1,
        ("Chicago", None, 1): 1,
        ("DC", "ROBBERY", 1): 1,
        ("DC", "ARSON", 2): 1,
    }
    assert rows(rollups.city_offense_counts(offenses, "DC")) == {("ROBBERY", 1): 1, ("ARSON", 2): 1}


def test_offense_share(counts):
    shares = rows(rollups.offense_share(rollups.offense_counts(counts)))
    assert shares[("Chicago", None, 1, 4, 0.25)] == 1
    assert shares[("DC", "ARSON", 2, 3, 2 / 3)] == 1
    assert sum(shares.values()) == 6


def test_violent_monthly_uses_each_citys_rule(strict):
    violent = rollups.violent_monthly(strict, [CHICAGO, DC])
    assert rows(violent) == {
        ("Chicago", 2024, 1, "Non-violent Crime", 2): 1,
        ("Chicago", 2024, 3, "Violent Crime", 1): 1,
        ("DC", 2024, 2, "Violent Crime", 1): 1,
        ("DC", 2024, 2, "Non-violent Crime", 1): 1,
    }


def test_compare_and_population(times):
    compared = rollups.monthly_compare(rollups.monthly(times), CHICAGO, DC)
    assert rows(compared) == {
        (2024, 1, 2, 1, 1, 2.0): 1,
        (2024, 2, 0, 2, -2, 0.0): 1,
        (2024, 3, 1, 0, 1, None): 1,
    }
    adjusted = rows(rollups.population_adjusted(compared, CHICAGO, DC))
    chi, dc = 2 * 100000.0 / 2700000, 1 * 100000.0 / 702000
    assert adjusted[(2024, 1, 2, 1, chi, dc, 1, chi - dc, (2 / 2700000) / (1 / 702000))] == 1
    assert [key[-1] for key in adjusted if key[1] == 3] == [None]


def test_coordinates_need_time_and_both_coordinates(sample):
    assert rows(rollups.coordinates(sample)) == {
        ("Chicago", 2024, 1, -87.0, 41.0, "THEFT"): 1,
        ("DC", 2024, 1, -77.0, 38.0, "ROBBERY"): 1,
    }


def test_ingested_rows_count_unreadable_rows_too(sample):
    assert rows(rollups.ingested_rows(sample)) == {("Chicago", 4): 1, ("DC", 3): 1}


def test_no_incidents(spark):
    empty = rollups.keyed(incidents_of(spark, {"city": "A"}).limit(0))
    assert rollups.monthly(empty).collect() == []
    assert rollups.offense_share(rollups.offense_counts(empty)).collect() == []


def people(spark, *rows_):
    return spark.createDataFrame(
        [(city, date(*day) if day else None, n) for city, day, n in rows_],
        "city string, valid_from date, population long",
    )


def test_population_holds_until_the_next(spark):
    months = spark.createDataFrame(
        [("X", 2024, m, m * 10) for m in (1, 2, 3, 7)] + [("Y", 2024, 1, 5), ("Z", 2024, 1, 6)],
        "city string, year int, month int, crime_count long",
    )
    known = people(
        spark, ("X", (2024, 2, 1), 100), ("X", (2024, 3, 2), 300), ("X", (2024, 3, 2), 200),
        ("Y", (1999, 1, 1), 7), ("Y", None, 9), ("W", (2000, 1, 1), 8),
    )
    assert rows(rollups.with_population(months, known)) == {
        ("X", 2024, 1, 10, None): 1,
        ("X", 2024, 2, 20, 100): 1,
        ("X", 2024, 3, 30, 100): 1,
        ("X", 2024, 7, 70, 300): 1,
        ("Y", 2024, 1, 5, 7): 1,
        ("Z", 2024, 1, 6, None): 1,
    }
    assert "Cartesian" not in plan(rollups.with_population(months, known))
    assert "NestedLoop" not in plan(rollups.with_population(months, known))


def test_population_by_date_is_the_fixed_one_where_that_is_all(spark, times):
    compared = rollups.monthly_compare(rollups.monthly(times), CHICAGO, DC)
    fixed = people(spark, ("Chicago", (2000, 1, 1), CHICAGO.population), ("DC", (2000, 1, 1), DC.population))
    assert rows(rollups.population_adjusted_by_date(compared, CHICAGO, DC, fixed)) == rows(
        rollups.population_adjusted(compared, CHICAGO, DC)
    )
    later = people(spark, ("Chicago", (2024, 2, 1), 1000), ("DC", (2024, 3, 1), 1000))
    found = {r["month"]: r for r in rollups.population_adjusted_by_date(compared, CHICAGO, DC, later).collect()}
    assert found[1]["chi_per_100k"] is None and found[1]["chicago_crime_count"] == 2
    assert found[2]["chi_per_100k"] == 0.0 and found[2]["dc_per_100k"] is None and found[2]["diff_per_100k"] is None
    assert found[3]["chi_per_100k"] == 100.0 and found[3]["dc_per_100k"] == 0.0


def test_every_two_of_ten_cities_in_one_shuffle(spark):
    cities = [replace(CHICAGO, city=f"C{k}", label=f"c{k}", short=f"s{k}") for k in range(10)]
    months = spark.range(2000).selectExpr(
        "concat('C', id % 10) AS city", "CAST(2000 + id % 7 AS INT) AS year",
        "CAST(1 + id % 11 AS INT) AS month", "id AS crime_count",
    ).filter("id % 13 > 2").groupBy("city", "year", "month").sum("crime_count").withColumnRenamed(
        "sum(crime_count)", "crime_count"
    )
    months = spark.createDataFrame(months.collect(), months.schema)
    found = rollups.compare_all(months, cities)
    assert plan(found).count("Exchange ") == 1
    assert found.select("left_city", "right_city").distinct().count() == 45
    for a, b in ((0, 1), (3, 7), (8, 9)):
        pair = found.filter((F.col("left_city") == f"C{a}") & (F.col("right_city") == f"C{b}"))
        known = months.filter(F.col("city").isin(f"C{a}", f"C{b}"))
        assert rows(pair.drop("left_city", "right_city")) == rows(
            rollups.monthly_compare(known, cities[a], cities[b])
        )
    with pytest.raises(ValueError, match="two cities"):
        rollups.compare_all(months, cities[:1])
