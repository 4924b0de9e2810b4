import pytest

from blotter.operators import rankings
from tests.helpers import ordered, rows

MONTHLY = "city string, year int, month int, crime_count long"
OFFENSES = "city string, offense_type string, crime_count long"


HOURS = [("Reno", 23, 4_000_000_000), ("Oslo", 23, 4_000_000_000), ("Oslo", 0, 1), (None, None, 6)]


def test_rows_are_counted_with_nulls(spark):
    df = spark.createDataFrame(HOURS, "city string, hour int, crime_count long")
    assert rankings.row_count(df) == 4
    assert ordered(rankings.row_count_frame(df)) == [(4,)]
    assert ordered(rankings.row_count_frame(df.limit(0))) == [(0,)]


def test_hours_add_up_over_cities(spark):
    df = spark.createDataFrame(HOURS, "city string, hour int, crime_count long")
    assert ordered(rankings.crimes_by_hour(df)) == [(None, 6), (0, 1), (23, 8_000_000_000)]


def test_crimes_by_day_is_alphabetical(spark):
    df = spark.createDataFrame(
        [("A", "Mon", 1), ("A", "Fri", 2), ("B", "Mon", 3), ("B", "Sun", 4)],
        ["city", "day_of_week", "crime_count"],
    )
    assert ordered(rankings.crimes_by_day(df)) == [("Fri", 2), ("Mon", 4), ("Sun", 4)]


def test_sums_by_city_and_group(spark):
    df = spark.createDataFrame(
        [("Oslo", "x", 3_000_000_000), ("Oslo", "x", 3_000_000_000), ("Oslo", None, 2), ("Oslo", None, 5),
         ("Lima", "x", 1), (None, "y", 9)],
        "city string, crime_group string, crime_count long",
    )
    assert rankings.sum_violent_crimes(df).columns == ["city", "crime_group", "sum(crime_count)"]
    assert rows(rankings.sum_violent_crimes(df)) == {
        ("Oslo", "x", 6_000_000_000): 1, ("Oslo", None, 7): 1, ("Lima", "x", 1): 1, (None, "y", 9): 1
    }
    assert rows(rankings.sum_crimes(df)) == {("Oslo", 6_000_000_007): 1, ("Lima", 1): 1, (None, 9): 1}


@pytest.fixture(scope="module")
def months(spark):
    return spark.createDataFrame(
        [("A", 2020, 1, 5), ("A", 2021, 1, 5), ("A", 2020, 2, 3), ("A", 2020, 3, 1),
         ("B", 2020, 7, 2)],
        MONTHLY,
    )


def test_extreme_months_keep_ties(months):
    assert rows(rankings.max_crimes(months)) == {("A", 1, 5): 2, ("B", 7, 2): 1}
    assert rows(rankings.min_crimes(months)) == {("A", 3, 1): 1, ("B", 7, 2): 1}
    assert rows(rankings.max_crimes(months, keep_year=True)) == {
        ("A", 2020, 1, 5): 1, ("A", 2021, 1, 5): 1, ("B", 2020, 7, 2): 1
    }


def test_missing_count_ranks_lowest(spark):
    df = spark.createDataFrame([("A", 2020, 1, None), ("A", 2020, 2, 4)], MONTHLY)
    assert rows(rankings.min_crimes(df)) == {("A", 1, None): 1}
    assert rows(rankings.max_crimes(df)) == {("A", 2, 4): 1}


def test_violent_peak_is_one_per_city_not_per_group(spark):
    df = spark.createDataFrame(
        [("A", 2020, 1, "v", 5), ("A", 2020, 1, "n", 9), ("A", 2020, 2, "n", 9), ("B", 2020, 3, "v", 1)],
        "city string, year int, month int, crime_group string, crime_count long",
    )
    assert rows(rankings.max_crimes_violent(df)) == {
        ("A", 1, 9, "n"): 1, ("A", 2, 9, "n"): 1, ("B", 3, 1, "v"): 1
    }


def test_offense_extremes_give_one_row_per_city(spark):
    df = spark.createDataFrame(
        [("B", "y", 4), ("B", "x", 4), ("B", None, 4), ("A", "p", 1), ("A", None, 1), ("A", "q", 3)],
        OFFENSES,
    )
    assert ordered(rankings.most_offense_committed(df)) == [("A", "q", 3), ("B", "x", 4)]
    assert ordered(rankings.least_offense_committed(df)) == [("A", "p", 1), ("B", "x", 4)]


def test_one_city_holding_most_groups(spark):
    """Many groups of one city over many partitions still give one winner."""
    df = spark.range(0, 30000, 1, 16).selectExpr(
        "if(id % 3 = 0, concat('c', id % 50), 'hot') AS city",
        "concat('o', lpad(id, 6, '0')) AS offense_type",
        "id % 1000 AS crime_count",
    )
    out = {r["city"]: tuple(r)[1:] for r in rankings.most_offense_committed(df).collect()}
    tied = df.filter("city = 'hot' AND crime_count = 999").select("offense_type").collect()
    assert len(tied) == 20
    assert out["hot"] == (min(r[0] for r in tied), 999)
