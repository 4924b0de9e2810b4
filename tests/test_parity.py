"""Every registered query against DuckDB on the supplied tables."""

import pytest

import __spark_entry__ as registry
import oracle
from tests.parity import assert_same_rows, duckdb_on

SF_DIR = "/root/testdata/sf0.01"
QUERIES = registry.core_queries()
ORACLE = oracle.oracle_sql()
# Queries that promise an order, and the order: columns, those that descend after a minus.
ORDERED = {
    "extract_first_n": ("date",),
    "crimes_by_hour": ("hour",),
    "crimes_by_day": ("day_of_week",),
    "most_offense": ("city",),
    "least_offense": ("city",),
    "top_offense_groups": ("offense_group",),
    "heatmap": ("weekday",),
    "population_line": ("month",),
    "monthly_compare_ordered": ("year", "month"),
    "category_distribution": ("-chicago_crime_count", "category"),
    "category_distribution_full": ("-chicago_crime_count", "category"),
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb_on(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("key", QUERIES)
def test_query_matches_sql(spark, duck, key):
    rows = assert_same_rows(QUERIES[key](spark, SF_DIR), duck, ORACLE[key])
    assert rows > 0


@pytest.mark.parametrize("key", ORDERED)
def test_query_keeps_its_order(spark, key):
    def place(row):
        return [-row[c[1:]] if c[0] == "-" else row[c] for c in ORDERED[key]]

    places = [place(row) for row in QUERIES[key](spark, SF_DIR).collect()]
    assert places == sorted(places)
    assert len(places) > 1


@pytest.mark.parametrize("key", ["monthly_compare_ordered", "population_line", "crimes_by_hour", "heatmap"])
def test_order_is_that_of_the_sql(spark, duck, key):
    """Where the order leaves no two rows equal, they come in that of the SQL."""
    assert assert_same_rows(QUERIES[key](spark, SF_DIR), duck, ORACLE[key], ordered=True) > 1


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["city", "year", "month", "crime_count"]
    assert result.count() > 0
