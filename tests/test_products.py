"""The stored products against the queries, and how they are stored."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import testviews
from blotter.operators import plotsets, rollups
from blotter.model import CHICAGO
from blotter.operators.conform import conform
from blotter.plans.products import (
    COORDINATE_PARTITIONS,
    PRODUCT_ORDER,
    build_products,
    read_product,
)
from blotter.sources.tables import _versions, save_table, save_view
from testviews import raw_sources
from tests.helpers import plan, rows

SF_DIR = "/root/testdata/sf0.001"
DATABASE = "products_test"
SAME_AS_QUERY = {
    "incidents": "incidents",
    "crime_monthly": "monthly",
    "crime_monthly_strict": "monthly_narrow",
    "crime_hourly": "hourly",
    "crime_vp_monthly": "violent_monthly",
    "crime_by_offense": "offense_counts",
    "crime_by_offense_norm": "offense_share",
    "chi_offense_counts": "offense_counts_chicago",
    "dc_offense_counts": "offense_counts_dc",
    "crime_monthly_compare": "monthly_compare",
    "crime_monthly_pop_adjusted": "population_adjusted",
    "crime_coordinates_monthly": "coordinates",
}


def files(df):
    return df.select(F.input_file_name()).distinct().count()


@pytest.fixture(scope="module")
def ingested(spark):
    yield build_products(spark, DATABASE, raw_sources(spark, SF_DIR))
    spark.sql(f"DROP DATABASE {DATABASE} CASCADE")


def test_ingest_counts(spark, ingested):
    query = registry.queries()["ingested_rows"](spark, SF_DIR)
    assert ingested == {r["city"]: r["ingested_rows"] for r in query.collect()}


@pytest.mark.parametrize("name", SAME_AS_QUERY)
def test_table_equals_query(spark, ingested, name):
    query = registry.queries()[SAME_AS_QUERY[name]](spark, SF_DIR)
    assert rows(spark.table(f"{DATABASE}.{name}").select(*query.columns)) == rows(query)


def test_rebuilding_gives_the_same(spark, ingested):
    before = rows(spark.table(f"{DATABASE}.crime_monthly"))
    assert build_products(spark, DATABASE, raw_sources(spark, SF_DIR)) == ingested
    assert rows(spark.table(f"{DATABASE}.crime_monthly")) == before


def test_one_month_reads_one_partition(spark, ingested):
    located = spark.table(f"{DATABASE}.crime_coordinates_monthly")
    month = plotsets.load_coordinates(located, "Chicago", 1997, 7)
    month.collect()
    text = plan(month)
    filters = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert all(name in filters for name in ("city", "year", "month"))


def test_each_month_is_one_file(spark, ingested):
    located = spark.table(f"{DATABASE}.crime_coordinates_monthly")
    assert files(located) == located.select("city", "year", "month").distinct().count()


def test_a_hot_month_is_written_by_several_tasks(spark, ingested):
    located = spark.range(0, 600000, 1, 8).selectExpr(
        "'X' AS city", "2020 AS year", "if(id % 20 = 0, CAST(id % 11 AS INT) + 2, 1) AS month",
        "rand(1) AS longitude", "rand(2) AS latitude", "'A' AS offense_type",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        name = f"{DATABASE}.hot_month"
        balanced = located.hint("rebalance", *COORDINATE_PARTITIONS)
        save_table(balanced, name, COORDINATE_PARTITIONS)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.table(name)
    assert stored.count() == 600000
    assert files(stored.filter("month = 1")) > 4
    assert files(stored.filter("month = 2")) == 1


def test_one_city_reads_one_partition(spark, ingested):
    facts = spark.table(f"{DATABASE}.incidents")
    text = plan(rollups.monthly(rollups.keyed(facts)).filter(F.col("city") == "DC"))
    assert "PartitionFilters: [isnotnull(city), (city = DC)]" in text


def test_rollups_read_their_columns_only(spark, ingested):
    facts = spark.table(f"{DATABASE}.incidents")
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan(rollups.monthly(rollups.keyed(facts)))
    assert "ReadSchema: struct<offense_type:string>" in plan(
        rollups.offense_counts(rollups.keyed(facts))
    )


@pytest.mark.parametrize("name", ["incident_times", "incident_violence"])
def test_cubes_count_every_incident(spark, ingested, name):
    cube = spark.table(f"{DATABASE}.{name}")
    assert cube.agg(F.sum("crime_count")).first()[0] == sum(ingested.values())


def test_cubes_stay_small_with_many_offenses(spark):
    """10,000 offenses in 24 months: what the cubes hold does not depend on the offenses."""
    raw = spark.range(0, 60000, 1, 4).selectExpr(
        "timestamp_ntz'2020-01-01' + make_dt_interval(CAST(id % 730 AS INT), CAST(id % 24 AS INT)) AS date",
        "concat('offense ', id % 10000) AS primary_type", "41.0 AS latitude", "-87.0 AS longitude",
    )
    found = conform(raw, CHICAGO)
    assert found.select("offense_type").distinct().count() == 10000
    assert rollups.time_cube(found).count() <= 24 * 7 * 24
    assert rollups.strict_cube(found, [CHICAGO]).count() <= 24 * 2


def test_any_number_of_cities(spark):
    raw = testviews.chicago_raw(spark, SF_DIR).limit(500)
    cities = [replace(CHICAGO, city=name, label=name.lower(), short=name.lower()[:3])
              for name in ("Reno", "Oslo", "Lima")]
    for count in (1, 2, 3):
        database = f"cities_{count}"
        assert sum(build_products(spark, database, [(c, raw) for c in cities[:count]]).values()) == 500 * count
        tables = {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect()}
        compared = {t for t in tables if t.startswith("crime_monthly_compare") and "__v" not in t}
        compared -= {"crime_monthly_compare_all"}
        assert len(compared) == count * (count - 1) // 2
        for name, left, right in (("", 0, 1), ("_ren_lim", 0, 2), ("_osl_lim", 1, 2))[: len(compared)]:
            months = spark.table(f"{database}.crime_monthly")
            pair = rollups.monthly_compare(months, cities[left], cities[right])
            assert rows(spark.table(f"{database}.crime_monthly_compare{name}")) == rows(pair)
            adjusted = rollups.population_adjusted(pair, cities[left], cities[right])
            stored = spark.table(f"{database}.crime_monthly_pop_adjusted{name}")
            assert stored.columns == adjusted.columns and rows(stored) == rows(adjusted)
        spark.sql(f"DROP DATABASE {database} CASCADE")
    with pytest.raises(ValueError, match="share a city"):
        build_products(spark, "cities_twice", [(cities[0], raw), (cities[0], raw)])


def test_raw_tables_are_stored(spark, ingested):
    for short, city in (("chi", "Chicago"), ("dc", "DC")):
        assert spark.table(f"{DATABASE}.{short}_raw").count() == ingested[city]


def test_coordinates_are_written_without_a_shuffle(spark, ingested):
    facts = spark.table(f"{DATABASE}.incidents").filter("month_start IS NOT NULL")
    assert "Exchange" not in plan(rollups.coordinates(facts))


def test_failed_write_leaves_the_old_table(spark, ingested):
    name = f"{DATABASE}.kept"
    save_table(spark.range(3).toDF("n"), name)
    with pytest.raises(Exception, match="no such luck"):
        save_table(spark.range(5).selectExpr("id + raise_error('no such luck') AS n"), name)
    assert spark.table(name).count() == 3


def test_a_reader_sees_old_or_new_rows_between_any_two_steps(spark, ingested, monkeypatch):
    """Every statement of a replacement is preceded by a read, and may be the last one."""
    name, seen = f"{DATABASE}.turned", []
    save_table(spark.range(3).toDF("n"), name)
    run = spark.sql

    def watched(text, *more):
        seen.append(spark.table(name).count())
        return run(text, *more)

    with monkeypatch.context() as patch:
        patch.setattr(spark, "sql", watched)
        save_table(spark.range(5).toDF("n"), name)
    assert set(seen) == {3, 5} and seen == sorted(seen) and spark.table(name).count() == 5

    def broken(text, *more):
        if text.startswith("CREATE OR REPLACE"):
            raise RuntimeError("gone")
        return run(text, *more)

    with monkeypatch.context() as patch:
        patch.setattr(spark, "sql", broken)
        with pytest.raises(RuntimeError):
            save_table(spark.range(7).toDF("n"), name)
    assert spark.table(name).count() == 5


def test_a_reader_that_has_begun_outlives_one_replacement_and_old_versions_go(spark, ingested):
    name = f"{DATABASE}.kept_versions"
    save_table(spark.range(3).toDF("n"), name)
    begun = spark.table(name)
    begun.schema
    for n in (4, 5, 6, 7):
        save_table(spark.range(n).toDF("n"), name)
        if n == 4:
            assert begun.count() == 3
    assert len(_versions(spark, DATABASE, "kept_versions")) == 2
    assert spark.table(name).count() == 7


def test_a_plain_table_is_taken_over(spark, ingested):
    name = f"`{DATABASE}`.`plain`"
    spark.range(3).toDF("n").write.saveAsTable(f"{DATABASE}.plain")
    save_table(spark.range(4).toDF("n"), name)
    assert spark.table(name).count() == 4
    spark.range(3).toDF("n").write.saveAsTable(f"{DATABASE}.plain_too")
    save_view(spark, f"{DATABASE}.plain_too", f"SELECT n FROM {name}")
    assert spark.table(f"{DATABASE}.plain_too").count() == 4


@pytest.mark.parametrize("name", PRODUCT_ORDER)
def test_products_are_read_in_their_order(spark, ingested, name):
    found = [tuple(r[c] for c in PRODUCT_ORDER[name])
             for r in read_product(spark, DATABASE, name).collect()]
    assert found == sorted(found)
    assert len(found) > 1
