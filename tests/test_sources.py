from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from blotter.model import CHICAGO, DC
from blotter.operators.conform import incidents
from blotter.sources import tables
from blotter.sources.extract import first_n
from blotter.sources import readers
from blotter.sources.readers import read_csv, read_mixed_csv
from tests.helpers import ordered, rows

CSV = "date,primary_type,latitude,longitude,extra\n" \
      "2025-07-04T15:06:07.000,THEFT,41.9,-87.6,x\n" \
      "7/5/2025 1:00:00 AM,\"BATTERY, SIMPLE\",n/a,-87.7,y\n" \
      ",,,,\n"


@pytest.fixture
def csv_dir(tmp_path):
    (tmp_path / "part1.csv").write_text(CSV)
    return str(tmp_path)


def test_csv_is_text_by_name(spark, csv_dir):
    df = read_csv(spark, csv_dir)
    assert set(dict(df.dtypes).values()) == {"string"}
    assert rows(incidents([(CHICAGO, df)]).select("ts", "offense_type", "latitude")) == {
        (datetime(2025, 7, 4, 15, 6, 7), "THEFT", 41.9): 1,
        (datetime(2025, 7, 5, 1), "BATTERY, SIMPLE", None): 1,
        (None, None, None): 1,
    }


def test_csv_inferred_and_with_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,n\n2025-07-04 15:06:07,3\n")
    inferred = read_csv(spark, str(tmp_path), infer=True)
    assert inferred.dtypes == [("date", "timestamp"), ("n", "int")]
    schema = T.StructType([T.StructField("date", T.StringType()), T.StructField("n", T.LongType())])
    assert ordered(read_csv(spark, str(tmp_path), schema)) == [("2025-07-04 15:06:07", 3)]


def test_csv_schema_is_checked_against_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,n\n2025-07-04 15:06:07,3\n")
    wrong = T.StructType([T.StructField("n", T.StringType()), T.StructField("date", T.StringType())])
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path), wrong).collect()


@pytest.mark.parametrize(
    "other",
    ["n,date\n4,2025-07-05\n", "date\n2025-07-05\n", "date,n,more\n2025-07-05,4,x\n"],
    ids=["other order", "a column missing", "a column more"],
)
def test_csv_files_of_other_headers_are_refused(spark, tmp_path, other):
    (tmp_path / "a.csv").write_text("date,n\n2025-07-04,3\n")
    (tmp_path / "b.csv").write_text(other)
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path)).select("date").collect()


def test_csv_files_of_one_header(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f"date,n\n2025-07-04,{name}\n")
    assert rows(read_csv(spark, str(tmp_path)).select("n")) == {("a",): 1, ("b",): 1}


def test_files_of_several_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,n\n2025-07-04,3\n\n2025-07-05,\n")
    (tmp_path / "b.csv").write_text("n,Date,\"a, b\"\n4,2025-07-06,\"x, y\"\nn,Date,\"a, b\"\n5,2025-07-07\n")
    (tmp_path / "c.csv").write_text("broken,n,line\r\nz,6,file\r\n1,2,3,4\r\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("n,date\n")
    found, rejected = read_mixed_csv(spark, str(tmp_path))
    assert found.columns == ["Date", "a, b", "broken", "line", "n"]
    assert rows(found) == {
        ("2025-07-04", None, None, None, "3"): 1,
        ("2025-07-05", None, None, None, None): 1,
        ("2025-07-06", "x, y", None, None, "4"): 1,
        (None, None, "z", "file", "6"): 1,
    }
    assert {(r["file"][-5:], r["line"]) for r in rejected.collect()} == {
        ("b.csv", "5,2025-07-07"),
        ("c.csv", "1,2,3,4"),
    }


def test_headers_that_cannot_be_read(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("n,N\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_mixed_csv(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("n\n1\n")
    monkeypatch.setattr(readers, "LAYOUTS", 1)
    with pytest.raises(ValueError, match="distinct headers"):
        read_mixed_csv(spark, str(tmp_path))


@pytest.fixture
def database(spark):
    tables.create_database(spark, "sources_test")
    tables.create_database(spark, "sources_test")  # again: no error
    yield "sources_test"
    spark.sql("DROP DATABASE sources_test CASCADE")


def test_save_replaces_and_previews(spark, database, capsys):
    tables.save_table(spark.range(30).toDF("n"), f"{database}.t")
    tables.save_table(spark.range(25).selectExpr("id AS n", "'x' AS s"), f"{database}.t")
    stored = spark.table(f"{database}.t")
    assert stored.count() == 25
    assert tables.preview(stored).count() == 20
    stored.printSchema()
    assert "s: string" in capsys.readouterr().out


def test_names_ignore_case(spark, database):
    tables.save_table(spark.range(2).toDF("REPORT_DAT"), f"{database}.t")
    assert spark.table(f"{database}.T").select("report_dat").count() == 2


def test_counted_save(spark, database):
    df = spark.range(10).selectExpr("if(id < 7, 'Chicago', 'DC') AS city", "id")
    assert tables.save_counted(df, f"{database}.c", ["Chicago", "DC", "Reno"]) == {
        "Chicago": 7, "DC": 3, "Reno": 0
    }
    assert spark.table(f"{database}.c").count() == 10


def brute_force(records, n):
    def key(r):
        return [(v is None, v if v is not None else 0) for v in r]

    return sorted(records, key=key)[:n]


TIMED = replace(CHICAGO, time_col="t")


def extract(spark, records, n, parts=12):
    df = spark.createDataFrame(records, "t timestamp_ntz, k int").repartition(parts)
    return [tuple(r) for r in first_n(df, TIMED, n).collect()]


START = datetime(2020, 1, 1)


@pytest.mark.parametrize("n", [5, 1000, 3999, 4000, 9000])
def test_first_n(spark, n):
    records = [(START + timedelta(hours=7 * (i % 1600)), i % 53) for i in range(4000)]
    assert extract(spark, records, n) == brute_force(records, n)


@pytest.mark.parametrize("n", [3, 1500, 4500])
def test_first_n_with_one_day_holding_most_rows(spark, n):
    records = [(START + timedelta(days=i % 10), i) for i in range(2000)]
    records += [(START + timedelta(days=4, seconds=i % 3, milliseconds=i % 7), i % 90) for i in range(2500)]
    assert extract(spark, records, n) == brute_force(records, n)


@pytest.mark.parametrize("n", [1500, 2200, 3000])
def test_first_n_takes_undated_rows_last(spark, n):
    records = [(START + timedelta(hours=i), i) for i in range(2000)] + [(None, i % 9) for i in range(500)]
    assert extract(spark, records, n) == brute_force(records, n)


@pytest.mark.parametrize("n", [0, 5, 1500, 2100])
def test_first_n_of_times_as_text(spark, n):
    """Ordered by the time read, whatever its layout, and not as text."""
    times = [START + timedelta(hours=i * 5) for i in range(1900)]
    texts = [
        t.strftime("%Y-%m-%d %H:%M:%S") if i % 2 else f"{t.month}/{t.day}/{t.year} {t.strftime('%I:%M:%S %p')}"
        for i, t in enumerate(times)
    ]
    records = [(x, i) for i, x in enumerate(texts)] + [("soon", 1), (None, 2)]
    df = spark.createDataFrame(records, "t string, k int").repartition(7)
    out = [tuple(r) for r in first_n(df, TIMED, n).collect()]
    assert out == [*records[:1900], ("soon", 1), (None, 2)][:n]


@pytest.mark.parametrize("n", [40, 100, 260])
def test_first_n_of_clashing_names_and_maps(spark, n):
    """Names that the extract uses itself stay the source's, in any case."""
    names = "_time _copies _number _part _rows _before _inside _taken _copy day second rows place upto".split()
    df = spark.range(250).selectExpr(
        "if(id > 240, null, timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, 0, 0, 0, id div 50)) AS t",
        "concat('x', id % 97) AS `_TIME`",
        "map('k', id % 3) AS m",
        *[f"id % {k + 2} AS `{name}`" for k, name in enumerate(names[1:])],
    )
    df = df.union(df.limit(20)).repartition(5)
    found = first_n(df, TIMED, n)
    assert found.columns == df.columns

    def key(r):
        return [(v is None, str(v).replace("'", "") if isinstance(v, dict) else 0 if v is None else v) for v in r]

    want = sorted((tuple(r) for r in df.collect()), key=key)[:n]
    assert [tuple(r) for r in found.collect()] == want


def test_first_n_counts_the_source_once(spark):
    """Typed rows are read for the counts, and for the result."""
    df = spark.createDataFrame([(START + timedelta(hours=i), i) for i in range(500)], "t timestamp_ntz, k int")
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    text = df.select(F.date_format("t", "M/d/yyyy h:mm:ss a").alias("t"), "k").mapInArrow(passed, "t string, k int")
    assert [r["k"] for r in first_n(text, TIMED, 100).collect()] == list(range(100))
    assert seen.value == 2 * 500


def test_first_n_of_far_times_and_dates(spark):
    df = spark.range(3000).selectExpr(
        "if(id % 2 = 0, timestamp_ntz'9999-12-31 23:59:58', timestamp_ntz'2020-01-01') AS t", "id"
    )
    assert first_n(df, TIMED, 2000).count() == 2000
    days = spark.range(3000).selectExpr("date_add(date'2020-01-01', cast(id % 900 AS int)) AS t", "id")
    out = first_n(days, TIMED, 1500)
    assert out.agg(F.max("t")).first()[0] == date(2020, 1, 1) + timedelta(days=399)  # 300 x 4 rows, 100 x 3
    zoned = days.select(F.col("t").cast("timestamp"), "id")
    assert first_n(zoned, TIMED, 1500).count() == 1500


def test_sources_differ_only_in_their_description():
    assert DC.strict_formats != CHICAGO.strict_formats
    assert DC.formats == CHICAGO.formats
