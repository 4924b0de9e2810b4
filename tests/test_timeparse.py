import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from blotter.functions.timeparse import (
    WEEKDAYS,
    attempt,
    in_month,
    is_typed,
    month_start,
    wall_time,
    weekday_name,
)
from blotter.model import COMMA_FORMAT, SPACE_FORMAT, TOLERANT_FORMATS
from blotter.session import configure
from tests.helpers import ordered


def parse_time(name, formats):
    return F.coalesce(*(attempt(name, fmt) for fmt in formats))


def parsed(spark, texts, formats=TOLERANT_FORMATS):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    return [r[0] for r in df.select(parse_time("x", formats)).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-07-04 15:06:07", datetime(2025, 7, 4, 15, 6, 7)),
        ("2025-07-04T15:06:07.000", datetime(2025, 7, 4, 15, 6, 7)),
        ("7/4/2025 3:06:07 PM", datetime(2025, 7, 4, 15, 6, 7)),
        ("07/04/2025 03:06:07 pm", datetime(2025, 7, 4, 15, 6, 7)),
        ("7/4/2025, 12:06:07 AM", datetime(2025, 7, 4, 0, 6, 7)),
        ("2025-07-04T15:06:07-05:00", datetime(2025, 7, 4, 15, 6, 7)),
        ("2025-07-04T15:06:07Z", datetime(2025, 7, 4, 15, 6, 7)),
        ("12:30:00", None),
        ("not a date", None),
        ("13/45/2025, 3:06:07 PM", None),
        ("7/4/2025", None),
        ("", None),
        (None, None),
    ],
)
def test_layouts(spark, text, expected):
    assert parsed(spark, [text]) == [expected]


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    """Text keeps the hour written; an instant becomes the wall time of the source's zone."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert parsed(spark, ["2025-07-04T15:06:07-05:00", "7/4/2025 3:06:07 PM"]) == [
            datetime(2025, 7, 4, 15, 6, 7)] * 2
        instant = spark.sql("SELECT timestamp_micros(1751641567000001) AS t")  # 15:06:07.000001 UTC
        for own, hour in (("UTC", 15), ("America/Chicago", 10)):
            found = instant.select(F.expr(wall_time("t", instant.schema[0].dataType, own)))
            assert found.first()[0] == datetime(2025, 7, 4, hour, 6, 7, 1)
    finally:
        configure(spark)


def test_strict_layout_reads_its_own_only(spark):
    texts = ["7/4/2025, 3:06:07 PM", "7/4/2025 3:06:07 PM", "2025-07-04 15:06:07"]
    assert parsed(spark, texts, (COMMA_FORMAT,)) == [datetime(2025, 7, 4, 15, 6, 7), None, None]


def test_separator_tests_change_no_result(spark):
    """Equal to trying every layout on every text, on near misses of all kinds."""
    rng = random.Random(7)
    good = ["7/4/2025, 3:06:07 PM", "12/31/1999 11:59:59 AM", "2025-07-04 15:06:07",
            "2020-02-29T00:00:00Z", "2024-01-01 00:00:00 America/Chicago"]
    texts = list(good)
    for _ in range(4000):
        text = list(rng.choice(good))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(text))
            marks = [",", "/", " ", ":", "-", "1", "P", ", ", "0", "00", "13", "60", "+", "am", "\n", "\u0661"]
            text[at : at + rng.randint(0, 2)] = rng.choice(marks)
        texts.append("".join(text))
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    plain = F.coalesce(
        F.expr("try_cast(x AS TIMESTAMP_NTZ)"),
        F.try_to_timestamp("x", F.lit(SPACE_FORMAT)).cast("timestamp_ntz"),
        F.try_to_timestamp("x", F.lit(COMMA_FORMAT)).cast("timestamp_ntz"),
    )
    tolerant = parse_time("x", TOLERANT_FORMATS)
    assert df.filter(~tolerant.eqNullSafe(plain)).collect() == []
    assert df.filter(tolerant.isNotNull()).count() > 100
    assert df.filter(tolerant.isNull()).count() > 100


@pytest.mark.parametrize("fmt", [SPACE_FORMAT, COMMA_FORMAT, "yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy H:mm:ss", "hh:mm:ss a d/M/yyyy"])
def test_fields_are_read_as_sparks_parser_reads_them(spark, fmt):
    """Every field at and beyond its bounds."""
    rng = random.Random(fmt)
    letters = ["yyyy", "MM", "dd", "HH", "hh", "mm", "ss", "M", "d", "H", "h", "a"]
    bounds = ["0", "1", "00", "01", "9", "10", "12", "13", "23", "24", "29", "30", "31", "32", "59", "60", "012", "0012"]
    years = ["2024", "1900", "2023", "0000", "0001", "9999", "999", "02024", "+2024", "+12024", "12024", "-2024"]
    texts = []
    for _ in range(3000):
        text = fmt.replace("yyyy", rng.choice(years) if rng.random() < 0.3 else "2024")
        for letter in letters[1:-1]:
            usual = "07" if len(letter) == 2 else "7"
            text = text.replace(letter, rng.choice(bounds) if rng.random() < 0.25 else usual)
        texts.append(text.replace("a", rng.choice(["AM", "PM", "pm", "Am", "am ", "A"])) if "a" in fmt else text)
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    plain = F.try_to_timestamp("x", F.lit(fmt)).cast("timestamp_ntz")
    other = df.filter(~attempt("x", fmt).eqNullSafe(plain))
    assert other.select("x", attempt("x", fmt).cast("string"), plain.cast("string")).collect() == []
    assert 100 < df.filter(attempt("x", fmt).isNotNull()).count() < 2900


def test_unusual_layouts_are_tried_on_all_text(spark):
    assert parsed(spark, ["4 Jul, 2025"], ("d MMM, yyyy",)) == [datetime(2025, 7, 4)]
    assert parsed(spark, ["2025/07/04", "2025/07/04 05"], ("yyyy/MM/dd[ HH]",)) == [
        datetime(2025, 7, 4),
        datetime(2025, 7, 4, 5),
    ]


def test_quotes_in_a_layout(spark):
    assert parsed(spark, ["2025-07-04T05"], ("yyyy-MM-dd'T'HH",)) == [datetime(2025, 7, 4, 5)]


@pytest.mark.parametrize(
    "name, typed", [("timestamp", True), ("timestamp_ntz", True), ("date", True), ("string", False)]
)
def test_typed_times_are_recognised(name, typed):
    assert is_typed(T._parse_datatype_string(name)) is typed


def test_calendar_keys(spark):
    df = spark.sql("SELECT timestamp_ntz'2025-07-06 23:30:00' AS ts")
    out = df.select(month_start("ts"), F.hour("ts"))
    assert ordered(out) == [(date(2025, 7, 1), 23)]
    names = spark.range(7).selectExpr("CAST(id AS INT) AS id").select(weekday_name("id"))
    assert [r[0] for r in names.collect()] == list(WEEKDAYS)


def test_weekday_names_are_those_of_date_format(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-12-28', date'2025-01-10')) AS d")
    days = days.withColumn("w", F.weekday("d"))
    assert days.filter(weekday_name("w") != F.date_format("d", "E")).count() == 0


def test_in_month_is_half_open(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp_ntz'2025-11-30 23:59:59', timestamp_ntz'2025-12-01',"
        " timestamp_ntz'2025-12-31 23:59:59.999999', timestamp_ntz'2026-01-01')) AS ts"
    )
    kept = df.filter(in_month("ts", 2025, 12))
    assert kept.count() == 2
