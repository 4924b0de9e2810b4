"""Deliveries: what a second run takes in, what it leaves alone, and where it may break off."""

import itertools
import os
import time

import pytest
from pyspark.sql import functions as F

from blotter.model import CHICAGO, DC
from blotter.operators import rollups
from blotter.operators.conform import incidents
from blotter.plans import deliveries
from blotter.plans.deliveries import deliver, delivered, delivered_products, month_counts
from blotter.sources.ledger import landed_files
from blotter.sources.readers import read_csv
from tests.helpers import plan, rows

CHI_HEAD = "date,primary_type,latitude,longitude,_file"
DC_HEAD = "REPORT_DAT,OFFENSE,OFFENSEGROUP,LATITUDE,LONGITUDE"
numbers = itertools.count()


def land(folder, name, head, lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([head, *lines]) + "\n")
    # Another time than any before, whatever the clock's steps.
    os.utime(path, ns=(stamp := time.time_ns() + next(numbers) * 10**9, stamp))


def chi(*days, offense="THEFT"):
    return [f"{day},{offense},41.8,-87.6,own" for day in days]


def dc(*days):
    return [f'"{day}",ROBBERY,Violent crime,38.9,-77.0' for day in days]


@pytest.fixture()
def place(spark, tmp_path):
    database = f"deliveries_{next(numbers)}"
    land(tmp_path / "chi", "2020 [a].csv", CHI_HEAD, chi("2020-01-05 10:00:00", "2020-01-05 10:00:00", "2020-02-01 00:00:00", "never"))
    land(tmp_path / "dc", "one.csv", DC_HEAD, dc("1/3/2020, 1:00:00 PM", "2020-02-02 03:00:00", ""))
    yield database, tmp_path, [(CHICAGO, str(tmp_path / "chi")), (DC, str(tmp_path / "dc"))]
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def check(spark, database, landings):
    """Every product against the same rollup over all files as they are now."""
    raws = []
    for source, folder in landings:
        found = [r["path"] for r in landed_files(spark, folder).collect()]
        raws.append((source, read_csv(spark, [deliveries.globless(path) for path in found])))
    facts = incidents(raws)
    assert rows(delivered(spark, database).drop("month_id")) == rows(facts)
    keyed = rollups.keyed(facts)
    sources = [source for source, _ in landings]
    offenses = rollups.offense_counts(keyed)
    wanted = {
        "crime_monthly": rollups.monthly(keyed),
        "crime_hourly": rollups.hourly(keyed),
        "crime_monthly_strict": rollups.monthly(keyed, strict=True),
        "crime_vp_monthly": rollups.violent_monthly(keyed, sources),
        "crime_by_offense": offenses,
        "crime_by_offense_norm": rollups.offense_share(offenses),
    }
    found = delivered_products(spark, database)
    assert set(found) == set(wanted)
    for name, want in wanted.items():
        assert rows(found[name].select(*want.columns)) == rows(want), name


def files_of(spark, database, name):
    found = spark.table(f"{database}.{name}").select("city", "month_id", F.input_file_name().alias("file"))
    return {(r["city"], r["month_id"]): r["file"] for r in found.distinct().collect()}


def test_only_new_files_are_taken_and_only_their_months_counted(spark, place):
    database, folder, landings = place
    assert deliver(spark, database, landings) == {"Chicago": 4, "DC": 3}
    check(spark, database, landings)
    before = {name: files_of(spark, database, name) for name in ("times", "offenses", "violence", "landed")}

    assert deliver(spark, database, landings) == {"Chicago": 0, "DC": 0}
    assert {name: files_of(spark, database, name) for name in before} == before

    land(folder / "chi", "sub/later.csv", CHI_HEAD, chi("2020-02-03 05:00:00", "2020-03-01 06:00:00", offense="BATTERY"))
    assert deliver(spark, database, landings) == {"Chicago": 2, "DC": 0}
    check(spark, database, landings)
    for name in ("times", "offenses", "violence"):
        after = files_of(spark, database, name)
        changed = {key for key in after if after[key] != before[name].get(key)}
        assert changed == {("Chicago", 202002), ("Chicago", 202003)}, name


def test_a_changed_file_replaces_its_rows_and_empties_months(spark, place):
    database, folder, landings = place
    deliver(spark, database, landings)
    land(folder / "chi", "2020 [a].csv", CHI_HEAD, chi("2020-02-01 00:00:00", "2021-05-01 00:00:00"))
    assert deliver(spark, database, landings) == {"Chicago": 2, "DC": 0}
    check(spark, database, landings)
    months = {(r["city"], r["year"], r["month"]) for r in delivered_products(spark, database)["crime_monthly"].collect()}
    assert ("Chicago", 2020, 1) not in months and ("Chicago", 2021, 5) in months


def test_a_file_that_is_gone_leaves_its_rows(spark, place):
    database, folder, landings = place
    deliver(spark, database, landings)
    before = rows(delivered(spark, database))
    moved = [(CHICAGO, str(folder / "chi")), (DC, str(folder / "empty"))]
    land(folder / "empty", "none.csv", DC_HEAD, [])
    assert deliver(spark, database, moved) == {"Chicago": 0, "DC": 0}
    assert rows(delivered(spark, database)) == before


@pytest.mark.parametrize("step", [0, 2, 3, 5])
def test_a_run_may_end_anywhere(spark, place, monkeypatch, step):
    """The writes of a run, each the last one: readers see old or new rows, and the next run mends all."""
    database, folder, landings = place
    deliver(spark, database, landings)
    old = rows(delivered(spark, database))
    land(folder / "chi", "2020 [a].csv", CHI_HEAD, chi("2020-02-01 00:00:00", "2021-05-01 00:00:00"))
    land(folder / "dc", "two.csv", DC_HEAD, dc("1/9/2020, 1:00:00 PM"))
    done = itertools.count()

    def breaking(write):
        def run(*args, **kwargs):
            if next(done) == step:
                raise RuntimeError("gone")
            return write(*args, **kwargs)

        return run

    with monkeypatch.context() as patch:
        patch.setattr(deliveries, "_put", breaking(deliveries._put))
        patch.setattr(deliveries, "save_table", breaking(deliveries.save_table))
        with pytest.raises(RuntimeError, match="gone"):
            deliver(spark, database, landings)
    # Writes: landed, pending, ledger, three counts, pending.
    if step <= 2:
        assert rows(delivered(spark, database)) == old
    deliver(spark, database, landings)
    check(spark, database, landings)
    assert spark.table(f"{database}.pending").isEmpty()


def test_counting_reads_the_pending_months_only(spark, place):
    database, _, landings = place
    deliver(spark, database, landings)
    pending = spark.table(f"{database}.pending").filter("month_id >= 0")
    facts = delivered(spark, database).join(pending, ["city", "month_id"], "left_semi")
    assert "dynamicpruning" in plan(rollups.time_cube(facts)).lower()
    assert month_counts(spark, database, "times").filter("crime_count = 0").isEmpty()


def test_a_raw_column_of_any_name_may_be_there(spark, tmp_path):
    land(tmp_path / "chi", "a.csv", "date,primary_type,latitude,longitude,file,city,month_id,delivery,_time0",
         ["2020-01-05 10:00:00,THEFT,1,2,x,y,z,w,v"])
    assert deliver(spark, "deliveries_names", [(CHICAGO, str(tmp_path / "chi"))]) == {"Chicago": 1}
    assert [r["city"] for r in delivered(spark, "deliveries_names").collect()] == ["Chicago"]
    spark.sql("DROP DATABASE deliveries_names CASCADE")
