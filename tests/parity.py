"""Row-for-row comparison of a Spark result with DuckDB's."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duckdb_on(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A connection with every Parquet file of `sf_dir` as a view."""
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def assert_same_rows(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str, ordered: bool = False) -> int:
    """Equal column names and equal rows, as multisets or in order; returns their number."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    found = result.fetchall()
    own = [tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    if ordered:
        assert own == found
    expected, actual = Counter(found), Counter(own)
    assert actual == expected, {
        "only in spark": list((actual - expected).items())[:5],
        "only in duckdb": list((expected - actual).items())[:5],
    }
    return sum(actual.values())
