"""Differently shaped sources into one incident table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from blotter.functions.sqltext import quoted, string, unused
from blotter.functions.timeparse import attempt, is_typed, wall_time
from blotter.model import INCIDENT_COLUMNS, Source


def conform(
    raw: DataFrame, source: Source, dated: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """One source as incidents. Every raw row is kept, parsed or not, unless `dated`.

    The raw columns of `keep` come along behind the incidents' own.

    Coordinates that are no finite number become null, as unreadable times do.
    Layouts are tried in a step of their own, so that `ts` and `ts_strict` share
    them. With `dated`, only incidents with a readable time: for a typed time by a
    filter that reaches the scan, for text with each time parsed once.
    """
    time = quoted(source.time_col)
    group = quoted(source.group_col) if source.group_col else "NULL"
    dtype = raw.select(time).schema[0].dataType  # by name, as Spark resolves it
    typed = is_typed(dtype)
    if typed:
        wall = wall_time(time, dtype, source.zone)
        layouts = {fmt: wall for fmt in source.formats + source.strict_formats}
        tried = raw.filter(F.col(time).isNotNull()) if dated else raw
    else:
        formats = list(dict.fromkeys(source.formats + source.strict_formats))
        names = unused(raw.columns, *[f"_time{i}" for i in range(len(formats))])
        layouts = dict(zip(formats, names))
        attempts = [attempt(source.time_col, fmt).alias(name) for fmt, name in layouts.items()]
        tried = raw.select("*", *attempts)

    def first_of(formats: Sequence[str | None]) -> str:
        names = dict.fromkeys(layouts[fmt] for fmt in formats)
        return f"CAST(coalesce({', '.join(names)}) AS TIMESTAMP_NTZ)"

    def finite(name: str) -> str:
        number = f"try_cast({quoted(name)} AS DOUBLE)"
        return f"CASE WHEN abs({number}) < CAST('Infinity' AS DOUBLE) THEN {number} END"

    found = tried.selectExpr(
        f"{string(source.city)} AS city",
        f"{first_of(source.formats)} AS ts",
        f"{first_of(source.strict_formats)} AS ts_strict",
        f"CAST({quoted(source.offense_col)} AS STRING) AS offense_type",
        f"CAST({group} AS STRING) AS offense_group",
        f"{finite(source.longitude_col)} AS longitude",
        f"{finite(source.latitude_col)} AS latitude",
        *map(quoted, keep),
    )
    return _parsed_once(found) if dated and not typed else found


def union_incidents(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of several conformed tables.

    The city is a literal inside each branch, so a filter on one city leaves
    the other sources unread.
    """
    return reduce(DataFrame.unionByName, frames).select(*INCIDENT_COLUMNS)


def incidents(raws: Iterable[tuple[Source, DataFrame]], dated: bool = False) -> DataFrame:
    """The conformed incident table over any number of sources; see `conform` for `dated`."""
    return union_incidents(conform(raw, source, dated) for source, raw in raws)


def distinct_cities(sources: Iterable[Source]) -> list[str]:
    """The sources' cities; a city may be described once only."""
    cities = [source.city for source in sources]
    if len(set(cities)) < len(cities):
        raise ValueError(f"sources share a city: {cities}")
    return cities


def per_source(
    raws: Sequence[tuple[Source, DataFrame]],
    rollup: Callable[[DataFrame], DataFrame],
    dated: bool = False,
) -> DataFrame:
    """`rollup`, which must group by city, over the incidents of several sources.

    Rolls up each source and unites the results, which are the same because no
    two sources have a city in common. Spark compiles a scan and the partial
    aggregate above it into one loop, but not with a union between the two.
    """
    distinct_cities(source for source, _ in raws)
    return reduce(
        DataFrame.unionByName, [rollup(conform(raw, source, dated)) for source, raw in raws]
    )


def _parsed_once(incidents: DataFrame) -> DataFrame:
    """Incidents with a readable time, still to be parsed from text.

    A plain filter would be pushed below the parse and repeat it; a generator
    stays above.
    """
    others = [c for c in incidents.columns if c != "ts"]
    known = F.when(F.col("ts").isNotNull(), F.array("ts"))
    return incidents.select(*others, F.explode(known).alias("ts")).select(*incidents.columns)
