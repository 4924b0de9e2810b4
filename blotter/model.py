"""What a source looks like, and the two sources the products are defined for."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from blotter.functions.classify import (
    CHICAGO_CATEGORIES,
    CHICAGO_VIOLENT_OFFENSES,
    DC_CATEGORIES,
    DC_VIOLENT_GROUP_PREFIX,
    CategoryRule,
    group_starts_with,
    offense_in,
)

# The text layouts a record's time may have. None is Spark's own
# cast of text to a time without zone.
SPACE_FORMAT = "M/d/yyyy h:mm:ss a"
COMMA_FORMAT = "M/d/yyyy, h:mm:ss a"
TOLERANT_FORMATS = (None, SPACE_FORMAT, COMMA_FORMAT)

# Columns of the conformed table, in order. `ts` is parsed with every layout a
# source may use, `ts_strict` with the source's declared layout only: some
# products are defined over one, some over the other.
INCIDENT_COLUMNS = (
    "city",
    "ts",
    "ts_strict",
    "offense_type",
    "offense_group",
    "longitude",
    "latitude",
)


@dataclass(frozen=True)
class Source:
    """How one city's raw table maps onto the conformed incident table.

    `label` and `short` name the city's columns in side-by-side products
    (`chicago_crime_count`, `chi_per_100k`). `zone` is that of the city's wall
    clock, for sources whose time column holds instants.
    """

    city: str
    label: str
    short: str
    population: int
    time_col: str
    offense_col: str
    longitude_col: str
    latitude_col: str
    group_col: str | None = None
    formats: tuple[str | None, ...] = TOLERANT_FORMATS
    strict_formats: tuple[str | None, ...] = (None,)
    zone: str = "UTC"
    violent: Callable[[], Column] = lambda: F.lit(False)
    categories: tuple[CategoryRule, ...] = ()


# City names, populations and column names.
CHICAGO = Source(
    city="Chicago",
    label="chicago",
    short="chi",
    population=2_700_000,
    time_col="date",
    offense_col="primary_type",
    longitude_col="longitude",
    latitude_col="latitude",
    violent=offense_in(CHICAGO_VIOLENT_OFFENSES),
    categories=CHICAGO_CATEGORIES,
)
DC = Source(
    city="DC",
    label="dc",
    short="dc",
    population=702_000,
    time_col="REPORT_DAT",
    offense_col="OFFENSE",
    group_col="OFFENSEGROUP",
    longitude_col="LONGITUDE",
    latitude_col="LATITUDE",
    strict_formats=(COMMA_FORMAT,),
    violent=group_starts_with(DC_VIOLENT_GROUP_PREFIX),
    categories=DC_CATEGORIES,
)
