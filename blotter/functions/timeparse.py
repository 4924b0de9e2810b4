"""Tolerant parsing of record times, and the calendar keys of the rollups."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, functions as F, types as T

from blotter.functions.sqltext import quoted, string

# Pattern fields, and the text that each may take up. A year may have a minus, but for 0,
# and has a sign if it has more than four digits; months, days and hours may have zeros
# in front.
_FIELDS = {
    "yyyy": r"(?!-0+(?![0-9]))(?:-?[0-9]{4}|[+-][0-9]{5,19})",
    "M": "0{0,17}[0-9]{1,2}",
    "MM": "[0-9]{2}",
    "d": "0{0,17}[0-9]{1,2}",
    "dd": "[0-9]{2}",
    "H": "0{0,17}[0-9]{1,2}",
    "HH": "[0-9]{2}",
    "h": "0{0,17}[0-9]{1,2}",
    "hh": "[0-9]{2}",
    "mm": "[0-5][0-9]",
    "ss": "[0-5][0-9]",
    "a": "(?i:AM|PM)",
}
# What most texts have there: together these make a time that exists in any month.
_USUAL = _FIELDS | {
    "yyyy": "[0-9]{4}",
    "M": "0?[1-9]|1[0-2]",
    "MM": "0[1-9]|1[0-2]",
    "d": "0?[1-9]|1[0-9]|2[0-8]",
    "dd": "0[1-9]|1[0-9]|2[0-8]",
    "H": "0?[0-9]|1[0-9]|2[0-3]",
    "HH": "[01][0-9]|2[0-3]",
    "h": "0?[1-9]|1[0-2]",
    "hh": "0[1-9]|1[0-2]",
}
_MARKS = frozenset("/,:-. ")

WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _cut(fmt: str) -> tuple[str, str, list[str]] | None:
    """The patterns of a layout's usual text and of all its text, and its field letters in order.

    None for a layout with other than the fields of a whole time, or with two fields
    that no mark keeps apart: those are left to Spark's own parser.
    """
    parts = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z]+)", fmt)
    usual, form, letters, apart = "", "", [], True
    for letter, more, marks in parts:
        if marks:
            if not _MARKS.issuperset(marks):
                return None
            usual, form = usual + re.escape(marks), form + re.escape(marks)
        elif not apart or letter + more not in _FIELDS:
            return None
        else:
            usual += f"(?:{_USUAL[letter + more]})"
            form += f"(?:{_FIELDS[letter + more]})"
            letters.append(letter)
        apart = bool(marks)
    if sorted(letters) not in (sorted("yMdHms"), sorted("yMdhmsa")):
        return None
    return rf"\A{usual}\z", rf"\A{form}\z", letters


def is_typed(dtype: T.DataType) -> bool:
    """Whether a time column needs no parsing."""
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def attempt(name: str, fmt: str | None) -> Column:
    """Text column `name` read in one layout; null where it does not match.

    A failed pattern parse costs a Java exception per row, several times the price of a
    successful one. So Spark's parser, the fastest way, is given texts only that cannot
    fail: those of the layout's usual form, up to the 28th of a month. Of other texts of
    its form the fields are cut out and put together; a date that does not exist gives
    null. Nothing throws. Only a layout with names, quotes or optional parts is tried on
    all text.

    The result is TIMESTAMP_NTZ: the year, hour and weekday of a record are
    those written in it, and are taken without a time-zone lookup per row.
    """
    text = quoted(name)
    if fmt is None:
        # A zone in the text is passed over and a text of a time only is unreadable,
        # whatever the session's zone and the day of the run.
        return F.expr(f"try_cast({text} AS TIMESTAMP_NTZ)")
    parsed = f"CAST(try_to_timestamp({text}, {string(fmt)}) AS TIMESTAMP_NTZ)"
    cut = _cut(fmt)
    if cut is None:
        return F.expr(parsed)
    usual, form, letters = cut

    def field(letter: str) -> str:
        return f"CAST(f[{letters.index(letter)}] AS INT)"

    # The hours 0 and 13 of a half day are none; 25 makes the time null.
    year = f"try_cast(f[{letters.index('y')}] AS INT)"
    if "a" in letters:
        half = f"IF(lower(f[{letters.index('a')}]) = 'pm', 12, 0)"
        hour = f"IF({field('h')} BETWEEN 1 AND 12, {field('h')} % 12 + {half}, 25)"
    else:
        hour = field("H")
    made = (
        f"try_make_timestamp_ntz({year}, {field('M')}, {field('d')}, {hour}, {field('m')},"
        f" CAST({field('s')} AS DECIMAL(16, 6)))"
    )
    # The fields are found once a row, in an array. A minus behind a mark is a year's.
    fields = f"regexp_extract_all({text}, '(?:(?<![0-9A-Za-z])[+-])?[0-9A-Za-z]+', 0)"
    rare = f"CASE WHEN {text} RLIKE {string(form)} THEN transform(array({fields}), f -> {made})[0] END"
    # Most text of another layout is told by its marks, without a pattern.
    told = [f"{'' if mark in fmt else 'NOT '}contains({text}, '{mark}')" for mark in ",/"]
    return F.expr(
        f"CASE WHEN {' AND '.join(told)} THEN"
        f" CASE WHEN {text} RLIKE {string(usual)} THEN {parsed} ELSE {rare} END END"
    )


def wall_time(expression: str, dtype: T.DataType, zone: str) -> str:
    """SQL for a typed time as TIMESTAMP_NTZ.

    An instant (TIMESTAMP) becomes the wall time in `zone`, independent of the
    session's zone; a date its midnight; a time without zone stays.
    """
    if not isinstance(dtype, T.TimestampType):
        return f"CAST({expression} AS TIMESTAMP_NTZ)"
    utc = f"TIMESTAMP_NTZ'1970-01-01' + unix_micros({expression}) * INTERVAL '0.000001' SECOND"
    return utc if zone == "UTC" else f"convert_timezone('UTC', {string(zone)}, {utc})"


def month_start(name: str) -> Column:
    """First day of the month as a DATE: one 4-byte group key for (year, month)."""
    return F.expr(f"trunc(CAST({quoted(name)} AS DATE), 'month')")


def weekday_name(name: str) -> Column:
    """Mon..Sun for 0..6."""
    names = ", ".join(f"'{day}'" for day in WEEKDAYS)
    return F.expr(f"element_at(array({names}), {quoted(name)} + 1)")


def in_month(name: str, year: int, month: int) -> Column:
    """The column in a calendar month: two comparisons, no calendar work per row."""
    return _between(name, date(year, month, 1), date(year + month // 12, month % 12 + 1, 1))


def in_year(name: str, year: int) -> Column:
    """The column in a calendar year."""
    return _between(name, date(year, 1, 1), date(year + 1, 1, 1))


def _between(name: str, first: date, after: date) -> Column:
    return F.expr(
        f"{quoted(name)} >= TIMESTAMP_NTZ'{first}' AND {quoted(name)} < TIMESTAMP_NTZ'{after}'"
    )
