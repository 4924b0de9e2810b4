"""The first n records of a source by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from blotter.functions.sqltext import quoted, unused
from blotter.functions.timeparse import attempt, is_typed, wall_time
from blotter.model import Source
from blotter.sources.shared import stored


def _timed(raw: DataFrame, source: Source, time: str) -> DataFrame:
    """The rows with their time as `conform` reads it, TIMESTAMP_NTZ.

    A typed time is a plain column, so that bounds on it reach the scan. Text goes
    through a generator, which no filter passes: it is parsed once and not again for
    the filter.
    """
    name = quoted(source.time_col)
    dtype = raw.select(name).schema[0].dataType
    if is_typed(dtype):
        return raw.select("*", F.expr(wall_time(name, dtype, source.zone)).alias(time))
    read = F.coalesce(*[attempt(source.time_col, fmt) for fmt in source.formats])
    return raw.select("*", F.explode(F.array(read)).alias(time))


def _bound(counts: DataFrame, step: str, n: int) -> tuple[object, int, int] | None:
    """The first `step` at which the rows so far reach n, the rows before it, and its own."""
    upto = F.sum("rows").over(Window.orderBy(step))
    reached = counts.withColumn("upto", upto).filter(F.col("upto") >= n)
    found = reached.orderBy(step).select(step, F.col("upto") - F.col("rows"), "rows").first()
    return tuple(found) if found else None


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_map(field.dataType) for field in dtype)
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    return isinstance(dtype, T.MapType)


def _ties(raw: DataFrame) -> list[Column]:
    """The raw columns in ascending order, nulls last; maps, which have none, by their text."""
    columns = [
        F.col(quoted(field.name)).cast("string") if _holds_map(field.dataType) else F.col(quoted(field.name))
        for field in raw.schema
    ]
    return [column.asc_nulls_last() for column in columns]


def _first_of_equal_time(rows: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The k first rows in `order`, over any number of tasks.

    Equal rows are counted, not kept apart. The others are sorted by ranges; a
    row's place follows from the rows of the ranges before and those before it in
    its own. The ranges are stored, so that both sums are over the same ones.
    """
    columns = [quoted(column) for column in rows.columns]
    names = ("_copies", "_number", "_part", "_rows", "_before", "_inside", "_taken", "_copy")
    copies, number, part, total, before, inside, taken, copy = unused(rows.columns, *names)
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(copies))
    # The number grows along the sorted ranges: range in its high 31 bits.
    numbered = counted.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(numbered.withColumn(number, F.monotonically_increasing_id()))
    numbered = numbered.withColumn(part, F.shiftright(number, 33))
    earlier = (Window.unboundedPreceding, -1)
    sizes = numbered.groupBy(part).agg(F.sum(copies).alias(total))
    so_far = F.sum(total).over(Window.orderBy(part).rowsBetween(*earlier))  # one row a range
    sizes = sizes.select(part, F.coalesce(so_far, F.lit(0)).alias(before))
    own = F.sum(copies).over(Window.partitionBy(part).orderBy(number).rowsBetween(*earlier))
    placed = numbered.withColumn(inside, F.coalesce(own, F.lit(0))).join(sizes, part)
    left = F.lit(k) - F.col(before) - F.col(inside)
    placed = placed.withColumn(taken, F.least(copies, left).cast("int")).filter(F.col(taken) > 0)
    repeated = F.explode(F.array_repeat(F.lit(0), F.col(taken))).alias(copy)
    return placed.select(*columns, repeated).select(*columns)


def first_n(raw: DataFrame, source: Source, n: int) -> DataFrame:
    """The n earliest rows of a source, with its own columns, in order.

    Rows are ordered by their time as `conform` reads it, typed or text; rows
    without a readable one come last. The raw columns break ties, so only equal rows
    can stand for each other and a rerun gives the same result. A column that holds
    maps is ordered by its text. Column names are the source's own affair.

    One job here counts the rows by second, a table of its own from which the day and
    then the second of the n-th row follow. All rows before that second are taken as
    they are; only the second's own rows, or those without a time, are ranked, and the
    result is sorted by ranges. No task ever holds n rows.
    """
    (time,) = unused(raw.columns, "_time")
    timed = _timed(raw, source, time)
    ties = _ties(raw)
    order = [F.asc_nulls_last(time), *ties]
    columns = [quoted(column) for column in raw.columns]
    # Hour, minute and second of a zone-less time need no session zone.
    second = (F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)).cast("int")
    keys = (F.col(time).cast("date").alias("day"), second.alias("second"))
    counts = stored(timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")))
    dated = counts.filter("day IS NOT NULL")
    by_day = dated.groupBy("day").agg(F.sum("rows").alias("rows")).withColumn("day", F.col("day").cast("string"))
    # One row a day in this sum, at most one a second of a day in the next.
    days = by_day.withColumn("place", F.expr("unix_date(CAST(day AS DATE))"))
    bound = _bound(days, "place", n)
    if bound is None:
        rows = dated.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        known = timed.filter(F.col(time).isNotNull())
        unknown = timed.filter(F.col(time).isNull())
        found = known.unionByName(_first_of_equal_time(unknown, n - rows, ties))
    else:
        place, before, _ = bound
        day = f"date_from_unix_date({place})"
        at, within, own = _bound(dated.filter(f"day = {day}"), "second", n - before)
        start = f"CAST({day} AS TIMESTAMP_NTZ) + INTERVAL '{at}' SECOND"
        of_time = quoted(time)
        upto = timed.filter(f"{of_time} <= {start} + INTERVAL '0.999999' SECOND")
        if not is_typed(raw.select(quoted(source.time_col)).schema[0].dataType):
            upto = stored(upto)  # read as text once, and not for each of what follows
        if own == n - before - within:
            found = upto
        else:
            hot = upto.filter(f"{of_time} >= {start}")
            earlier = upto.filter(f"{of_time} < {start}")
            found = earlier.unionByName(_first_of_equal_time(hot, n - before - within, order))
    return found.orderBy(*order).select(*columns)
