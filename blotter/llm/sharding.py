"""Shards of equal row counts that keep linked documents together.

Balanced label propagation. Every row has a shard as its label. In each round the
rows of a group (documents with links to each other) move towards the shards where
most of the group is, as far as these have room; a shard's room is its exact quota of
rows. Rounds go on until no row moves. Groups that are then still split and no larger
than a shard move whole to any shard with room. Rows without links have no preference:
they fill what is left.

Rows of one group in one shard are interchangeable, so the rounds work on cells
(group, shard, number of rows). Row numbers come in at the end, by sums over hash
buckets, and no step needs a whole group or shard in one task.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.frames import running_total, stored, text_of

SHARDS = 40

_GROUP = ["group", "text_crc32", "size"]


def _by_shard(values: dict[int, int], shards: int) -> Column:
    """The value of each shard as an array."""
    return F.array(*[F.lit(values.get(k, 0)).cast("long") for k in range(shards)])


def _round(cells: DataFrame, quota: dict[int, int], used: dict[int, int], shards: int) -> DataFrame:
    """Moves of (group, shard, target, rows) that keep every shard within its quota.

    Homes stay where they are and rows only join cells with room, so each move adds to
    the sum of the cells' squares: a whole cell always, a part of one because its home
    has as many rows or more. Rounds without a limit therefore end.
    """
    room = {k: quota[k] - used.get(k, 0) for k in range(shards)}
    free = F.element_at(_by_shard(room, shards), F.col("shard") + 1)
    cells = cells.withColumn("free", free)
    by_group = Window.partitionBy(*_GROUP)
    others = F.sum("rows").over(by_group) - F.col("rows")
    cells = cells.withColumn("holds", (F.col("free") > 0) & (F.col("free") >= others))
    open_rows = F.sum(F.when(F.col("free") > 0, F.col("rows"))).over(by_group)
    # As many homes as the group's rows outside full shards would fill.
    least = max(1, min(quota.values()))
    homes = F.ceil(F.coalesce(open_rows, F.lit(0)) / F.lit(least))
    # Shards that can take the whole group come first; ties spread over the shards.
    rank = F.row_number().over(
        by_group.orderBy(
            (F.col("free") > 0).desc(),
            F.col("holds").desc(),
            F.col("rows").desc(),
            F.xxhash64(*_GROUP, "shard"),
            F.col("shard"),
        )
    )
    ranked = cells.withColumn("homes", homes).withColumn("rank", rank)
    home = F.when((F.col("free") > 0) & (F.col("rank") <= F.col("homes")), F.struct("rank", "shard", "rows"))
    # At most one entry per shard.
    listed = F.sort_array(F.collect_list(home).over(by_group))
    asked = ranked.withColumn("home", listed).filter("size(home) > 0")
    chosen = F.expr("home[CAST(pmod(shard, size(home)) AS INT)]")
    asked = asked.withColumn("to", chosen)
    asked = asked.filter("to.shard <> shard AND (free <= 0 OR rank > homes)")
    space = F.element_at(_by_shard(room, shards), F.col("target") + 1)
    asked = asked.select(
        *_GROUP, "shard", F.col("to.shard").alias("target"), "rows", (F.col("to.rows") < F.col("rows")).alias("entire")
    ).filter(~F.col("entire") | (F.col("rows") <= space))
    ahead = running_total(asked, ["target"], [*_GROUP, "shard"], F.col("rows"), "ahead")
    moved = F.least("rows", F.greatest(F.lit(0), space - F.col("ahead")))
    moved = F.when(F.col("entire") & (moved < F.col("rows")), 0).otherwise(moved)
    return ahead.withColumn("rows", moved).filter("rows > 0").drop("ahead", "entire")


def _gathered(cells: DataFrame, sizes: DataFrame, quota: dict[int, int], shards: int) -> DataFrame:
    """The cells after groups that are still split, but no larger than a shard, moved to any room.

    These groups are laid one after the other over the room they leave. Those across the
    end of a shard, fewer than there are shards, are put where they fit on the driver, and
    over as few shards as possible if they fit nowhere.
    """
    labels = cells.groupBy(*_GROUP).agg(F.count("*").alias("cells"), F.sum("rows").alias("labelled"))
    split = sizes.join(labels, _GROUP, "left").filter(F.col("of_group") <= max(quota.values()))
    split = split.filter("cells IS NULL OR cells > 1 OR labelled < of_group")
    split = stored(split.select(*_GROUP, F.col("of_group").alias("rows")))
    if split.isEmpty():
        return cells
    kept = cells.join(split, _GROUP, "left_anti").select(*_GROUP, "shard", "rows")
    used = _totals(kept)
    room = {k: quota[k] - used.get(k, 0) for k in range(shards)}
    bounds = F.array(*[F.lit(sum(room[j] for j in range(k + 1))).cast("long") for k in range(shards)])
    laid = running_total(split, [], _GROUP, F.col("rows"), "ahead")
    shard = F.size(F.filter(bounds, lambda bound: bound <= F.col("ahead"))).cast("int")
    laid = laid.withColumn("shard", shard)
    fits = F.col("ahead") + F.col("rows") <= F.element_at(bounds, F.col("shard") + 1)
    laid = stored(laid.select(*_GROUP, "shard", "rows", fits.alias("fits")))
    whole = laid.filter("fits").drop("fits")
    for k, rows in _totals(whole).items():
        room[k] -= rows
    across = []
    for row in laid.filter("NOT fits").orderBy(F.col("rows").desc(), *_GROUP).collect():
        left = row["rows"]
        while left:
            # The tightest shard that holds the rest, else the one with the most room.
            k = min(room, key=lambda k: (room[k] < left, room[k] if room[k] >= left else -room[k], k))
            part = min(left, room[k])
            across.append((*(row[name] for name in _GROUP), k, part))
            room[k] -= part
            left -= part
    moved = kept.unionByName(whole)
    if across:
        moved = moved.unionByName(cells.sparkSession.createDataFrame(across, kept.schema))
    return stored(moved)


def propagated(
    docs: DataFrame,
    shards: int = SHARDS,
    rounds: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: id, size, text_crc32, law, shard, slot, grown_shard.

    Documents of equal text are linked. The law is `rows`: shards hold numbers of rows
    at most one apart. size is the UTF-8 bytes of the text plus 16, text_crc32 the
    unsigned CRC-32 of those bytes, slot the place in the shard from 0 without gaps.
    grown_shard is null under this law. A null text counts as empty, so null and empty
    texts are linked. Null ids and repeated rows are rows like others; equal rows are
    interchangeable. Other columns are not read. An empty frame gives no rows.
    Rounds go on until no row moves, or up to `rounds`.
    """
    text = text_of(text_col)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
    )
    rows = stored(rows)
    total = rows.count()
    quota = {k: total // shards + (k < total % shards) for k in range(shards)}

    sizes = rows.groupBy(*_GROUP).agg(F.count("*").alias("of_group"))
    sizes = stored(sizes.filter("of_group > 1"))
    linked = rows.join(sizes, _GROUP)
    first = F.pmod(F.xxhash64("id", "group"), F.lit(shards)).cast("int")
    cells = linked.groupBy(*_GROUP, first.alias("shard")).agg(F.count("*").alias("rows"))
    # The hash may put more rows into a shard than its quota: such rows have no label yet.
    cells = stored(_within(cells, quota, shards))
    for _ in itertools.count() if rounds is None else range(rounds):
        used = _totals(cells)
        moves = stored(_round(cells, quota, used, shards))
        if moves.isEmpty():
            break
        gone = moves.select(*_GROUP, "shard", (-F.col("rows")).alias("rows"))
        come = moves.select(*_GROUP, F.col("target").alias("shard"), "rows")
        changed = cells.select(*_GROUP, "shard", "rows").union(gone).union(come)
        changed = changed.groupBy(*_GROUP, "shard").agg(F.sum("rows").alias("rows"))
        cells = stored(changed.filter("rows > 0"))
    cells = _gathered(cells, sizes, quota, shards)

    # A group's rows in order go to its cells in order; the rest fills the shards.
    upto = F.sum("rows").over(
        Window.partitionBy(*_GROUP).orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    )
    per_group = cells.withColumn("upto", upto).groupBy(*_GROUP).agg(
        F.sort_array(F.collect_list(F.struct("upto", "shard"))).alias("cells")
    )
    used = _totals(cells)
    bounds, filled = [], 0
    for k in range(shards):
        filled += quota[k] - used.get(k, 0)
        bounds.append(F.lit(filled).cast("long"))
    numbered = running_total(linked, _GROUP, ["id"], F.lit(1), "place").join(per_group, _GROUP, "left")
    cell = F.expr("get(filter(cells, c -> c.upto > place), 0).shard")
    numbered = numbered.withColumn("shard", F.when(F.col("cells").isNotNull(), cell))
    placed = numbered.filter("shard IS NOT NULL").select("id", "size", "text_crc32", "group", "shard")
    loose = rows.join(sizes, _GROUP, "left_anti").select("id", "size", "text_crc32", "group")
    loose = loose.unionByName(
        numbered.filter("shard IS NULL").select("id", "size", "text_crc32", "group")
    )
    loose = running_total(loose, [], ["group", "text_crc32", "size", "id"], F.lit(1), "place")
    shard = F.size(F.filter(F.array(*bounds), lambda bound: bound <= F.col("place"))).cast("int")
    loose = loose.withColumn("shard", shard).drop("place")
    sharded = stored(placed.unionByName(loose))
    slots = running_total(sharded, ["shard"], ["group", "text_crc32", "size", "id"], F.lit(1), "slot")
    return slots.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _totals(cells: DataFrame) -> dict[int, int]:
    """Rows by shard: at most one row per shard comes to the driver."""
    return {r["shard"]: r["rows"] for r in cells.groupBy("shard").agg(F.sum("rows").alias("rows")).collect()}


def _within(cells: DataFrame, quota: dict[int, int], shards: int) -> DataFrame:
    """The cells cut down to the quotas of their shards."""
    ahead = running_total(cells, ["shard"], _GROUP, F.col("rows"), "ahead")
    space = F.element_at(_by_shard(quota, shards), F.col("shard") + 1)
    kept = F.least("rows", F.greatest(F.lit(0), space - F.col("ahead")))
    return ahead.withColumn("rows", kept.cast("long")).filter("rows > 0").drop("ahead")
