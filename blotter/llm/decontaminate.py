"""Documents that contain passages of benchmark items.

A prefix-filtered set join. An item is cut into windows of WINDOW words, and a
window into shingles. A document that holds a window holds all its shingles, so one
of them, the rarest in the corpus, is the necessary prefix the join works on:

1. One pass over the documents keeps the runs of words whose shingles pass a Bloom
   filter of the items' shingles. The filter has a fixed size; what it lets through
   in error is found out below.
2. Shingles are counted over those runs. A window with a shingle that occurs nowhere
   is dropped; the others join by their rarest shingle.
3. The shingle's place in the window and in the run fixes where the window would
   begin. It must fit into the run, and its words must be the run's, word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.frames import give_back, stored, text_of, unused
from blotter.llm.words import LOWER, PLAIN, Block, Words, blocks, segment_hashes, window_hashes, words_of

WINDOW = 10
SHINGLE = 5
#: Bits of the Bloom filter, 1 MB whatever the number of items.
FILTER_BITS = 1 << 23


def _words(block: Block) -> tuple[np.ndarray, Words, np.ndarray]:
    data = LOWER[block.data]
    words = words_of(block, PLAIN[data])
    return data, words, segment_hashes(data, words.starts, words.ends)


def _text(data: np.ndarray, words: Words, first: int, last: int) -> str:
    base = int(words.starts[first])
    raw = data[base : int(words.ends[last - 1])].tobytes()
    spans = zip((words.starts[first:last] - base).tolist(), (words.ends[first:last] - base).tolist())
    return b" ".join([raw[a:b] for a, b in spans]).decode()


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Rows of item_id (text), window (its words), m words, shingle width, shingle hashes.

    An item of fewer than WINDOW words, but not none, is one window.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["item_id"].to_pylist()
            out: list[tuple] = []
            for block in blocks(batch["text"]):
                data, words, hashes = _words(block)
                for row in range(block.rows):
                    a, b = int(words.firsts[row]), int(words.firsts[row + 1])
                    m = min(WINDOW, b - a)
                    width = min(SHINGLE, m)
                    if not m:
                        continue
                    grams = window_hashes(hashes[a:b], width).view(np.int64).tolist()
                    for at in range(b - a - m + 1):
                        out.append(
                            (
                                ids[block.first + row],
                                _text(data, words, a + at, a + at + m),
                                m,
                                width,
                                grams[at : at + m - width + 1],
                            )
                        )
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["item_id", "window", "m", "width", "grams"],
            )

    rows = items.select(
        F.col(f"`{id_col}`").cast("string").alias("item_id"), text_of(text_col).alias("text")
    )
    kind = "item_id string, window string, m int, width int, grams array<bigint>"
    return rows.mapInArrow(cut, kind)


def _filter(found: DataFrame) -> np.ndarray:
    """The Bloom filter of all shingles, as 64-bit words. Its size is fixed."""
    grams = found.select(F.explode("grams").alias("h")).distinct()
    bits = grams.select(
        F.explode(
            F.array(
                F.expr(f"h & {FILTER_BITS - 1}"),
                F.expr(f"shiftright(h, 32) & {FILTER_BITS - 1}"),
            )
        ).alias("bit")
    )
    slots = bits.groupBy(F.expr("shiftright(bit, 6)").alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("flags")
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for slot, flags in slots.toLocalIterator():
        out[slot] = flags
    return out.view(np.uint64)


def _passes(flags: np.ndarray, grams: np.ndarray) -> np.ndarray:
    mask = np.uint64(FILTER_BITS - 1)

    def bit(places: np.ndarray) -> np.ndarray:
        return (flags[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)

    hit = bit(grams & mask).astype(bool)
    some = np.flatnonzero(hit)
    hit[some] = bit((grams[some] >> np.uint64(32)) & mask).astype(bool)
    return hit


def _scanned(column: pa.Array, flags: np.ndarray, least: dict[int, int]) -> pa.Array:
    """Per text: its number of words and the runs whose shingles all pass the filter."""
    counts: list[np.ndarray] = []
    by_row: list[list[dict]] = [[] for _ in range(len(column))]
    for block in blocks(column):
        data, words, hashes = _words(block)
        counts.append(np.diff(words.firsts))
        for width, run in least.items():
            grams = window_hashes(hashes, width)
            if not len(grams):
                continue
            hit = _passes(flags, grams) & (words.rows[: len(grams)] == words.rows[width - 1 :])
            if not hit.any():
                continue
            rows = words.rows[: len(grams)]
            before = np.zeros(len(hit), bool)
            before[1:] = hit[:-1] & (rows[1:] == rows[:-1])
            after = np.zeros(len(hit), bool)
            after[:-1] = before[1:] & hit[1:]
            starts = np.flatnonzero(hit & ~before)
            ends = np.flatnonzero(hit & ~after) + 1
            for a, b in zip(starts.tolist(), ends.tolist()):
                if b - a >= run:
                    row = int(rows[a])
                    by_row[block.first + row].append(
                        {
                            "at": a - int(words.firsts[row]),
                            "words": _text(data, words, a, b + width - 1),
                            "grams": grams[a:b].view(np.int64).tolist(),
                        }
                    )
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    kind = pa.list_(
        pa.struct([("at", pa.int64()), ("words", pa.string()), ("grams", pa.list_(pa.int64()))])
    )
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(by_row, kind)], names=["n_words", "runs"]
    )


def matches(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: id, n_words, n_hit, items, and row_key, a hash of id and text.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` with ASCII capitals made small. n_hit
    counts the words inside any occurrence of a window of any item; `items` lists the
    ids of items with such windows, as text, sorted. One row per input row, repeated
    rows included. Null or wordless texts have no words and items no windows; without
    items nothing is hit. An item without id makes hits but is not listed; items of
    one id count once. Other columns of either table are not read.
    """
    spark = docs.sparkSession
    found = stored(windows(items))
    own = F.col(f"`{id_col}`")
    text = text_of(text_col)
    least = {
        row["width"]: row["m"] - row["width"] + 1
        for row in found.groupBy("width").agg(F.min("m").alias("m")).collect()  # at most SHINGLE rows
    }
    flags = spark.sparkContext.broadcast(_filter(found))

    @F.arrow_udf(
        "struct<n_words: bigint, runs: array<struct<at: bigint, words: string, grams: array<bigint>>>>"
    )
    def scan(texts: pa.Array) -> pa.Array:
        found = _scanned(texts, flags.value, least)
        give_back()
        return found

    scanned = docs.select(
        own.alias("id"), F.xxhash64(own, text).alias("row_key"), scan.asNondeterministic()(text).alias("s")
    )
    scanned = stored(scanned.select("id", "row_key", "s.n_words", "s.runs"))

    # Repeated rows have the same runs: one of them is enough.
    runs = scanned.filter("size(runs) > 0").dropDuplicates(["row_key"])
    runs = runs.select("row_key", F.explode("runs").alias("r"))
    runs = runs.select("row_key", "r.at", F.split("r.words", " ").alias("words"), "r.grams")
    hits = runs.select("row_key", "at", "words", F.posexplode("grams").alias("p", "gram"))
    # Around each shingle, the words of all windows that can hold it.
    reach = WINDOW - 1
    hits = hits.select(
        "row_key",
        "gram",
        F.expr(f"least(p, {reach})").alias("back"),
        (F.col("at") + F.expr(f"p - least(p, {reach})")).alias("at"),
        F.expr(f"slice(words, p - least(p, {reach}) + 1, {2 * WINDOW + SHINGLE})").alias("words"),
    )

    frequency = hits.groupBy("gram").agg(F.count("*").alias("frequency"))
    once = found.groupBy("window").agg(F.first("m").alias("m"), F.first("grams").alias("grams"))
    parts = once.select("window", "m", F.posexplode("grams").alias("offset", "gram"), F.size("grams").alias("all"))
    rated = parts.join(frequency, "gram").groupBy("window", "m", "all").agg(
        F.count("*").alias("occurring"),
        F.min(F.struct("frequency", "gram", "offset")).alias("rarest"),
    )
    prefix = rated.filter(F.col("occurring") == F.col("all")).select(
        "window", "m", "rarest.gram", "rarest.offset"
    )

    placed = hits.join(prefix, "gram").withColumn("start", F.col("back") - F.col("offset"))
    placed = placed.filter("start >= 0 AND start + m <= size(words)")
    placed = placed.filter("array_join(slice(words, start + 1, m), ' ') = window")
    places = placed.select(
        "row_key", (F.col("at") + F.col("start")).alias("first"), (F.col("at") + F.expr("start + m")).alias("end"), "window"
    ).distinct()
    places = stored(places)

    earlier = Window.partitionBy("row_key").orderBy("first", "end").rowsBetween(
        Window.unboundedPreceding, -1
    )
    fresh = F.expr("greatest(0, end - greatest(first, coalesce(reached, 0)))")
    covered = (
        places.select("row_key", "first", "end").distinct()
        .withColumn("reached", F.max("end").over(earlier))
        .groupBy("row_key").agg(F.sum(fresh).alias("n_hit"))
    )
    named = found.select("window", "item_id").distinct()
    listed = places.select("row_key", "window").distinct().join(named, "window")
    listed = listed.groupBy("row_key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    hit = covered.join(listed, "row_key")
    out = scanned.select("id", "row_key", "n_words").join(hit, "row_key", "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "row_key",
    )


def clean(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without any word of a window, with all their columns."""
    key = unused(docs, "_row")
    found = matches(docs, items, id_col, text_col).filter("n_hit > 0")
    dirty = found.select(F.col("row_key").alias(key)).distinct()
    names = [F.col(f"`{name}`") for name in docs.columns]
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{id_col}`"), text_of(text_col)))
    return keyed.join(dirty, key, "left_anti").select(*names)
