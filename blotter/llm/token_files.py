"""Token ids in binary files of patched frame-of-reference blocks.

A file holds whole documents in ascending order of id. Its ids are cut into blocks
of BLOCK. A block keeps its minimum and packs the differences to it at the width
that PERCENTILE of them need; what does not fit has its high bits in a list of
exceptions. Layout, all integers little-endian:

    magic, partition, file in partition
    blocks, each: minimum u32, count u16, exceptions u16, width u8,
        packed low bits, places of exceptions u16, their high bits u32
    starts of the blocks u64
    per document: has an id u8, id i64, number of ids u64
    number of ids u64, blocks u64, documents u64, start of the indexes u64, magic

Files are written and read by Spark alone, so they can lie wherever Spark can write.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.bpe import word_encoder
from blotter.llm.frames import shared_folder, stored, text_of

MAGIC = b"PFORIDS1"
BLOCK = 1024
PERCENTILE = 90
#: Ids after which a file is closed; a longer document has a file of its own.
FILE_IDS = 2_000_000
#: Bytes of text that are encoded together.
SLICE_BYTES = 1 << 23

_HEAD = struct.Struct("<8sqq")
_BLOCK = struct.Struct("<IHHB")
_FOOT = struct.Struct("<QQQQ8s")


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of each row's values, packed, one row of bytes each.

    Eight values take `width` whole bytes, so every eighth value is written at once.
    """
    rows, count = values.shape
    if not width:
        return np.zeros((rows, 0), np.uint8)
    eights = np.zeros((rows, -(-count // 8), 8), np.uint64)
    eights.reshape(rows, -1)[:, :count] = values & np.uint32((1 << width) - 1)
    out = np.zeros((rows, eights.shape[1], width), np.uint8)
    for k in range(8):
        first, shift = divmod(k * width, 8)
        bits = eights[:, :, k] << np.uint64(shift)
        for place in range(first, (k * width + width + 7) // 8):
            out[:, :, place] |= (bits >> np.uint64(8 * (place - first))).astype(np.uint8)
    return out.reshape(rows, -1)[:, : (count * width + 7) // 8]


def _unpack(packed: np.ndarray, count: int, width: int) -> np.ndarray:
    rows = len(packed)
    if not width:
        return np.zeros((rows, count), np.uint32)
    eights = np.zeros((rows, -(-count // 8), width), np.uint8)
    eights.reshape(rows, -1)[:, : packed.shape[1]] = packed
    out = np.zeros((rows, eights.shape[1], 8), np.uint32)
    for k in range(8):
        first, shift = divmod(k * width, 8)
        bits = np.zeros(eights.shape[:2], np.uint64)
        for place in range(first, (k * width + width + 7) // 8):
            bits |= eights[:, :, place].astype(np.uint64) << np.uint64(8 * (place - first))
        out[:, :, k] = (bits >> np.uint64(shift)) & np.uint64((1 << width) - 1)
    return out.reshape(rows, -1)[:, :count]


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The blocks of a run of ids."""
    n = len(ids)
    whole = n // BLOCK
    groups = [ids[: whole * BLOCK].reshape(whole, BLOCK)] if whole else []
    if n % BLOCK:
        groups.append(ids[whole * BLOCK :].reshape(1, -1))
    out: list[bytes] = []
    for rows in groups:
        count = rows.shape[1]
        lowest = rows.min(axis=1)
        over = rows - lowest[:, None]
        place = min(count - 1, count * PERCENTILE // 100)
        bound = np.partition(over, place, axis=1)[:, place]
        widths = np.ceil(np.log2(bound.astype(np.float64) + 1)).astype(np.int64)
        made: list[bytes] = [b""] * len(rows)
        for width in np.unique(widths).tolist():
            chosen = np.flatnonzero(widths == width)
            packed = _pack(over[chosen], width)
            high = over[chosen].astype(np.uint64) >> np.uint64(width)
            for row, body, rest in zip(chosen.tolist(), packed, high):
                odd = np.flatnonzero(rest)
                made[row] = b"".join(
                    (
                        _BLOCK.pack(int(lowest[row]), count, len(odd), width),
                        body.tobytes(),
                        odd.astype("<u2").tobytes(),
                        rest[odd].astype("<u4").tobytes(),
                    )
                )
        out += made
    return out


def decode_blocks(data: memoryview, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at `starts`."""
    heads = [_BLOCK.unpack_from(data, start) for start in starts.tolist()]
    out = np.zeros(sum(head[1] for head in heads), np.uint32)
    places = np.cumsum([0] + [head[1] for head in heads])
    alike: dict[tuple[int, int], list[int]] = {}
    for k, head in enumerate(heads):
        alike.setdefault((head[1], head[3]), []).append(k)
    raw = np.frombuffer(data, np.uint8)
    for (count, width), members in alike.items():
        size = (count * width + 7) // 8
        begin = starts[members] + _BLOCK.size
        packed = raw[begin[:, None] + np.arange(size)]
        values = _unpack(packed, count, width)
        for k, row, at in zip(members, values, (begin + size).tolist()):
            lowest, _, odd, _ = heads[k]
            if odd:
                where = np.frombuffer(data, "<u2", odd, at)
                high = np.frombuffer(data, "<u4", odd, at + 2 * odd)
                row[where] |= (high.astype(np.uint64) << np.uint64(width)).astype(np.uint32)
            out[places[k] : places[k] + count] = row + np.uint32(lowest)
    return out


def file_bytes(partition: int, number: int, docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    """A file of the documents' ids."""
    ids = np.concatenate([own for _, own in docs]).astype(np.uint32)
    blocks = encode_blocks(ids)
    head = _HEAD.pack(MAGIC, partition, number)
    ends = len(head) + np.cumsum([0] + [len(block) for block in blocks])
    has = np.array([name is not None for name, _ in docs], np.uint8)
    names = np.array([name or 0 for name, _ in docs], "<i8")
    sizes = np.array([len(own) for _, own in docs], "<u8")
    return b"".join(
        (
            head,
            *blocks,
            ends[:-1].astype("<u8").tobytes(),
            has.tobytes(),
            names.tobytes(),
            sizes.tobytes(),
            _FOOT.pack(len(ids), len(blocks), len(docs), int(ends[-1]), MAGIC),
        )
    )


def file_docs(content: bytes) -> tuple[int, int, list[int | None], np.ndarray, np.ndarray]:
    """Partition, file in partition, document ids, their numbers of ids, and all ids of a file."""
    data = memoryview(content)[: content.rindex(MAGIC) + len(MAGIC)]
    magic, partition, number = _HEAD.unpack_from(data, 0)
    total, blocks, docs, index, end = _FOOT.unpack_from(data, len(data) - _FOOT.size)
    if magic != MAGIC or end != MAGIC:
        raise ValueError("not a file of token ids")
    starts = np.frombuffer(data, "<u8", blocks, index).astype(np.int64)
    has = np.frombuffer(data, np.uint8, docs, index + 8 * blocks)
    names = np.frombuffer(data, "<i8", docs, index + 8 * blocks + docs)
    sizes = np.frombuffer(data, "<u8", docs, index + 8 * blocks + 9 * docs).astype(np.int64)
    ids = decode_blocks(data, starts)
    if len(ids) != total or sizes.sum() != total:
        raise ValueError("a file of token ids is damaged")
    return partition, number, [n if h else None for n, h in zip(names.tolist(), has)], sizes, ids


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows, together up to SLICE_BYTES of text, so that few are Python objects at once."""
    ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(), dtype=np.int64)
    start = before = 0
    while start < len(batch):
        end = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(start, end - start)
        start, before = end, ends[end - 1]


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Writes the ids of every document's whole text, each ended by `end_id`.

    Documents are dealt out by ranges of their id and sorted, so the files in order
    of partition and number hold them in ascending order; null ids come first, and
    equal ids in order of a hash of their text, repeated rows included. A null text
    counts as empty and has the end id alone. Other columns are not read.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").asc_nulls_first(), F.col("tie")]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        coder = word_encoder(tokenizer)
        waiting: list[tuple[int | None, np.ndarray]] = []
        held = 0

        def closed() -> pa.RecordBatch:
            content = file_bytes(partition, number, waiting)
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            for rows in _slices(batch):
                some = coder.encode(rows["text"].to_pylist())
                for name, ids in zip(rows["id"].to_pylist(), some):
                    own = np.frombuffer(ids + end, "<u4")
                    if waiting and held + len(own) > FILE_IDS:
                        yield closed()
                        waiting, held, number = [], 0, number + 1
                    waiting.append((name, own))
                    held += len(own)
        if waiting:
            yield closed()

    made = ranged.select("id", "text").mapInArrow(files, "content binary")
    # The text writer puts the bytes down as they are, one row a file.
    raw = made.select(F.col("content").cast("string"))
    raw.write.option("maxRecordsPerFile", 1).text(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a folder of files, with its ids and where they begin.

    Columns: doc_id, start (ids of all documents before it), ids (binary).
    """
    return _with_starts(_read(spark, folder, "ids binary", lambda own: own.tobytes()), "ids")


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """As `read`, with the unsigned CRC-32 of the ids' bytes in place of the ids."""
    return _with_starts(
        _read(spark, folder, "ids_crc32 bigint", lambda own: zlib.crc32(own.tobytes())), "ids_crc32"
    )


def _read(spark: SparkSession, folder: str, column: str, of_ids) -> DataFrame:
    name, kind = column.split()
    arrow = {"binary": pa.binary(), "bigint": pa.int64()}[kind]

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                content = content.as_py()
                if MAGIC not in content:  # the empty file of an empty frame
                    continue
                partition, number, names, sizes, ids = file_docs(content)
                ids = ids.astype("<u4")
                ends = np.cumsum(sizes)
                own = [of_ids(ids[e - s : e]) for s, e in zip(sizes.tolist(), ends.tolist())]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([partition] * n, pa.int64()),
                        pa.array([number] * n, pa.int64()),
                        pa.array(names, pa.int64()),
                        pa.array(ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(own, arrow),
                    ],
                    ["part", "file", "doc_id", "inside", "n_tokens", name],
                )

    files = spark.read.format("binaryFile").load(folder).select("content")
    kept = f"part bigint, file bigint, doc_id bigint, inside bigint, n_tokens bigint, {column}"
    return files.mapInArrow(docs, kept)


def _with_starts(rows: DataFrame, column: str) -> DataFrame:
    """Adds up the ids of earlier files: over the files of a partition, and over the partitions."""
    rows = stored(rows)
    sizes = rows.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    in_part = F.sum("n").over(Window.partitionBy("part").orderBy("file").rowsBetween(*_BEFORE))
    sizes = sizes.withColumn("in_part", F.coalesce(in_part, F.lit(0)))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    # One row per partition of the write.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(*_BEFORE))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    starts = sizes.join(parts, "part").select("part", "file", F.expr("before + in_part AS base"))
    joined = rows.join(starts, ["part", "file"])
    return joined.select(
        "doc_id", F.expr("base + inside").cast("long").alias("start"), "n_tokens", column
    )


_BEFORE = (Window.unboundedPreceding, -1)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own name in the cluster's shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
