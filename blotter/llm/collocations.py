"""Word pairs and triples that stand together more often than their parts explain.

Words become numbers: hashes of so many bits that no two words of a language share one,
which is checked and, if need be, tried again with other hashes. An n-gram is its words'
numbers, side by side. Counting quotient filters count n-grams:

1. An invertible mixing turns the packed numbers into others that are evenly spread.
   Their highest bits name the shard, the next ones are the quotient, and all the rest is
   the remainder, kept in full. So an entry stands for one n-gram and no other.
2. Each task sorts what it has read and writes one filter a language and shard: the run
   lengths of the quotients in about two bits an entry, remainders, and counts.
3. The sorted filters of a shard are merged, equal entries summed, and those that occur
   often enough turned back into words' numbers.

A triple occurs no oftener than its pairs: triples are counted where both pairs pass a
Bloom filter of the frequent pairs. Where that would take more than FILTER_BITS, all
triples are counted.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.frames import stored, text_of
from blotter.llm.words import LOWER, Block, blocks, mixed, segment_hashes, words_of

#: Least occurrences of a candidate, the share of a longer one that hides it, and the report's length.
LEAST = 10
HIDING_PERCENT = 50
TOP = 2000
#: Characters a task reads at once, and n-grams that it holds before it writes its filters.
CHUNK = 1 << 22
FLUSH = 2_000_000
#: Occurrences of n-grams of a shard: one task merges a shard's filters of a language.
PER_SHARD = 2_000_000
#: The largest filter of frequent pairs, 8 MB, and its bits a pair at least.
FILTER_BITS = 1 << 26
BITS_A_PAIR = 4

#: Bytes that end a piece of text, and blanks between words.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANKS = np.zeros(256, bool)
_BLANKS[[0x20, 0x09]] = True


class _Read:
    """The words of a block: hashes, rows, bytes, and whether each is followed by another of its piece."""

    def __init__(self, block: Block, seed: int):
        self.data = LOWER[block.data]
        ends = _ENDS[self.data]
        words = words_of(block, ~(ends | _BLANKS[self.data]))
        self.starts, self.ends, self.rows = words.starts, words.ends, words.rows + block.first
        self.hashes = segment_hashes(self.data ^ np.uint8(seed), words.starts, words.ends)
        piece = np.cumsum(ends)[words.starts] if len(words.starts) else words.starts
        self.followed = np.zeros(len(self.rows), bool)
        self.followed[:-1] = (self.rows[1:] == self.rows[:-1]) & (piece[1:] == piece[:-1])

    def texts(self, chosen: np.ndarray) -> pa.Array:
        """The chosen words as an Arrow column."""
        sizes = self.ends[chosen] - self.starts[chosen]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(self.starts[chosen] - offsets[:-1], sizes) + np.arange(offsets[-1])
        return pa.LargeStringArray.from_buffers(
            len(chosen), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[places])
        ).cast(pa.string())


def _langs(batch: pa.RecordBatch, known: dict[str, int]) -> np.ndarray:
    """The rows' languages as numbers; new ones are added to `known`."""
    column = batch["lang"].dictionary_encode()
    own = [known.setdefault(name, len(known)) for name in column.dictionary.to_pylist()]
    return np.array(own, np.int64)[column.indices.to_numpy(zero_copy_only=False)] if len(batch) else np.zeros(0, np.int64)


def vocabulary(rows: DataFrame, seed: int = 0) -> DataFrame:
    """Per language and word of rows of (lang, text): hash and number of occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            langs = _langs(batch, known)
            names = pa.array(list(known), pa.string())
            for block in blocks(batch["text"], CHUNK):
                read = _Read(block, seed)
                if not len(read.rows):
                    continue
                lang = langs[read.rows]
                order = np.lexsort((read.hashes, lang))
                h, spoken = read.hashes[order], lang[order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (spoken[1:] != spoken[:-1])]))
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(spoken[new])),
                        read.texts(order[new]),
                        pa.array(h[new].view(np.int64)),
                        pa.array(np.diff(np.append(new, len(h)))),
                    ],
                    ["lang", "word", "hash", "f"],
                )

    found = rows.mapInArrow(count, "lang string, word string, hash bigint, f bigint")
    return found.groupBy("lang", "word", "hash").agg(F.sum("f").alias("f"))


def _numbers(hashes: np.ndarray, bits: int, salt: int) -> np.ndarray:
    return mixed(hashes ^ np.uint64(salt)) >> np.uint64(64 - bits)


def _number_of(hash_col: str, bits: int, salt: int) -> Column:
    @F.arrow_udf("bigint")
    def number(hashes: pa.Array) -> pa.Array:
        own = _numbers(hashes.to_numpy(zero_copy_only=False).view(np.uint64), bits, salt)
        return pa.array(own.view(np.int64), pa.int64())

    return number.asNondeterministic()(hash_col)


def _numbered(rows: DataFrame) -> tuple[DataFrame, int, int, int, int]:
    """The vocabulary with a number for each word, and the bits, seed and salt that give it; words in all.

    Numbers of twice the bits of the largest place in the vocabulary are distinct more
    often than not; as long as two words of a language share one, others are tried.
    """
    for seed in range(256):
        words = stored(vocabulary(rows, seed))
        size, total = words.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
        bits = min(64, max(16, -(-2 * max(size, 1).bit_length() // 8) * 8))
        for salt in range(16):
            numbered = words.withColumn("id", _number_of("hash", bits, salt))
            if numbered.groupBy("lang", "id").count().filter("count > 1").isEmpty():
                return stored(numbered.drop("hash")), bits, seed, salt, total
    raise ValueError("no hash tells the words apart")


# The mixing: each number is changed by the others in turn, so it can be undone.
def _turn(grams: list[np.ndarray], k: int, mask: np.uint64) -> None:
    others = np.full(len(grams[0]), k + 1, np.uint64)
    for j, other in enumerate(grams):
        if j != k:
            others = mixed(others + other)
    grams[k] = grams[k] ^ (others & mask)


def permuted(grams: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """N-grams as evenly spread numbers of the same bits."""
    out, mask = list(grams), np.uint64((1 << bits) - 1)
    for k in reversed(range(len(out))):
        _turn(out, k, mask)
    return out


def restored(grams: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """What `permuted` was given."""
    out, mask = list(grams), np.uint64((1 << bits) - 1)
    for k in range(len(out)):
        _turn(out, k, mask)
    return out


def _bytes(values: np.ndarray, bits: int) -> bytes:
    wide = -(-bits // 8)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()


def _values(content: memoryview, n: int, bits: int) -> np.ndarray:
    wide = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :wide] = np.frombuffer(content, np.uint8, n * wide).reshape(n, wide)
    return out.reshape(-1).view("<u8").astype(np.uint64)


_HEAD = struct.Struct("<IIB")


def filter_bytes(grams: list[np.ndarray], counts: np.ndarray, bits: int, shard_bits: int) -> bytes:
    """A filter of sorted, distinct permuted n-grams of one shard."""
    n = len(counts)
    left = bits - shard_bits
    quotient_bits = min(left, max(1, n.bit_length()))
    rest = left - quotient_bits
    first = grams[0] & np.uint64((1 << left) - 1)
    quotient = (first >> np.uint64(rest)).astype(np.int64)
    # Run lengths: a one for each entry, a zero behind each quotient's run.
    runs = np.zeros(n + (1 << quotient_bits), np.uint8)
    runs[np.arange(n) + quotient] = 1
    high = np.flatnonzero(counts >= 255)
    return b"".join(
        [
            _HEAD.pack(n, len(high), quotient_bits),
            np.packbits(runs).tobytes(),
            _bytes(first & np.uint64((1 << rest) - 1), rest),
            *[_bytes(other, bits) for other in grams[1:]],
            np.minimum(counts, 255).astype(np.uint8).tobytes(),
            counts[high].astype("<u8").tobytes(),
        ]
    )


def filter_entries(content: bytes, n_words: int, bits: int, shard_bits: int, shard: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The permuted n-grams of a filter, sorted, and their counts."""
    n, high, quotient_bits = _HEAD.unpack_from(content)
    view, at = memoryview(content), _HEAD.size

    def take(size: int) -> memoryview:
        nonlocal at
        at += size
        return view[at - size : at]

    length = n + (1 << quotient_bits)
    runs = np.unpackbits(np.frombuffer(take(-(-length // 8)), np.uint8), count=length)
    quotient = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)
    left = bits - shard_bits
    rest = left - quotient_bits
    first = _values(take(n * -(-rest // 8)), n, rest) | (quotient << np.uint64(rest))
    grams = [first | (np.uint64(shard) << np.uint64(left))]
    grams += [_values(take(n * -(-bits // 8)), n, bits) for _ in range(n_words - 1)]
    counts = np.frombuffer(take(n), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(take(8 * high), "<u8").astype(np.int64)
    return grams, counts


def _summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted by the keys, first one first, with the counts of equal ones added up."""
    if not len(counts):
        return keys, counts
    order = np.lexsort(keys[::-1])
    keys = [key[order] for key in keys]
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    places = np.flatnonzero(new)
    return [key[places] for key in keys], np.add.reduceat(counts[order], places)


def pair_hashes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return mixed(x + mixed(y + np.uint64(1)))


def _passes(flags: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the Bloom filter of 64-bit words may hold them."""
    mask = np.uint64(len(flags) * 64 - 1)
    out = np.ones(len(hashes), bool)
    for places in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        out &= (flags[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) > 0
    return out


def _filter_of(pairs: DataFrame) -> np.ndarray | None:
    """The Bloom filter of the frequent pairs, sized by their number; none if it would be too large."""
    n = pairs.count()
    bits = 1 << max(10, (2 * BITS_A_PAIR * n - 1).bit_length())
    if bits > FILTER_BITS:
        bits //= 2
    if bits > FILTER_BITS:
        return None

    @F.arrow_udf("bigint")
    def hashed(x: pa.Array, y: pa.Array) -> pa.Array:
        own = [a.to_numpy(zero_copy_only=False).view(np.uint64) for a in (x, y)]
        return pa.array(pair_hashes(*own).view(np.int64), pa.int64())

    places = pairs.select(hashed.asNondeterministic()("w1", "w2").alias("h")).select(
        F.explode(F.array(F.expr(f"h & {bits - 1}"), F.expr(f"shiftright(h, 32) & {bits - 1}"))).alias("bit")
    )
    slots = places.groupBy(F.expr("shiftright(bit, 6)").alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("flags")
    ).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[slots["slot"].to_numpy()] = slots["flags"].to_numpy()
    return out.view(np.uint64)


def counted(
    rows: DataFrame,
    width: int,
    hashing: tuple[int, int, int],
    total: int,
    least: int,
    flags: np.ndarray | None = None,
) -> DataFrame:
    """N-grams of `width` words with at least so many occurrences: lang, w1, w2, ..., f.

    `hashing` is bits, seed and salt of the words' numbers, `total` an upper bound of the
    n-grams. With `flags`, a Bloom filter of pairs, only n-grams all of whose pairs it
    may hold.
    """
    bits, seed, salt = hashing
    shard_bits = min(bits - 2, max(0, (-(-total // PER_SHARD) - 1).bit_length()))
    names = [f"w{k + 1}" for k in range(width)]
    shared = rows.sparkSession.sparkContext.broadcast(flags) if flags is not None else None

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        held: list[list[np.ndarray]] = []
        count = 0

        def flushed() -> pa.RecordBatch:
            parts = [np.concatenate(column) for column in zip(*held)]
            keys, n = _summed(parts, np.ones(len(parts[0]), np.int64))
            lang, first = keys[0].astype(np.int64), keys[1]
            shard = (first >> np.uint64(bits - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(n), np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], (lang[1:] != lang[:-1]) | (shard[1:] != shard[:-1])]))
            ends = np.append(cuts[1:], len(n))
            spoken = list(known)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([spoken[k] for k in lang[cuts]], pa.string()),
                    pa.array(shard[cuts]),
                    pa.array(
                        [filter_bytes([k[a:b] for k in keys[1:]], n[a:b], bits, shard_bits) for a, b in zip(cuts, ends)],
                        pa.binary(),
                    ),
                ],
                ["lang", "shard", "filter"],
            )

        for batch in batches:
            langs = _langs(batch, known).astype(np.uint64)
            for block in blocks(batch["text"], CHUNK):
                read = _Read(block, seed)
                whole = read.followed.copy()
                for k in range(1, width - 1):
                    whole[:-k] &= read.followed[k:]
                    whole[-k:] = False
                ids = _numbers(read.hashes, bits, salt)
                if shared is not None and len(ids):
                    near = np.zeros(len(ids), bool)
                    near[:-1] = _passes(shared.value, pair_hashes(ids[:-1], ids[1:]))
                    for k in range(width - 1):
                        whole[: len(whole) - k] &= near[k:]
                at = np.flatnonzero(whole)
                held.append([langs[read.rows[at]], *permuted([ids[at + k] for k in range(width)], bits)])
                count += len(at)
                if count >= FLUSH:
                    yield flushed()
                    held, count = [], 0
        if count:
            yield flushed()

    def merge(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        parts = [filter_entries(one.as_py(), width, bits, shard_bits, shard) for one in group["filter"]]
        keys = [np.concatenate([part[0][k] for part in parts]) for k in range(width)]
        keys, n = _summed(keys, np.concatenate([part[1] for part in parts]))
        often = n >= least
        ids = restored([key[often] for key in keys], bits)
        return pa.table(
            {
                "lang": pa.array([group["lang"][0].as_py()] * int(often.sum()), pa.string()),
                **{name: pa.array(own.view(np.int64), pa.int64()) for name, own in zip(names, ids)},
                "f": pa.array(n[often], pa.int64()),
            }
        )

    filters = rows.mapInArrow(build, "lang string, shard bigint, filter binary")
    kind = f"lang string, {', '.join(f'{name} bigint' for name in names)}, f bigint"
    return filters.groupBy("lang", "shard").applyInArrow(merge, kind)


def _score(whole: str, left: str, right: str) -> Column:
    """floor(1000000 * whole^2 / (left * right)), exact: products have up to 38 digits."""
    number = "CAST({} AS DECIMAL(19, 0))"
    square = f"{number.format(whole)} * {number.format(whole)} * CAST(1000000 AS DECIMAL(7, 0))"
    return F.expr(f"CAST({square} DIV ({number.format(left)} * {number.format(right)}) AS BIGINT)")


def candidates(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """Phrases of rows of (lang, text): lang, phrase, a, l, r, n, score, before the report's cut."""
    words, *hashing, total = _numbered(rows)
    sums = words.groupBy("lang").agg(F.sum("f").alias("n"))
    pairs = stored(counted(rows, 2, tuple(hashing), total, least))
    triples = stored(counted(rows, 3, tuple(hashing), total, least, _filter_of(pairs)))

    def word(place: int) -> DataFrame:
        return words.filter(F.col("f") >= least).select(
            "lang", F.col("id").alias(f"w{place}"), F.col("word").alias(f"t{place}"), F.col("f").alias(f"f{place}")
        )

    # Pairs that a triple hides.
    hiding = triples.select("lang", "w1", "w2", "f").union(triples.select("lang", "w2", "w3", "f"))
    hiding = hiding.groupBy("lang", "w1", "w2").agg(F.max("f").alias("longer"))
    two = pairs.join(hiding, ["lang", "w1", "w2"], "left")
    two = two.filter(F.coalesce(100 * F.col("longer") < HIDING_PERCENT * F.col("f"), F.lit(True)))
    two = two.join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"])
    two = two.select(
        "lang",
        F.concat_ws(" ", "t1", "t2").alias("phrase"),
        F.col("f").alias("a"),
        F.col("f1").alias("l"),
        F.col("f2").alias("r"),
        _score("f", "f1", "f2").alias("score"),
    )
    head = pairs.withColumnRenamed("f", "f12")
    tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23"))
    three = triples.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
    three = three.join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"]).join(word(3), ["lang", "w3"])
    three = three.withColumn("s1", _score("f", "f1", "f23")).withColumn("s2", _score("f", "f12", "f3"))
    later = F.col("s2") < F.col("s1")
    three = three.select(
        "lang",
        F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"),
        F.col("f").alias("a"),
        F.when(later, F.col("f12")).otherwise(F.col("f1")).alias("l"),
        F.when(later, F.col("f3")).otherwise(F.col("f23")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    return two.union(three).join(sums, "lang")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are made small in A-Z and cut at `[.,;:!?\\x0A-\\x0D]` into pieces, those into words
    `[^\\x20\\x09]+`. A candidate is a phrase of two or three words with a >= `least`
    occurrences within pieces. l and r are the occurrences of its two parts at the cut
    that scores lowest (the first such one), n those of all words of the language. A
    candidate that a longer one with at least HIDING_PERCENT of its occurrences contains
    is left out. Ranks are by score, a (both descending) and phrase. Null texts count as
    empty, null languages as `und`; repeated rows count as often as they are there; empty
    tables give no rows. Other columns are not read.
    """
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), text_of(text_col).alias("text"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = candidates(rows, least).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
