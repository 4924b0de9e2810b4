"""Exact Jaccard join of documents by their word n-grams, and its groups.

1. Each document becomes the set of its distinct n-grams. Equal sets count once:
   everything below works on distinct sets, so exact copies cost nothing more.
2. An index from n-gram to sets is built in packed blocks. N-grams of one set only
   cannot link anything and end there; the others go back to their sets with the
   number of sets that have them.
3. With n-grams ordered from rare to frequent, two sets that link share one of their
   first few. A set whose first ones are all its own links with nothing. The others
   enter the index lists of their first n-grams, with their positions.
4. Set relations: the sets of a list are first compared with the list's head only, the
   most central set of its largest group, until that joins no more groups: one set's
   answers stand for its group. Then each list is cut into blocks by size and position,
   and a set outside the largest group is joined to those blocks whose bounds allow a
   link; the other blocks are skipped. Of the joined pairs those in one group, or too
   far apart by position, size or bitmap, are dropped. From a head's answers follow
   bounds for the sets that are like it: some pairs are sure to link, others sure not to.
   Only the rest is compared, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.components import components
from blotter.llm.frames import give_back, stored, text_of, unused
from blotter.llm.words import (
    LOWER,
    SPACED,
    blocks,
    mixed,
    segment_hashes,
    window_hashes,
    words_of,
)

WIDTH = 5
PERCENT = 75
#: N-grams that a task holds before it hands on its blocks.
FLUSH = 1_000_000
#: Texts that a task works on at once.
ROWS = 1000
#: Length of a set's bitmap, by which most pairs that cannot link are told apart.
BITS = 1024
#: Sets of a block on average at most; larger blocks are dealt into parts.
PER_ROUND = 256
#: Buckets of the index at least, and the n-grams of a bucket on average at most: one task
#: holds a bucket's n-grams, so more n-grams make more buckets and not larger ones.
BUCKETS = 48
PER_BUCKET = 2_000_000


def _sets(texts: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of blocks of rows: the distinct n-gram hashes, ordered by row, and each one's row."""
    done = 0
    for block in blocks(texts):
        data = LOWER[block.data]
        words = words_of(block, SPACED[data])
        hashes = segment_hashes(data, words.starts, words.ends)
        counts = np.diff(words.firsts)
        grams = window_hashes(hashes, width)
        whole = np.flatnonzero(words.rows[: len(grams)] == words.rows[width - 1 :])
        found, rows = [grams[whole]], [words.rows[whole]]
        for short in range(1, width):
            few = np.flatnonzero(counts == short)
            if len(few):
                first = words.firsts[few]
                found.append(window_hashes(hashes, short)[first])
                rows.append(few)
        h, r = np.concatenate(found), np.concatenate(rows)
        order = np.lexsort((h, r))
        h, r = h[order], r[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        yield h[new], r[new] + done
        done += block.rows


def _described(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Set sizes and keys by row (key 0 for no set), and the sets' n-grams with their rows."""
    n = len(texts)
    parts = list(_sets(texts, width)) if n else []
    h = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
    r = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    sizes = np.bincount(r, minlength=n)
    keys = np.zeros(n, np.uint64)
    full = sizes > 0
    firsts = (np.cumsum(sizes) - sizes)[full]
    if len(firsts):
        sums = np.add.reduceat(mixed(h), firsts)
        folds = np.bitwise_xor.reduceat(h * np.uint64(0xD6E8FEB86659FD93), firsts)
        keys[full] = mixed(mixed(sums) + folds + sizes[full].astype(np.uint64)) | np.uint64(1)
    return sizes, keys, h, r


def set_of(text: Column, width: int = WIDTH) -> Column:
    """Struct of a text's number of distinct n-grams and the key of the set, null for no set."""

    kind = pa.struct([("n", pa.int64()), ("key", pa.int64())])

    @F.arrow_udf("struct<n: bigint, key: bigint>")
    def describe(texts: pa.Array) -> pa.Array:
        parts = []
        for start in range(0, len(texts), ROWS):
            sizes, keys, _, _ = _described(texts.slice(start, ROWS), width)
            key = pa.array(keys.view(np.int64), pa.int64(), mask=sizes == 0)
            parts.append(
                pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), key], names=["n", "key"])
            )
        give_back()
        return pa.concat_arrays(parts or [pa.array([], kind)])

    return describe.asNondeterministic()(text)


_PACKED = pa.schema(
    [("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("grams", pa.binary())]
)


def _runs(counts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the entries of the chosen runs, where run k has counts[k] entries."""
    firsts = np.cumsum(counts) - counts
    sizes = counts[chosen]
    shift = firsts[chosen] - (np.cumsum(sizes) - sizes)
    return np.arange(sizes.sum()) + np.repeat(shift, sizes)


def _buckets(grams: int) -> int:
    """Buckets for so many n-grams; their number is kept in 16 bits."""
    return min(max(-(-grams // PER_BUCKET), BUCKETS), 65_536)


def _index(texts: DataFrame, width: int, buckets: int) -> DataFrame:
    """Blocks of the sets by bucket of the n-gram: keys and sizes of sets, and their n-grams.

    N-grams are kept as 48 bits beside their bucket. A set is written once per task.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flushed() -> Iterator[pa.RecordBatch]:
            grams = np.concatenate([x[0] for x in held])
            keys = np.concatenate([x[1] for x in held])
            sizes = np.concatenate([x[2] for x in held])
            bucket = (grams & np.uint64(0xFFFF)) % np.uint64(buckets)
            order = np.argsort(bucket.astype(np.uint16), kind="stable")
            grams, keys, sizes, bucket = grams[order], keys[order], sizes[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            made = []
            for b in range(buckets):
                lo, hi = cuts[b], cuts[b + 1]
                if lo == hi:
                    continue
                own = keys[lo:hi]
                firsts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                counts = np.diff(np.append(firsts, hi - lo))
                made.append(
                    _block(b, own[firsts], sizes[lo:hi][firsts], counts, grams[lo:hi] >> np.uint64(16))
                )
            yield from pa.Table.from_batches(made, _PACKED).combine_chunks().to_batches()

        count = 0
        for texts in (b["text"].slice(k, ROWS) for b in batches for k in range(0, len(b), ROWS)):
            sizes, keys, h, r = _described(texts, width)
            new = np.zeros(len(keys), bool)
            for k, key in enumerate(keys.tolist()):
                if key and key not in seen:
                    seen.add(key)
                    new[k] = True
            keep = new[r]
            h, r = h[keep], r[keep]
            held.append((h, keys[r], sizes[r].astype(np.uint32)))
            count += len(h)
            if count >= FLUSH:
                yield from flushed()
                held, count = [], 0
        if count:
            yield from flushed()
            held = []
        give_back()

    kind = "bucket int, keys binary, counts binary, grams binary"
    return texts.mapInArrow(packed, kind)


def _block(bucket: int, keys, sizes, counts, grams, more: bytes = b"") -> pa.RecordBatch:
    low = (grams & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
    high = (grams >> np.uint64(32)).astype("<u2").tobytes()
    sized = np.stack([sizes.astype("<u4"), counts.astype("<u4")]).tobytes()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([bucket], pa.int32()),
            pa.array([keys.astype("<u8").tobytes()], pa.binary()),
            pa.array([sized], pa.binary()),
            pa.array([low + high + more], pa.binary()),
        ],
        schema=_PACKED,
    )


def _unblock(keys: bytes, counts: bytes, grams: bytes, wide: int = 6):
    """Keys, set sizes, run lengths, n-grams, and the 16-bit frequencies if wide is 8."""
    k = np.frombuffer(keys, "<u8")
    sizes, runs = np.frombuffer(counts, "<u4").reshape(2, -1).astype(np.int64)
    m = len(grams) // wide
    low = np.frombuffer(grams, "<u4", m)
    high = np.frombuffer(grams, "<u2", m, 4 * m)
    found = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
    freq = np.frombuffer(grams, "<u2", m, 6 * m) if wide == 8 else None
    return k, sizes, runs, found, freq


def _shared(index: DataFrame, buckets: int) -> DataFrame:
    """Blocks by bucket of the set: its n-grams that other sets have too, with frequencies."""

    def share(group: pa.Table) -> pa.Table:
        give_back()  # what the bucket before left
        parts = [
            _unblock(a.as_py(), b.as_py(), c.as_py())
            for a, b, c in zip(group["keys"], group["counts"], group["grams"])
        ]
        bucket = group["bucket"][0].as_py()
        keys, sizes, runs, grams = (np.concatenate([p[k] for p in parts]) for k in range(4))
        # Tasks may have written the same set each: one run stays.
        _, once = np.unique(keys, return_index=True)
        grams = grams[_runs(runs, once)]
        keys, sizes, runs = keys[once], sizes[once], runs[once]
        ordered = np.sort(grams)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        common, more = np.unique(twice, return_counts=True)
        if not len(common):
            return _PACKED.empty_table()
        place = np.minimum(np.searchsorted(common, grams), len(common) - 1)
        kept = common[place] == grams
        owner = np.repeat(np.arange(len(keys)), runs)[kept]
        freq = np.minimum(more[place[kept]] + 1, 65_535).astype("<u2")
        grams = grams[kept] | (np.uint64(bucket) << np.uint64(48))
        out = []
        target = (mixed(keys) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(target[owner], kind="stable")
        owner, freq, grams = owner[order], freq[order], grams[order]
        cuts = np.searchsorted(target[owner], np.arange(buckets + 1))
        for t in range(buckets):
            lo, hi = cuts[t], cuts[t + 1]
            if lo == hi:
                continue
            own = owner[lo:hi]
            firsts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            counts = np.diff(np.append(firsts, hi - lo))
            who = own[firsts]
            high = np.full(1, bucket, "<u4").tobytes()
            out.append(
                _block(t, keys[who], sizes[who], counts, grams[lo:hi], freq[lo:hi].tobytes() + high)
            )
        return pa.Table.from_batches(out, _PACKED)

    kind = "bucket int, keys binary, counts binary, grams binary"
    return index.groupBy("bucket").applyInArrow(share, kind)


def _core(shared: DataFrame, percent: int) -> DataFrame:
    """The sets that may link: key, n, their shared n-grams, and the index entries.

    `grams` has the `shared` n-grams as sorted 64-bit integers, `bits` a bitmap of them.
    `first` has those among the set's first n-grams from rare to frequent, `at` the
    position of the first of them.
    """

    def choose(group: pa.Table) -> pa.Table:
        give_back()  # what the bucket before left
        keys, sizes, runs, grams, freqs = [], [], [], [], []
        for a, b, c in zip(group["keys"], group["counts"], group["grams"]):
            content = c.as_py()
            source = int.from_bytes(content[-4:], "little")
            k, n, run, found, freq = _unblock(a.as_py(), b.as_py(), content[:-4], 8)
            keys.append(k)
            sizes.append(n)
            runs.append(run)
            grams.append(found | (np.uint64(source) << np.uint64(48)))
            freqs.append(freq)
        key = np.repeat(np.concatenate(keys), np.concatenate(runs))
        size = np.repeat(np.concatenate(sizes), np.concatenate(runs))
        gram, freq = np.concatenate(grams), np.concatenate(freqs)
        order = np.lexsort((gram, freq, key))
        key, size, gram = key[order], size[order], gram[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(starts[1:], len(key))
        n = size[starts]
        alone = n - (ends - starts)
        first = n + (-percent * n // 100) + 1  # n - ceil(n * percent / 100) + 1
        rows = np.flatnonzero(alone < first)
        bit = mixed(gram) % np.uint64(BITS)
        word, flag = (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))
        bits = np.zeros((len(starts), BITS // 64), np.uint64)
        np.bitwise_or.at(bits, (np.repeat(np.arange(len(starts)), ends - starts), word), flag)
        return pa.table(
            {
                "key": pa.array(key[starts][rows].view(np.int64), pa.int64()),
                "n": pa.array(n[rows], pa.int64()),
                "grams": pa.array(
                    [np.sort(gram[starts[k] : ends[k]]).tobytes() for k in rows], pa.binary()
                ),
                "first": pa.array(
                    [
                        gram[starts[k] : min(ends[k], starts[k] + first[k] - alone[k])].view(np.int64)
                        for k in rows
                    ],
                    pa.list_(pa.int64()),
                ),
                "at": pa.array(alone[rows], pa.int64()),
                "shared": pa.array((ends - starts)[rows], pa.int64()),
                "bits": pa.array(list(bits[rows].view(np.int64)), pa.list_(pa.int64())),
            }
        )

    kind = (
        "key bigint, n bigint, grams binary, first array<bigint>, at bigint, shared bigint,"
        " bits array<bigint>"
    )
    return shared.groupBy("bucket").applyInArrow(choose, kind)


def _overlaps(pairs: DataFrame, core: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of the sets and of their intersection."""

    @F.arrow_udf("bigint")
    def common(x: pa.Array, y: pa.Array) -> pa.Array:
        out = [
            len(np.intersect1d(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), True))
            for a, b in zip(x.to_pylist(), y.to_pylist())
        ]
        give_back()
        return pa.array(out, pa.int64())

    x = core.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    y = core.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    both = pairs.join(x, "a").join(y, "b")
    return both.select("a", "b", "na", "nb", common("ga", "gb").alias("both"))


def _links(percent: int) -> str:
    return f"100 * both >= {percent} * (na + nb - both)"


def _within(overlap: str, percent: int) -> str:
    """Whether sets of n and m n-grams can link if they share at most so many."""
    return f"{100 + percent} * ({overlap}) >= {percent} * (n + m)"


def _lacking(bits: list[str], others: list[str]) -> str:
    """SQL for the number of bits of one bitmap that are not in another."""
    return " + ".join(f"bit_count({a} & ~{b})" for a, b in zip(bits, others))


def _star_answers(entries: DataFrame, core: DataFrame, percent: int):
    """Compares sets with the head of each of their lists until no new link joins two groups.

    A list's head is the most central set of its largest group: the one with the least
    share of n-grams of its own. Returns the lists that still have several groups, the
    comparisons (a with head b), and edges (a, b) that connect the groups so far.
    """
    spark = core.sparkSession
    edges = spark.createDataFrame([], "a bigint, b bigint")
    answers = spark.createDataFrame([], "a bigint, b bigint, na bigint, nb bigint, both bigint")
    while True:
        group = components(edges).select(F.col("node").alias("key"), "component")
        mine = entries.join(group, "key", "left").withColumn("component", F.coalesce("component", "key"))
        central = F.max(F.struct((-F.col("alone") / F.col("n")).alias("own"), "key"))
        per_group = mine.groupBy("gram", "component").agg(F.count("*").alias("c"), central.alias("head"))
        lists = per_group.groupBy("gram").agg(
            F.count("*").alias("groups"), F.max(F.struct("c", "head", "component")).alias("t")
        ).filter("groups > 1")
        lists = lists.select("gram", F.col("t.component").alias("largest"), F.col("t.head.key").alias("head"))
        left = stored(mine.join(lists, "gram"))
        asked = left.filter("component <> largest").select(F.col("key").alias("a"), F.col("head").alias("b"))
        asked = asked.distinct().join(answers.select("a", "b"), ["a", "b"], "left_anti")
        new = stored(_overlaps(asked, core))
        found = new.filter(_links(percent)).select("a", "b")
        answers = answers.union(new)
        if found.isEmpty():
            return left.drop("head"), answers, edges
        edges = stored(group.select(F.col("key").alias("a"), F.col("component").alias("b")).union(found))
        entries = left.drop("component", "largest", "head")


def _linked(core: DataFrame, percent: int, per_block: int) -> DataFrame:
    """Links (a, b) that connect all that any links connect."""
    entries = core.select("key", "n", "at", F.posexplode("first").alias("p", "gram"))
    entries = entries.select(
        "gram", "key", "n", F.col("at").alias("alone"), (F.col("at") + F.col("p")).alias("at")
    )
    lists = entries.groupBy("gram").count().filter("count > 1").select("gram")
    left, answers, edges = _star_answers(stored(entries.join(lists, "gram")), core, percent)

    # A list's blocks hold sets of about one size and position.
    band = F.struct(
        F.floor(F.log("n") / F.log(F.lit(1.05))).alias("size"),
        F.floor(F.col("at") * 25 / F.col("n")).alias("place"),
    )
    left = left.withColumn("band", band)
    blocks = left.groupBy("gram", "band").agg(
        F.min("n").alias("least"), F.max(F.col("n") - F.col("at")).alias("reach"), F.count("*").alias("c")
    )
    blocks = stored(
        blocks.select("gram", "band", "least", "reach", F.ceil(F.col("c") / per_block).alias("parts"))
    )
    bits, other_bits = ([f"{name}{k}" for k in range(BITS // 64)] for name in ("bits", "other_bits"))
    marked = core.select("key", "shared", *[F.col("bits")[k].alias(b) for k, b in enumerate(bits)])

    # Sets outside a list's largest group are joined to the blocks that may hold a link.
    minor = left.filter("component <> largest").select(
        "gram",
        "key",
        F.col("n").alias("m"),
        F.col("at").alias("other_at"),
        F.col("component").alias("other_component"),
    )
    fits = f"{100 + percent} * least(m - other_at, reach) >= {percent} * (m + least)"
    turn = minor.join(blocks, "gram").filter(fits)
    turn = turn.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    turn = turn.join(marked, "key").select(
        "gram", "band", "part", "m", "other_at", "other_component",
        F.col("key").alias("other"),
        F.col("shared").alias("other_shared"),
        *[F.col(a).alias(b) for a, b in zip(bits, other_bits)],
    )
    dealt = left.join(blocks.select("gram", "band", "parts"), ["gram", "band"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts"))).join(marked, "key")
    # They share no more than what follows in either; than the shared n-grams less
    # those whose bit the other set lacks.
    bounds = (
        "n - at",
        "m - other_at",
        f"shared - ({_lacking(bits, other_bits)})",
        f"other_shared - ({_lacking(other_bits, bits)})",
    )
    pairs = dealt.join(turn, ["gram", "band", "part"])
    pairs = pairs.filter("component <> other_component and (component = largest or key < other)")
    for bound in bounds:
        pairs = pairs.filter(_within(bound, percent))
    pairs = pairs.select("key", "n", "other", "m").distinct()

    # Answers derived from those of a set's most similar head:
    # |x and y| is at most |head and y| + |x without head|, and at least
    # |x and head| + |head and y| - |head|.
    likeness = (F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("j")
    best = answers.filter(_links(percent)).groupBy("a").agg(F.max(F.struct(likeness, "b", "both", "nb")).alias("t"))
    best = best.select(
        F.col("a").alias("key"),
        F.col("t.b").alias("head"),
        F.col("t.both").alias("with_head"),
        F.col("t.nb").alias("n_head"),
    )
    known = answers.select(F.col("a").alias("other"), F.col("b").alias("head"), F.col("both").alias("head_other"))
    derived = pairs.join(best, "key", "left").join(known, ["other", "head"], "left")
    derived = stored(
        derived.filter(_within("least(n, m, coalesce(head_other + n - with_head, n))", percent)).select(
            F.least("key", "other").alias("a"),
            F.greatest("key", "other").alias("b"),
            F.expr(_within("coalesce(with_head + head_other - n_head, 0)", percent)).alias("sure"),
        )
    )
    sure = derived.filter("sure").select("a", "b")
    open_pairs = derived.filter("not sure").select("a", "b").distinct()
    found = _overlaps(open_pairs, core).filter(_links(percent)).select("a", "b")
    return edges.union(sure).union(found)


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    per_round: int = PER_ROUND,
) -> DataFrame:
    """Per document: id, row_key, n_shingles, and component_id.

    Words are runs of other than ASCII white space, ASCII capitals made small. A
    document's set is that of its distinct n-grams of `width` words, the whole
    sequence where it has fewer words. Documents link if they share at least
    `percent` percent of the n-grams that either has; component_id is the smallest
    id reachable by links. One row per input row: repeated rows are copies of each
    other. A null or wordless text has no n-grams and its own id as component. Null
    ids take part; they are the component's id only if all its ids are null. Other
    columns are not read. More columns: `group_key`, the same within a group and null
    without n-grams, and `row_key`, a hash of id and text.
    """
    text = text_of(text_col)
    own = F.col(f"`{id_col}`")
    rows = docs.select(own.alias("id"), F.xxhash64(own, text).alias("row_key"), set_of(text, width).alias("s"))
    rows = stored(rows.select("id", "row_key", "s.n", "s.key"))

    # With copies: each task writes a set it has.
    buckets = _buckets(rows.agg(F.sum("n")).first()[0] or 0)
    index = _index(docs.select(text.alias("text")), width, buckets)
    core = stored(_core(_shared(index, buckets), percent))
    found = components(_linked(core, percent, per_round))

    full = rows.filter("n > 0").join(found, rows["key"] == found["node"], "left")
    full = full.withColumn("label", F.coalesce("component", "key"))
    least = full.groupBy("label").agg(F.min("id").alias("component_id"))
    full = full.join(least, "label").select("id", "row_key", "n", "label", "component_id")
    empty = rows.filter("n = 0").select(
        "id", "row_key", "n", F.lit(None).cast("long").alias("label"), F.col("id").alias("component_id")
    )
    return full.unionByName(empty).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("label").alias("group_key"),
        "row_key",
    )


def one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document of each group with the smallest id, all its columns, once.

    Documents without words stay. Of rows with the same id and text one stays. In a
    group all of whose ids are null, the text's hash decides.
    """
    key = unused(docs, "_row")
    found = stored(groups(docs, id_col, text_col))
    order = F.struct(F.col(id_col).isNull().alias("no"), F.col(id_col).alias("id"), "row_key")
    full = found.filter("n_shingles > 0").groupBy("group_key").agg(F.min(order).alias("t"))
    kept = full.select("t.row_key").union(found.filter("n_shingles = 0").select("row_key"))
    kept = kept.distinct().withColumnRenamed("row_key", key)
    names = [F.col(f"`{name}`") for name in docs.columns]
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{id_col}`"), text_of(text_col)))
    place = unused(docs, "_place")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(key))
    once = keyed.join(kept, key, "left_semi").withColumn(place, rank)
    return once.filter(F.col(place) == 1).select(*names)
