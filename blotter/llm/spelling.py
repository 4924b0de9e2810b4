"""Spelling variants: words one edit apart, found by pivotal grams.

Bigrams are ordered from rare to frequent over all words. A word's prefix is its three
rarest bigrams (and those as rare as the third); its pivots are two disjoint ones of
them, the rarest such two, by dynamic programming. One edit leaves one of two disjoint
bigrams whole. So of two words one edit apart, the one whose prefix ends with the rarer
bigram has a pivot that survives in the other, and there it belongs to the prefix.

The edit lies behind the surviving bigram or before it. Behind it, the bigram stands at
the same place from the front, with the same text up to it; before it, at the same place
from the end, with the same text from there on. Pivots are joined to prefixes by that
place and text, and by the three lengths the other word can have; the pairs are verified.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.frames import stored, text_of

#: Code points and occurrences of a word at least.
SHORTEST = 5
FEWEST = 3
#: How much more frequent a form must be.
TIMES = 2
#: One in so many words of documents has a code point taken out.
DAMAGED = 97

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words and their numbers of occurrences, n.

    Maximal runs of `[A-Za-z\\u00C0-\\u00FF]`, small in A-Z; of a run for whose document the
    crc32 of `<id>:<run>` is a multiple of DAMAGED, the code point at that number modulo
    the run's length is taken out. Words are the results of SHORTEST code points with
    FEWEST occurrences. Null texts have no words; a null id counts as an empty one.
    """
    text = text_of(text_col)
    plain = F.octet_length(text) == F.length(text)
    small = F.when(plain, F.lower(text)).otherwise(F.translate(text, _CAPITALS, _CAPITALS.lower()))
    runs = F.regexp_extract_all(small, F.lit(f"[a-z\\u00C0-\\u00FF]{{{SHORTEST},}}+"), F.lit(0))
    own = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    each = docs.select(own.alias("id"), F.explode(runs).alias("run"))
    each = each.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    cut = F.expr("concat(substr(run, 1, CAST(h % length(run) AS INT)), substr(run, CAST(h % length(run) AS INT) + 2))")
    each = each.select(F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = each.groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter((F.length("word") >= SHORTEST) & (F.col("n") >= FEWEST))


def _ranks(found: DataFrame) -> dict[str, int]:
    """The bigrams' places from rare to frequent: of 90 letters, at most 8,100."""
    grams = found.select(F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substr(word, i, 2))")).alias("g"))
    counts = grams.groupBy("g").count().collect()
    return {g: place for place, (_, g) in enumerate(sorted((n, g) for g, n in counts))}


def chosen(word: str, ranks: dict[str, int]) -> tuple[int, list[tuple[int, bool]]]:
    """A word's prefix: the rank it ends with, its grams' places in order, and whether each is a pivot."""
    weights = [ranks[word[k : k + 2]] for k in range(len(word) - 1)]
    last = sorted(weights)[2]
    prefix = [k for k, weight in enumerate(weights) if weight <= last]
    # single[j]: the least weight of one of the first j + 1 grams, and its place.
    single: list[tuple[int, int]] = []
    best: tuple[int, int, int] | None = None
    for j, k in enumerate(prefix):
        apart = j - 1 if j and prefix[j - 1] <= k - 2 else j - 2
        if apart >= 0:
            weight, other = single[apart]
            pair = (weight + weights[k], other, k)
            best = min(best, pair) if best else pair
        single.append(min(single[-1], (weights[k], k)) if single else (weights[k], k))
    return last, [(k, k in best[1:]) for k in prefix]


def _chosen(ranks: dict[str, int]) -> Column:
    grams = pa.list_(pa.struct([("at", pa.int32()), ("pivot", pa.bool_())]))

    @F.arrow_udf("struct<last: int, grams: array<struct<at: int, pivot: boolean>>>")
    def choose(column: pa.Array) -> pa.Array:
        out = []
        for word in column.to_pylist():
            last, prefix = chosen(word, ranks)
            out.append({"last": last, "grams": [{"at": at, "pivot": pivot} for at, pivot in prefix]})
        return pa.array(out, pa.struct([("last", pa.int32()), ("grams", grams)]))

    return choose.asNondeterministic()("word")


#: The letters of a word as bits: one edit takes away one at most and adds one at most.
_LETTERS = "aggregate(split(word, ''), 0L, (bits, c) -> bits | shiftleft(1L, ascii(c) % 64))"


def near(found: DataFrame) -> DataFrame:
    """Pairs of words of `found` (word, n) that are one edit apart, each once: a, a_n, b, b_n; a < b."""
    marked = found.select("word", "n", F.expr(_LETTERS).alias("letters"), _chosen(_ranks(found)).alias("p"))
    grams = marked.select("word", "n", "letters", "p.last", F.inline("p.grams"))
    sides = F.explode(
        F.expr(
            "array(named_struct('front', true, 'part', substr(word, 1, at + 2)),"
            " named_struct('front', false, 'part', substr(word, at + 1)))"
        )
    )
    own = ["word", "n", "letters", "last"]
    parts = stored(grams.select(*own, "pivot", sides.alias("s")).select(*own, "pivot", "s.*"))
    size = F.length("word")

    def side(rows: DataFrame, length: Column, name: str) -> DataFrame:
        key = F.xxhash64("front", "part", length).alias("key")
        return rows.select(key, *[F.col(c).alias(f"{name}_{c}") for c in own])

    index = side(parts, size, "b")
    probes = parts.filter("pivot").withColumn("size", F.explode(F.array(size - 1, size, size + 1)))
    pairs = side(probes, F.col("size"), "a").join(index, "key").filter(
        "a_last <= b_last AND bit_count(a_letters ^ b_letters) <= 2 AND levenshtein(a_word, b_word, 1) = 1"
    )
    one = "named_struct('a', a_word, 'a_n', a_n, 'b', b_word, 'b_n', b_n)"
    turned = "named_struct('a', b_word, 'a_n', b_n, 'b', a_word, 'b_n', a_n)"
    turned = F.expr(f"IF(a_word < b_word, {one}, {turned})")
    return stored(pairs.select(turned.alias("p")).select("p.*").distinct())


def forms(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per word: n, n_near, form and form_n.

    The form is the most frequent near word, of equal ones the first in code-point order,
    if it is TIMES as frequent.
    """
    both = pairs.select("a", "b", "b_n").union(pairs.select("b", "a", "a_n"))
    nearest = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), "b")).alias("t")
    )
    out = found.join(nearest, "word", "left")
    has = -F.col("t.less") >= TIMES * F.col("n")
    return out.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("t.b")).alias("form"),
        F.when(has, -F.col("t.less")).cast("long").alias("form_n"),
    )


def rooted(formed: DataFrame) -> DataFrame:
    """`forms` with `root`, the last word on the way from form to form.

    Each round follows twice as many forms as the one before. n at least doubles with
    every form, so ways are short and the rounds few.
    """
    ways = stored(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(ways.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        if longer.filter("next IS NOT NULL").isEmpty():
            break
        ways = longer.drop("next")
    out = formed.join(ways, "word", "left")
    return out.withColumn("root", F.coalesce("root", "word"))


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word of `words`: word, form, root, n, n_near, form_n.

    Words are near if one inserted, deleted or replaced code point makes one the other.
    form and form_n are null without a form, root is then the word itself. Repeated rows
    count as often as they are there. Empty tables and wordless texts give no rows. Other
    columns are not read.
    """
    found = stored(words(docs, id_col, text_col))
    formed = stored(forms(found, near(found)))
    return rooted(formed).select("word", "form", "root", "n", "n_near", "form_n")
