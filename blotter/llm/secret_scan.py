"""Secrets in text: assignments and key formats by pattern, unknown ones by entropy.

Candidate strings are runs of one character class. A window of WINDOW characters slides
along a candidate; a step takes one character out of the counts and one in, which
changes the window's entropy by two looked-up terms. Where a window's entropy reaches
what the class asks for, the candidate holds a secret, unless the allow-list knows the
string for something else. All of it is column expressions: one pass over the texts
proposes, and from there on rows are single candidates with a little text around them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.sqltext import string
from blotter.llm.frames import text_of

WINDOW = 20
#: Entropies are compared as whole numbers of this part of a bit.
UNIT = 1_000_000
#: Text to the left of a candidate that the allow-list may look at.
CONTEXT_CHARS = 40


@dataclass(frozen=True)
class Pattern:
    """A base pattern. Matches that `valid` does not hold of are dropped; nothing inside is tried."""

    kind: str
    pattern: str
    valid: str
    needs: str


@dataclass(frozen=True)
class CharClass:
    """A class of candidate strings: at least `bits` a character in some window."""

    kind: str
    alphabet: str
    bits: float

    @property
    def _listed(self) -> str:
        return "".join(f"\\{c}" if c in "+/_=-" else c for c in self.alphabet)

    @property
    def pattern(self) -> str:
        return f"(?<![{self._listed}])[{self._listed}]{{{WINDOW},}}+"

    @property
    def needs(self) -> str:
        return f"[{self._listed}]{{{WINDOW}}}"


@dataclass(frozen=True)
class Allowed:
    """Candidates that are no secrets: SQL over `found` and `left`, the text before it."""

    name: str
    holds: str


# The words, marks and characters of the base patterns. In these, runs are
# possessive; what follows a run is never one of its characters.
_ASSIGN = (
    r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
)
PATTERNS = (
    Pattern(
        "assign",
        _ASSIGN,
        f"length(regexp_extract(found, {string(_ASSIGN)}, 1)) >= 6",
        r"(?i)password|passwd|secret|token|api_?key",
    ),
    Pattern("access", r"AKIA[A-Z0-9]++", "length(found) >= 20", "AKIA[A-Z0-9]{16}"),
    Pattern("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", "true", "[0-9a-f]{24}"),
)

_DIGITS, _SMALL = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("entropy_hex", _DIGITS + "ABCDEFabcdef", 3.2),
    CharClass("entropy_upper", _DIGITS + _SMALL.upper(), 3.6),
    CharClass("entropy_base64", _DIGITS + _SMALL.upper() + _SMALL + "+/_=-", 3.9),
)

KINDS = tuple(one.kind for one in PATTERNS + CLASSES)

ALLOW_LIST = (
    Allowed("no_mixture", "NOT (found RLIKE '[0-9]' AND found RLIKE '[A-Za-z]')"),
    Allowed("uuid", "found RLIKE '^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$'"),
    Allowed("sequence", "found RLIKE '(?i)abcdefgh|01234567|12345678|qwertyui'"),
    Allowed("placeholder", "found RLIKE '(?i)example|sample|placeholder|changeme|dummy|x{6}'"),
    # Words joined by marks, each with a short number at most.
    Allowed("words", "forall(split(found, '[+/_=-]'), part -> part RLIKE '^[A-Za-z]*+[0-9]{0,4}$')"),
    Allowed(
        "digest",
        "left RLIKE '(?i)(?:sha-?(?:1|224|256|384|512)|md5|commit|revision|checksum)[\"\\']?[\\\\x20:=-]{0,4}[\"\\']?$'",
    ),
)


#: By count: count * log2(count), in UNITs.
TERMS = tuple(round(c * math.log2(c) * UNIT) if c else 0 for c in range(WINDOW + 1))


def most_terms(bits: float) -> int:
    """The largest sum of a window's terms at which its entropy is still `bits`."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * UNIT)


def _slid(one: CharClass) -> Column:
    """Of `found`, as an array of one: its first and last hot window, and the least sum of terms.

    Windows are named by their first character's place. Characters go by their place in
    the alphabet. The one that leaves and the one that enters are counted before the step,
    so each changes the sum by the difference of two looked-up terms.
    """
    terms = f"array({', '.join(f'{t}L' for t in TERMS)})"
    hot = most_terms(one.bits)
    # x enters and y leaves; -1 where none leaves yet. Equal ones change nothing.
    step = f"""
        transform(
            array(named_struct('x', codes[i], 'y', IF(i >= {WINDOW}, codes[greatest(i - {WINDOW}, 0)], -1))),
            m -> IF(m.x = m.y, named_struct('counts', acc.counts, 'sum', acc.sum), named_struct(
                'counts', transform(acc.counts, (c, k) -> c + IF(k = m.x, 1, 0) - IF(k = m.y, 1, 0)),
                'sum', acc.sum + {terms}[acc.counts[m.x] + 1] - {terms}[acc.counts[m.x]]
                    - IF(m.y < 0, 0L, {terms}[acc.counts[greatest(m.y, 0)]]
                        - {terms}[greatest(acc.counts[greatest(m.y, 0)] - 1, 0)]))))"""
    judged = f"""
        transform({step}, s -> named_struct(
            'counts', s.counts, 'sum', s.sum,
            'first', IF(i >= {WINDOW - 1} AND acc.first < 0 AND s.sum <= {hot}, i - {WINDOW - 1}, acc.first),
            'last', IF(i >= {WINDOW - 1} AND s.sum <= {hot}, i - {WINDOW - 1}, acc.last),
            'least', IF(i >= {WINDOW - 1}, least(acc.least, s.sum), acc.least)))[0]"""
    start = (
        f"named_struct('counts', array_repeat(0, {len(one.alphabet)}), 'sum', 0L,"
        f" 'first', -1, 'last', -1, 'least', {TERMS[-1]}L)"
    )
    codes = f"transform(split(found, ''), c -> locate(c, {string(one.alphabet)}) - 1)"
    return F.expr(
        f"transform(array({codes}), codes -> aggregate(sequence(0, size(codes) - 1), {start},"
        f" (acc, i) -> {judged}, acc -> named_struct('first', acc.first, 'last', acc.last, 'least', acc.least)))"
    )


_ALL = PATTERNS + CLASSES
#: What the proposals need, and the columns that tell whether a text has it.
_NEEDS = {one.needs: f"has_{k}" for k, one in enumerate(_ALL)}


def _by_number(values: list[Column]) -> Column:
    chosen = F.when(F.col("number") == 0, values[0])
    for k, value in enumerate(values[1:], 1):
        chosen = chosen.when(F.col("number") == k, value)
    return chosen


def _row_key(id_col: str, text_col: str) -> Column:
    """128 bits of a row's id and text."""
    return F.md5(F.concat_ws("\0", F.col(f"`{id_col}`").cast("string"), text_of(text_col)))


def _proposed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each match of each pattern: row_key, number, place among its matches, found, left, start."""
    text = text_of(text_col)
    has = [text.rlike(needs).alias(name) for needs, name in _NEEDS.items()]
    rows = docs.select(_row_key(id_col, text_col).alias("row_key"), text.alias("text"), *has)
    rows = rows.filter(" OR ".join(_NEEDS.values()))

    def cut(number: int, one: Pattern | CharClass) -> Column:
        """The matches of a pattern and the texts between them."""
        found = F.regexp_extract_all("text", F.lit(one.pattern), F.lit(0))
        between = F.split("text", one.pattern, -1)
        whole = F.struct(F.lit(number).alias("number"), found.alias("found"), between.alias("pieces"))
        return F.when(F.col(_NEEDS[one.needs]), whole)

    cuts = rows.select("row_key", F.explode(F.array(*[cut(k, one) for k, one in enumerate(_ALL)])).alias("z"))
    cuts = cuts.filter("size(z.found) > 0")
    each = cuts.select(
        "row_key", F.col("z.number").alias("number"), F.posexplode(F.arrays_zip("z.found", "z.pieces")).alias("place", "z")
    ).filter("z.found IS NOT NULL")
    each = each.select(
        "row_key",
        "number",
        "place",
        F.col("z.found").alias("found"),
        F.length("z.pieces").alias("gap"),
        F.expr(f"right(z.pieces, {CONTEXT_CHARS})").alias("left"),
    ).dropDuplicates(["row_key", "number", "place"])
    so_far = Window.partitionBy("row_key", "number").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.length("found")).cast("long")).over(so_far)
    return each.withColumn("start", end - F.length("found"))


def spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    allow: tuple[Allowed, ...] = ALLOW_LIST,
) -> DataFrame:
    """Every span: row_key (128 bits of id and text), start, end, kind, base, bits.

    start and end are code points, the end exclusive. Base spans are the valid matches of
    PATTERNS. The others run from the first to the last hot window of a candidate that
    no entry of `allow` holds of; `bits` is the highest entropy of their windows, null
    for base spans. Rows of one id and text have their spans once. Null texts count as
    empty. Other columns are not read.
    """
    each = _proposed(docs, id_col, text_col)
    # By pattern, an array of one or none: where the span lies within the match.
    none = F.expr("CAST(array() AS array<struct<first: int, last: int, least: bigint>>)")
    whole = F.expr(f"array(named_struct('first', 0, 'last', length(found) - {WINDOW}, 'least', CAST(NULL AS BIGINT)))")
    known = F.lit(False)
    for entry in allow:
        known = known | F.coalesce(F.expr(entry.holds), F.lit(False))
    within = [F.when(F.expr(one.valid), whole).otherwise(none) for one in PATTERNS]
    within += [F.when(known, none).otherwise(F.filter(_slid(one), lambda s: s["first"] >= 0)) for one in CLASSES]
    found = each.select("row_key", "start", "number", F.explode(_by_number(within)).alias("s"))
    return found.select(
        "row_key",
        (F.col("start") + F.col("s.first")).alias("start"),
        (F.col("start") + F.col("s.last") + WINDOW).alias("end"),
        "number",
        F.element_at(F.array(*map(F.lit, KINDS)), F.col("number") + 1).alias("kind"),
        (F.col("number") < len(PATTERNS)).alias("base"),
        (F.lit(math.log2(WINDOW)) - F.col("s.least") / (WINDOW * UNIT)).alias("bits"),
    )


def by_document(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    allow: tuple[Allowed, ...] = ALLOW_LIST,
) -> DataFrame:
    """Per document: id, row_key, and `spans`, an array of (start, number, kind, end, base, bits).

    Spans are in order of start and kind. One row per input row, repeated rows included;
    without spans, and for null and empty texts, the array is empty.
    """
    listed = spans(docs, id_col, text_col, allow).groupBy("row_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "number", "kind", "end", "base", "bits"))).alias("spans")
    )
    kind = listed.schema["spans"].dataType
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), _row_key(id_col, text_col).alias("row_key"))
    out = rows.join(listed, "row_key", "left")
    return out.withColumn("spans", F.coalesce("spans", F.array().cast(kind)))
