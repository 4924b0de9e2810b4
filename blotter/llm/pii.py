"""Personal data in text: patterns propose spans, checksums confirm them, context scores them.

All of it is column expressions. One pass proposes; from there on, rows are single
proposals, with the text around them, and never whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.frames import text_of, unused

_DIGITS = "regexp_replace(found, '[^0-9]', '')"

#: International bank account number: the checked text with its first four
#: characters last and letters as numbers from 10 on must be 1 modulo 97.
_MOD_97 = """aggregate(
    split(concat(substr(translate(found, ' ', ''), 5), substr(translate(found, ' ', ''), 1, 4)), ''),
    0L,
    (sum, c) -> CASE
        WHEN c = '' THEN sum
        WHEN c BETWEEN '0' AND '9' THEN (sum * 10 + ascii(c) - 48) % 97
        ELSE (sum * 100 + ascii(c) - 55) % 97 END
) = 1"""


@dataclass(frozen=True)
class Proposal:
    """A pattern for spans of a kind.

    `valid` must hold of the match `found`. A text without a match of `needs`, which is
    quick to tell, cannot have a valid one. `score` is what a valid match is worth,
    before words of `context` beside it add to it. Matches follow each other from the
    left without overlap; one that is not valid is dropped, and nothing inside it tried.
    """

    kind: str
    pattern: str
    valid: str
    score: float
    context: str
    base: bool = False
    needs: str = "[0-9]"


#: Kinds in the order that decides between spans of one start.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")

#: In these, a run of characters is tried from its first one only (or from the end
#: of the last match), and runs are possessive. Matches stay those of the plain
#: patterns, in time linear in the text.
PROPOSALS = (
    Proposal(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "true",
        0.8,
        r"(?i)\b(?:e-?mail|mail|contact|write|from|to|cc)\b",
        base=True,
        needs="@",
    ),
    Proposal(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "forall(split(found, '[.]'), part -> length(ltrim('0', part)) <= 3"
        " AND coalesce(try_cast(ltrim('0', part) AS INT), 0) <= 255)",
        0.6,
        r"(?i)\b(?:ip|address|host|server|login|from)\b",
        base=True,
    ),
    Proposal(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        f"length({_DIGITS}) BETWEEN 14 AND 19 AND luhn_check({_DIGITS})",
        0.8,
        r"(?i)\b(?:card|visa|master ?card|amex|credit|debit|payment|account)\b",
        base=True,
    ),
    Proposal(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        f"length({_DIGITS}) BETWEEN 10 AND 15",
        0.7,
        r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp)\b",
        base=True,
    ),
    # What stands next to other numbers is part of a longer, failing match above.
    Proposal(
        "card",
        r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])",
        f"luhn_check({_DIGITS}) AND {_DIGITS} NOT RLIKE '^0'",
        0.7,
        r"(?i)\b(?:card|visa|master ?card|amex|credit|debit|payment|account)\b",
    ),
    Proposal(
        "phone",
        r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
        f"length({_DIGITS}) BETWEEN 10 AND 15",
        0.6,
        r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp)\b",
    ),
    Proposal(
        "phone",
        r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
        "true",
        0.4,
        r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp)\b",
    ),
    Proposal(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        f"length(translate(found, ' ', '')) BETWEEN 15 AND 34 AND {_MOD_97}",
        0.8,
        r"(?i)\b(?:iban|bank|account|transfer|konto|cuenta|compte)\b",
    ),
    Proposal(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        "true",
        0.4,
        r"(?i)\b(?:ssn|social|security|tax)\b",
    ),
    Proposal(
        "secret",
        r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
        "true",
        0.9,
        r"(?i)\b(?:key|aws|secret)\b",
        needs="AKIA",
    ),
    Proposal(
        "secret",
        r"(?i)(?<![a-z0-9])(?:password|passwd|secret|token|api[_-]?key)\x20?[=:]\x20?\"?[a-z0-9/+_-]{8,}+\"?",
        "found RLIKE '[0-9]'",
        0.8,
        r"(?i)\b(?:login|user|key|auth)\b",
    ),
)

#: What a context word beside the match adds, how far it may be, and the least score
#: of a span that is not base.
CONTEXT_SCORE = 0.2
CONTEXT_CHARS = 40
LEAST_SCORE = 0.5


#: What proposals need, and the columns that tell whether a text has it.
_NEEDS = {needs: f"has_{k}" for k, needs in enumerate(dict.fromkeys(p.needs for p in PROPOSALS))}


def _proposed(text: Column, number: int, proposal: Proposal) -> Column:
    found = F.regexp_extract_all(text, F.lit(proposal.pattern), F.lit(0))
    none = F.array().cast("array<string>")
    can = F.col(_NEEDS[proposal.needs])
    return F.struct(F.lit(number).alias("number"), F.when(can, found).otherwise(none).alias("found"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every span: row_key (a hash of id and text), start, end, kind, score, base.

    start and end are code points, the end exclusive. Base spans always stay; the
    others need LEAST_SCORE. Rows of one id and text have their spans once. Null
    texts count as empty. Other columns are not read.
    """
    own, text = F.col(f"`{id_col}`"), text_of(text_col)
    has = [text.rlike(needs).alias(name) for needs, name in _NEEDS.items()]
    rows = docs.select(F.xxhash64(own, text).alias("row_key"), text.alias("text"), *has)
    rows = rows.filter(" OR ".join(_NEEDS.values()))
    proposed = [_proposed(F.col("text"), k, p) for k, p in enumerate(PROPOSALS)]
    rows = rows.select("row_key", "text", F.array(*proposed).alias("all"))
    rows = rows.filter("exists(all, one -> size(one.found) > 0)")
    around = [
        F.when(
            F.size(F.col("all")[k]["found"]) > 0,
            F.split("text", p.pattern, -1),
        )
        for k, p in enumerate(PROPOSALS)
    ]
    rows = rows.select("row_key", F.arrays_zip(F.col("all"), F.array(*around).alias("pieces")).alias("z"))
    rows = rows.select("row_key", F.explode("z").alias("z")).filter("size(z.all.found) > 0")
    rows = rows.select("row_key", F.col("z.all.number").alias("number"), F.col("z.all.found").alias("found"), F.col("z.pieces").alias("pieces"))
    # What follows the k-th match begins the (k + 1)-th piece between matches.
    after = F.slice("pieces", F.lit(2), F.size("found"))
    each = rows.select(
        "row_key",
        "number",
        F.posexplode(F.arrays_zip("found", F.col("pieces"), after.alias("after"))).alias("place", "z"),
    ).filter("z.found IS NOT NULL")
    each = each.select(
        "row_key",
        "number",
        "place",
        F.col("z.found").alias("found"),
        F.length("z.pieces").alias("gap"),
        F.expr(f"right(z.pieces, {CONTEXT_CHARS})").alias("left"),
        F.expr(f"left(z.after, {CONTEXT_CHARS})").alias("right"),
    ).dropDuplicates(["row_key", "number", "place"])
    so_far = Window.partitionBy("row_key", "number").orderBy("place").rowsBetween(
        Window.unboundedPreceding, 0
    )
    each = each.withColumn("end", F.sum(F.col("gap") + F.length("found")).over(so_far))
    each = each.withColumn("start", F.col("end") - F.length("found"))

    def by_number(value) -> Column:
        chosen = F.when(F.col("number") == 0, value(PROPOSALS[0]))
        for k, proposal in enumerate(PROPOSALS[1:], 1):
            chosen = chosen.when(F.col("number") == k, value(proposal))
        return chosen

    beside = by_number(
        lambda p: F.when(F.concat_ws(" ", "left", "right").rlike(p.context), F.lit(CONTEXT_SCORE)).otherwise(F.lit(0.0))
    )
    scored = each.filter(by_number(lambda p: F.expr(p.valid))).select(
        "row_key",
        F.col("start").cast("long"),
        F.col("end").cast("long"),
        by_number(lambda p: F.lit(p.kind)).alias("kind"),
        F.least(F.lit(1.0), by_number(lambda p: F.lit(p.score)) + beside).alias("score"),
        by_number(lambda p: F.lit(p.base)).alias("base"),
    )
    scored = scored.filter(F.col("base") | (F.col("score") >= LEAST_SCORE))
    return scored.groupBy("row_key", "start", "end", "kind").agg(
        F.max("score").alias("score"), F.max("base").alias("base")
    )


def by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, row_key, and `spans`, an array of (start, place of kind, kind, end, score, base).

    One row per input row, repeated rows included; without spans the array is empty.
    """
    found = spans(docs, id_col, text_col)
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    listed = found.groupBy("row_key").agg(
        F.sort_array(
            F.collect_list(F.struct("start", place.alias("place"), "end", "kind", "score", "base"))
        ).alias("spans")
    )
    own = F.col(f"`{id_col}`")
    rows = docs.select(own.alias(id_col), F.xxhash64(own, text_of(text_col)).alias("row_key"))
    out = rows.join(listed, "row_key", "left")
    kind = listed.schema["spans"].dataType
    return out.withColumn("spans", F.coalesce("spans", F.array().cast(kind)))


#: Characters in the blocks that masking cuts texts into.
_BLOCK = 4096


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every span of their text replaced by its kind in brackets.

    All columns stay. Spans that overlap become one, named by the first. A null text
    stays null.
    """
    key, text = unused(docs, "_row"), text_of(text_col)
    own = F.col(f"`{id_col}`")
    found = spans(docs, id_col, text_col)
    # Spans that overlap: each that begins before the furthest end so far joins the one before.
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    order = Window.partitionBy("row_key").orderBy("start", place, "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("fresh", F.coalesce(F.col("start") >= reached, F.lit(True)).cast("int"))
    found = found.withColumn("place", place).withColumn(
        "run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    merged = found.groupBy("row_key", "run").agg(
        F.min(F.struct("start", "place", "end", "kind")).alias("first"), F.max("end").alias("end")
    )
    # Where the kept text between spans begins and ends.
    by_run = Window.partitionBy("row_key").orderBy("run")
    merged = merged.select(
        "row_key",
        F.coalesce(F.lag("end").over(by_run), F.lit(0)).alias("keep"),
        F.col("first.start").alias("upto"),
        F.concat(F.lit("["), F.upper("first.kind"), F.lit("]")).alias("mark"),
        "end",
    )
    listed = merged.groupBy("row_key").agg(
        F.sort_array(F.collect_list(F.struct("keep", "upto", "mark"))).alias("cuts"),
        F.max("end").alias("rest"),
    )
    cuts, rest, blocks = (unused(docs, name) for name in ("_cuts", "_rest", "_blocks"))
    listed = listed.select(
        F.col("row_key").alias(key), F.col("cuts").alias(cuts), F.col("rest").alias(rest)
    )

    def part(begin: str, end: str) -> str:
        """SQL for the text from code point `begin` to `end`, from the blocks it lies in."""
        first = f"CAST({begin} div {_BLOCK} AS INT)"
        last = f"CAST(({end} - 1) div {_BLOCK} AS INT)"
        return f"""CASE WHEN {begin} >= {end} THEN '' ELSE array_join(transform(
            slice(`{blocks}`, {first} + 1, {last} - {first} + 1),
            (block, i) -> substr(
                block,
                CAST(greatest(0, {begin} - (i + {first}) * {_BLOCK}) + 1 AS INT),
                CAST({end} - greatest({begin}, (i + {first}) * {_BLOCK}) AS INT))), '') END"""

    whole = f"CAST(greatest({rest}, size(`{blocks}`) * {_BLOCK}L) AS BIGINT)"
    replaced = F.expr(
        f"concat(array_join(transform(`{cuts}`, cut -> concat({part('cut.keep', 'cut.upto')}, cut.mark)), ''),"
        f" {part(f'`{rest}`', whole)})"
    )
    names = [F.col(f"`{name}`") for name in docs.columns]
    rows = docs.withColumn(key, F.xxhash64(own, text)).join(listed, key, "left")
    rows = rows.withColumn(
        blocks,
        F.when(
            F.col(cuts).isNotNull(),
            F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0)),
        ),
    )
    changed = F.when(F.col(cuts).isNotNull(), replaced).otherwise(F.col(f"`{text_col}`"))
    return rows.withColumn(text_col, changed).select(*names)
