"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger holds the measurements and
one bit per failed rule; a policy is a named, versioned mask over the bits. Other
policies, and what each rule changes, come from the ledger by bitwise operations,
without another look at the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.frames import give_back, text_of, unused
from blotter.llm.words import SPACED, blocks, mixed, segment_hashes, window_hashes, words_of

REPEAT_WINDOW = 5

#: Characters that count as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CAPITAL = np.zeros(256, bool)
CAPITAL[0x41:0x5B] = True
SMALL = np.zeros(256, bool)
SMALL[0x61:0x7B] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(b".?!:;")] = True

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_shouted",
    "n_marked",
)


def _covered(hits: np.ndarray, width: int, n: int) -> np.ndarray:
    """Flags the n words that lie in a window that begins at one of the flagged places."""
    steps = np.zeros(n + 1, np.int64)
    places = np.flatnonzero(hits)
    np.add.at(steps, places, 1)
    np.add.at(steps, places + width, -1)
    return np.cumsum(steps[:-1]) > 0


def _repeated(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Flags the entries whose key occurs twice or more in their row."""
    own = keys ^ mixed(rows.astype(np.uint64) + np.uint64(1))
    ordered = np.sort(own)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(shared, own), len(shared) - 1)
    return shared[place] == own


def _again(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Flags the entries whose key occurred earlier in their row."""
    flags = np.zeros(len(keys), bool)
    places = np.flatnonzero(_repeated(keys, rows))
    order = places[np.lexsort((places, keys[places], rows[places]))]
    k, r = keys[order], rows[order]
    flags[order[1:]] = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    return flags


def _measured(column: pa.Array) -> pa.Array:
    found: list[list[np.ndarray]] = []
    for block in blocks(column):
        data, rows = block.data, block.rows
        inside = SPACED[data]
        words = words_of(block, inside)
        n = np.diff(words.firsts)
        chars = block.per_row(inside & ((data & 0xC0) != 0x80))
        symbols = block.per_row(SYMBOLS[data])

        # Lines end at a line feed or with their row.
        cut = data == 0x0A
        breaks = np.flatnonzero(cut)
        starts = np.sort(np.concatenate([block.offsets[:-1], breaks + 1]))
        ends = np.sort(np.concatenate([breaks, block.offsets[1:]]))
        owner = np.sort(
            np.concatenate(
                [np.arange(rows), np.searchsorted(block.offsets, breaks, "right") - 1]
            )
        )
        worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
        starts, ends, owner = starts[worded], ends[worded], owner[worded]
        earlier = _again(segment_hashes(data, starts, ends), owner)
        lines = np.bincount(owner, minlength=rows)
        dup_lines = np.bincount(owner[earlier], minlength=rows)

        # Places where five words in a row are those of another place of the text.
        hashes = segment_hashes(data, words.starts, words.ends)
        grams = window_hashes(hashes, REPEAT_WINDOW)
        hits = np.zeros(len(hashes), bool)
        if len(grams):
            whole = np.flatnonzero(words.rows[: len(grams)] == words.rows[REPEAT_WINDOW - 1 :])
            hits[whole[_repeated(grams[whole], words.rows[whole])]] = True
        covered = _covered(hits, REPEAT_WINDOW, len(hashes))
        repeats = np.bincount(words.rows[covered], minlength=rows)

        # Words without a small letter of ASCII that have two capitals or more,
        # and words that end in two marks or more.
        capitals = block.per_span(CAPITAL[data], words.starts, words.ends)
        small = block.per_span(SMALL[data], words.starts, words.ends)
        shouted = (small == 0) & (capitals >= 2)
        last = data[words.ends - 1]
        but_last = data[np.maximum(words.ends - 2, 0)]
        marked = (words.ends - words.starts >= 2) & _ENDS[last] & (last == but_last)
        found.append(
            [
                n,
                chars,
                symbols,
                dup_lines,
                repeats,
                lines,
                np.bincount(words.rows[shouted], minlength=rows),
                np.bincount(words.rows[marked], minlength=rows),
            ]
        )
    columns = [np.concatenate(parts) for parts in zip(*found)] if found else [[]] * len(MEASURES)
    return pa.StructArray.from_arrays(
        [pa.array(values, pa.int64()) for values in columns], names=list(MEASURES)
    )


def measures(text_col: str = "text") -> Column:
    """A struct of the measurements of a document's whole text."""
    kind = ", ".join(f"{name}: bigint" for name in MEASURES)

    @F.arrow_udf(f"struct<{kind}>")
    def measure(texts: pa.Array) -> pa.Array:
        found = _measured(texts)
        give_back()
        return found

    return measure.asNondeterministic()(text_of(text_col))


@dataclass(frozen=True)
class Rule:
    """A document fails where `failed` holds. Its place in RULES is its bit, for good."""

    name: str
    failed: str


#: Integer comparisons over the measurements. New rules go to the end.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 20 * n_words"),
    Rule("repeated_lines", "n_lines > 0 and 100 * n_dup_lines > 50 * n_lines"),
    Rule("shouted", "100 * n_shouted > 30 * n_words"),
    Rule("marked", "100 * n_marked > 20 * n_words"),
    Rule("word_length", "word_chars > 14 * n_words or word_chars < 2 * n_words"),
)

#: Names of rules by policy. A policy never changes; a new one gets a new name.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(rule.name for rule in RULES),
}


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    return sum(1 << k for k, rule in enumerate(RULES) if rule.name in POLICIES[policy])


def failure_bits(measured: str) -> Column:
    """The ledger's bits from the struct column `measured`."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES):
        text = rule.failed
        for name in MEASURES:
            text = text.replace(name, f"`{measured}`.`{name}`")
        bits = bits + F.when(F.expr(text), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, the measurements and `failures`, the bits of the failed rules.

    One row per input row, repeated rows included. A null text counts as empty and
    fails `few_words`; a null id stays null. Other columns are not read.
    """
    read = docs.select(F.col(f"`{id_col}`").alias(id_col), measures(text_col).alias("_m"))
    return read.select(id_col, "_m.*", failure_bits("_m").alias("failures"))


def passes(failures: Column, policy: str) -> Column:
    """Whether a document with these failure bits passes a policy."""
    return failures.bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does, from a ledger alone.

    Per rule: documents that fail it, and `only`, those that fail no other rule of
    the policy and would pass without it. Documents are first counted by their bits.
    """
    own = mask(policy)
    by_bits = rows.groupBy(F.col("failures").bitwiseAND(F.lit(own)).alias("_bits")).count()
    sums = []
    for k, rule in enumerate(RULES):
        if own >> k & 1:
            bit = F.lit(1 << k)
            hit = F.col("_bits").bitwiseAND(bit) != 0
            alone = F.col("_bits") == bit
            sums.append(
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.coalesce(F.sum(F.when(hit, F.col("count"))), F.lit(0)).alias("failed"),
                    F.coalesce(F.sum(F.when(alone, F.col("count"))), F.lit(0)).alias("only"),
                )
            )
    return by_bits.agg(F.array(*sums).alias("_rules")).select(F.inline("_rules"))


def accepted(docs: DataFrame, policy: str = "v1", text_col: str = "text") -> DataFrame:
    """The documents that pass a policy, with all their columns."""
    measured = unused(docs, "_m")
    kept = passes(failure_bits(measured), policy)
    names = [F.col(f"`{name}`") for name in docs.columns]
    return docs.withColumn(measured, measures(text_col)).filter(kept).select(*names)
