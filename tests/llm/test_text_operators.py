"""Operators on single texts: rules, personal data, licences, against plain versions."""

import random
import re
from collections import Counter

import pytest

from blotter.llm import license_scan, pii, quality_rules
from tests.llm import brute
from tests.llm.awkward import TEXTS, awkward, empty

rng = random.Random(5)
PIECES = ["a", "b", "c d e f g", "\n", " ", "#", "**", "WORD!!", "x,", "é", "日本", "\t", "a b c d e"]
LINES = ["".join(rng.choice(PIECES) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(300)]


def by_row(df, *names):
    return Counter(tuple(row[n] for n in names) for row in df.collect())


def test_measures(spark):
    texts = [(k, t) for k, t in enumerate(LINES)] + TEXTS
    found = quality_rules.ledger(awkward(spark, texts))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert by_row(found, *names) == Counter((k, *brute.measures(t)) for k, t in texts)
    assert quality_rules.ledger(empty(spark)).count() == 0


def test_policies_and_ablations(spark):
    found = quality_rules.ledger(awkward(spark, list(enumerate(LINES))))
    bits = [row["failures"] for row in found.collect()]
    mask = quality_rules.mask("v1")
    want = {}
    for k, rule in enumerate(quality_rules.RULES):
        want[rule.name] = (sum(b >> k & 1 for b in bits), sum(b & mask == 1 << k for b in bits))
    got = quality_rules.ablations(found, "v1").collect()
    assert {r["rule"]: (r["failed"], r["only"]) for r in got} == want
    assert [r["failed"] for r in quality_rules.ablations(found.limit(0), "base").collect()] == [0, 0]


def test_accepted_keeps_rows_and_columns(spark):
    docs = awkward(spark)
    kept = quality_rules.accepted(docs)
    assert kept.columns == docs.columns
    assert by_row(kept, "doc_id") == Counter(
        {(None,): 1, (5,): 2, (6,): 1}
    )  # the long text repeats itself, the others have few words


DATA = ["a@b.c", "_d@e.f@g.h", "x" * 30, "@", ".", "1.2.3.4", "300.1.2.3", "001.2.3.4", "1.2.3.4.5.6.7.8.9",
        " ", "-", "4111 1111 1111 1111", "4111111111111111", "+1 (988) 555-2485", "+", "5", "日本", "é", "\n",
        "GB82 WEST 1234 5698 7654 32", "password=abc12345", "\U0001f600", " tel 415-555-1234"]
PERSONAL = ["".join(rng.choice(DATA) for _ in range(rng.randint(0, 25))) for _ in range(300)]


def test_base_spans_and_masks(spark):
    texts = dict(enumerate(PERSONAL))
    docs = awkward(spark, list(texts.items()))
    found = {r["doc_id"]: r["spans"] for r in pii.by_document(docs).collect()}
    assert found.keys() == texts.keys()
    for k, text in texts.items():
        base = [(s["start"], s["kind"], s["end"]) for s in found[k] if s["base"]]
        assert base == brute.base_spans(text), text
    hidden = {r["doc_id"]: r["text"] for r in pii.masked(docs).collect()}
    for k, text in texts.items():
        spans = [(s["start"], s["place"], s["end"], s["kind"]) for s in found[k]]
        assert hidden[k] == brute.masked(text, spans), text


def test_masks_in_blocks(spark, monkeypatch):
    docs = awkward(spark, list(enumerate(PERSONAL[:60])))
    whole = by_row(pii.masked(docs), "doc_id", "text")
    monkeypatch.setattr(pii, "_BLOCK", 7)
    assert by_row(pii.masked(docs), "doc_id", "text") == whole


@pytest.mark.parametrize(
    "text, kind",
    [
        ("+1 (269) 555-3296 4524132264652876 and", "card"),
        ("+1 (269) 555-3296 4524132264652876 and", "phone"),
        ("IBAN GB82 WEST 1234 5698 7654 32.", "iban"),
        ("social security 123-45-6789", "ssn"),
        ("call 415-555-1234 now", "phone"),
        ('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "secret"),
    ],
)
def test_the_method_adds_spans(spark, text, kind):
    found = pii.by_document(awkward(spark, [(1, text)])).first()["spans"]
    assert kind in [s["kind"] for s in found if not s["base"]]


@pytest.mark.parametrize("text", ["GB83 WEST 1234 5698 7654 32", "123-45-6789", "415-555-1234", "4111111111111112"])
def test_unconfirmed_numbers_are_left(spark, text):
    assert pii.by_document(awkward(spark, [(1, text)])).first()["spans"] == []


def test_awkward_personal_data(spark):
    docs = awkward(spark)
    assert by_row(pii.by_document(docs), "doc_id") == Counter((k,) for k, _ in TEXTS)
    hidden = pii.masked(docs)
    assert hidden.columns == docs.columns
    want = Counter((k, t and t.replace("a@b.cd", "[EMAIL]").replace("1.2.3.4", "[IP]")) for k, t in TEXTS)
    assert by_row(hidden, "doc_id", "text") == want
    assert pii.by_document(empty(spark)).count() == pii.masked(empty(spark)).count() == 0


def phrases(text):
    words = brute.PLAIN.findall(brute.small(text))
    places = [
        (k, label)
        for label, phrase in license_scan.PHRASES
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    starts = [k for k, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


NOTICE = ["cc by nc", "CC-BY-NC", "under the MIT license", "under the mit licence", "apache license, version 2.0",
          "cc by", "word", "é", "\n", "All rights reserved."]


def test_phrases(spark):
    texts = [(k, " ".join(rng.choice(NOTICE) for _ in range(rng.randint(0, 9)))) for k in range(200)] + TEXTS
    found = license_scan.scan(awkward(spark, texts)).collect()
    got = Counter(
        (r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], ",".join(r["base_labels"]))
        for r in found
    )
    assert got == Counter((k, *phrases(t)) for k, t in texts)
    for row in found:
        assert set(row["base_labels"]) <= set(row["labels"]) == set(sorted(set(row["labels"])))
        assert (row["score"] > 0) == bool(row["labels"]) and row["score"] <= 1
    assert license_scan.scan(empty(spark)).count() == 0


def test_notices_with_a_word_more_or_less(spark):
    text = dict(license_scan.NOTICES)["mit"]
    changed = text.replace("to any person", "to any one person").replace("free of charge, ", "")
    texts = [(1, changed), (2, "licensed under the GNU General Public License, version 3"), (3, text[:60])]
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan(awkward(spark, texts)).collect()}
    assert got == {1: ["mit"], 2: ["gpl-3"], 3: []}


def test_patterns_are_linear(spark):
    """Long runs that match nothing, where trying every start would take hours."""
    texts = [(1, "a" * 400_000), (2, "1" * 400_000), (3, "1." * 200_000), (4, "a@" * 200_000)]
    assert pii.by_document(awkward(spark, texts)).count() == 4
    assert re.fullmatch(pii.PROPOSALS[2].pattern.replace("++", "+"), "4111-1111")


def test_notices_back_to_back(spark):
    gpl = dict(license_scan.NOTICES)["gpl-2"]
    rows = [(n, "All rights reserved. " * n) for n in (1, 2, 3, 50)]
    rows += [(60, "General Public License, " * 20 + gpl), (61, "General Public License, " * 20)]
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan(awkward(spark, rows)).collect()}
    want = {n: (["all-rights-reserved"], 1.0) for n in (1, 2, 3, 50)}
    assert found == want | {60: (["gpl-2"], 1.0), 61: ([], 0.0)}


@pytest.mark.parametrize(
    "text",
    [
        "under the mit the mit license",
        "apache license version of license version 2",
        "cc by cc by by nc",
        "under the mit license the mit",
    ],
)
def test_a_license_score_needs_a_label(spark, text):
    """Pieces of a phrase side by side are not the phrase."""
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = license_scan.scan(docs).first()
    whole = "under the mit license" in text
    assert (row["score"], row["labels"], row["n_base"]) == (1.0, ["mit"], 1) if whole else (0.0, [], 0)
