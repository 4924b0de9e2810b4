"""Collocations, secrets and spelling variants, held against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import collocations, secret_scan, spelling
from tests.llm import brute
from tests.llm.awkward import CLASHES, awkward, empty

CUT = re.compile(r"[.,;:!?\x0A-\x0D]")


def phrases(rows, least, top=2000):
    """Lang, rank, phrase, a, l, r, n, score of rows of (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in CUT.split(brute.small(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in (1, 2, 3):
                f.update((lang, tuple(words[k : k + m])) for k in range(len(words) - m + 1))
    out = {}
    for (lang, gram), a in f.items():
        if len(gram) > 1 and a >= least:
            cuts = [(a * a * 1000000 // (f[lang, gram[:k]] * f[lang, gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            longer = [c for (o, g), c in f.items() if o == lang and len(g) == 3 and len(gram) == 2 and gram in (g[:2], g[1:]) and c >= least]
            if not any(100 * c >= 50 * a for c in longer):
                out.setdefault(lang, []).append((-score, -a, " ".join(gram), f[lang, gram[:k]], f[lang, gram[k:]]))
    return sorted(
        (lang, rank, phrase, -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    )


def test_collocations_are_those_of_plain_counts(spark):
    chance = random.Random(7)
    words = ["the", "New", "york", "city", "of", "é", "日本", "x" * 600, "a-b", "a"]
    joints = [" ", "  ", "\t", ", ", ".", "\n", "\x0b", " ! "]
    rows = [(chance.choice(["en", "de", None, "und"]), "".join(chance.choice(words) + chance.choice(joints[:3] * 4 + joints) for _ in range(chance.randrange(60)))) for _ in range(400)]
    rows += [("en", None), ("en", ""), (None, None), ("", "new york city new york city")] + [("fr", "a b")] * 12
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    docs = docs.select("*", *[F.lit(1).alias(name) for name in ("word", "hash", "w1", "f", "shard", "phrase", "n")])
    for least, top in ((10, 2000), (3, 5)):
        found = collocations.collocations(docs, least=least, top=top)
        assert sorted(tuple(r) for r in found.collect()) == phrases(rows, least, top)


def test_collocations_without_a_filter_and_over_many_shards(spark, monkeypatch):
    rows = [("en", "a b c d e f a b c d " * 30)] * 3
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    whole = sorted(collocations.collocations(docs).collect())
    monkeypatch.setattr(collocations, "FILTER_BITS", 1)
    monkeypatch.setattr(collocations, "PER_SHARD", 20)
    assert sorted(collocations.collocations(docs).collect()) == whole
    assert [tuple(r) for r in whole] == phrases(rows, 10)


@pytest.mark.parametrize("bits", [16, 40, 64])
@pytest.mark.parametrize("width", [2, 3])
def test_filters_give_back_what_they_were_given(bits, width):
    chance = np.random.default_rng(bits)
    grams = [chance.integers(0, 1 << min(bits, 62), 3000, dtype=np.uint64) & np.uint64((1 << bits) - 1) for _ in range(width)]
    mixed = collocations.permuted(grams, bits)
    assert all((a == b).all() for a, b in zip(collocations.restored(mixed, bits), grams))
    shard_bits = 3
    keys, counts = collocations._summed(mixed, chance.integers(1, 600, 3000))
    shards = (keys[0] >> np.uint64(bits - shard_bits)).astype(int)
    for shard in range(1 << shard_bits):
        own = shards == shard
        content = collocations.filter_bytes([k[own] for k in keys], counts[own], bits, shard_bits)
        back, n = collocations.filter_entries(content, width, bits, shard_bits, shard)
        assert all((a == b[own]).all() for a, b in zip(back, keys)) and (n == counts[own]).all()


BASE = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def entropy_spans(text, one):
    """Spans of a class by counting every window anew, before the allow-list."""
    out = []
    listed = "".join(re.escape(c) for c in one.alphabet)
    for m in re.finditer(f"[{listed}]{{{secret_scan.WINDOW},}}", text):
        sums = []
        for k in range(len(m.group()) - secret_scan.WINDOW + 1):
            counts = Counter(m.group()[k : k + secret_scan.WINDOW])
            sums.append(sum(round(c * math.log2(c) * secret_scan.UNIT) for c in counts.values()))
        hot = [k for k, s in enumerate(sums) if s <= secret_scan.most_terms(one.bits)]
        if hot:
            out.append((m.start() + hot[0], one.kind, m.start() + hot[-1] + secret_scan.WINDOW))
    return out


def base_secrets(text):
    out = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            size = len(m.group(1)) if kind == "assign" else len(m.group())
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), place, kind, m.end()))
    return [(start, kind, end) for start, _, kind, end in sorted(out)]


def hostile(chance):
    parts = ["api_key", "APIKEY", "Token", "passwd", "secret", "=", ":", " ", "  ", '"', "'", "AKIA", "AKIAAKIA", "\n", "é", "\U0001f600", "==", "sha256:"]
    classes = ["0123456789abcdef", "ABCDEFGHIJ0123456789", "abcXYZ019+/_=-", "a1", "f"]
    made = lambda: "".join(chance.choices(chance.choice(classes), k=chance.randrange(45)))
    return "".join(chance.choice(parts) if chance.random() < 0.6 else made() for _ in range(chance.randrange(60)))


def test_secrets_are_those_of_plain_patterns_and_windows(spark):
    chance = random.Random(11)
    texts = [hostile(chance) for _ in range(400)] + ["", None, "token = " + "Ab9+" * 3000, "f" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["spans"] for r in secret_scan.by_document(docs, allow=()).collect()}
    for k, text in enumerate(texts):
        base = [(s["start"], s["kind"], s["end"]) for s in found[k] if s["base"]]
        assert base == base_secrets(text or "")
        more = sorted((s["start"], s["kind"], s["end"]) for s in found[k] if not s["base"])
        assert more == sorted(x for one in secret_scan.CLASSES for x in entropy_spans(text or "", one))
    listed = {r["doc_id"]: r["spans"] for r in secret_scan.by_document(docs).collect()}
    assert all({tuple(s) for s in listed[k]} <= {tuple(s) for s in found[k]} for k in found)


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("key Zx81kQpL0vT7yRw2Nn45aB9c end", ["entropy_base64"]),
        ("id 123e4567-e89b-12d3-a456-426614174000", []),
        ("see covid-19-vaccination-rates-2021-by-country", []),
        ("AbCdEfGhIjKlMnOpQrStUvWxYz0123456789", []),
        ("sha256: 9f8b2c7d1e6a5b4c3d2e", []),
        ("got 9f8b2c7d1e6a5b4c3d20", ["entropy_hex", "entropy_base64"]),
        ("your-example-key-Zx81kQpL0vT7yRw2Nn45", []),
    ],
)
def test_allow_list(spark, text, kinds):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [s["kind"] for s in secret_scan.by_document(docs).first()["spans"]] == kinds


def spelled(rows):
    """Word: form, root, n, n_near, form_n, by comparing every two words."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.small(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {word: c for word, c in n.items() if len(word) >= 5 and c >= 3}

    def one_apart(x, y):
        if len(x) > len(y):
            x, y = y, x
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y)) == 1
        return len(y) == len(x) + 1 and any(y[:k] + y[k + 1 :] == x for k in range(len(y)))

    near = {x: [y for y in n if one_apart(x, y)] for x in n}
    form = {}
    for x, others in near.items():
        best = min(others, key=lambda y: (-n[y], y), default=None)
        form[x] = best if best and n[best] >= 2 * n[x] else None
    out = {}
    for x in n:
        root = x
        while form[root]:
            root = form[root]
        out[x] = (form[x], root, n[x], len(near[x]), n.get(form[x]))
    return out


def test_spelling_variants_are_those_of_all_pairs(spark):
    chance = random.Random(3)
    letters = "abcàÉ×"
    words = ["".join(chance.choices(letters, k=chance.randrange(4, 9))) for _ in range(250)]
    words += [w[:k] + chance.choice(letters) + w[k + chance.randrange(2) :] for w in words for k in (0, 2, len(w))]
    rows = [(chance.choice([None, *range(300)]), " ".join(chance.choices(words, weights=[1 + 400 // (k + 1) for k in range(len(words))], k=40))) for _ in range(400)]
    rows += [(1, None), (2, ""), (3, "Same1same-SAME " * 3), (4, "z" * 30000), (4, "z" * 30000), (5, "z" * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs = docs.select("*", *[F.lit(1).alias(name) for name in ("word", "n", "run", "h", "form", "root")])
    found = {r["word"]: tuple(r)[1:] for r in spelling.grouped(docs).collect()}
    want = spelled(rows)
    assert found == want
    assert sum(v[0] is not None for v in want.values()) > 50 and any(v[0] != v[1] and v[0] for v in want.values())


def test_pivots_are_disjoint_and_the_lightest():
    chance = random.Random(5)
    grams = [a + b for a in "abcd" for b in "abcd"]
    for _ in range(300):
        word = "".join(chance.choices("abcd", k=chance.randrange(5, 12)))
        ranks = dict(zip(grams, chance.sample(range(16), 16)))
        last, prefix = spelling.chosen(word, ranks)
        places = [k for k, _ in prefix]
        weight = lambda k: ranks[word[k : k + 2]]
        assert places == [k for k in range(len(word) - 1) if weight(k) <= last] and len(places) >= 3
        x, y = (k for k, pivot in prefix if pivot)
        assert y - x >= 2
        assert weight(x) + weight(y) == min(weight(a) + weight(b) for a in places for b in places if b - a >= 2)


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark).withColumnRenamed("kind", "lang")
    assert secret_scan.by_document(docs).count() == docs.count()
    assert sorted(tuple(r) for r in collocations.collocations(docs).collect()) == phrases(
        [(r["lang"], r["text"]) for r in docs.collect()], 10
    )
    found = {r["word"]: tuple(r)[1:] for r in spelling.grouped(docs).collect()}
    assert found == spelled([(r["doc_id"], r["text"]) for r in docs.collect()])
    none = empty(spark).withColumnRenamed("kind", "lang")
    assert {"spans", "f"} & {*CLASHES}
    for made in (secret_scan.by_document, collocations.collocations, spelling.grouped):
        assert made(none).count() == 0
