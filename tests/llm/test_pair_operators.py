"""Operators between documents, against plain versions."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from blotter.llm import components, decontaminate, ngram_join, sharding
from tests.llm import brute
from tests.llm.awkward import TEXTS, awkward, empty

rng = random.Random(6)


def family():
    base = [rng.choice("abcdefghijklmnop") + rng.choice("xyz") for _ in range(rng.choice([3, 5, 12, 40, 80]))]
    out = []
    for _ in range(rng.choice([1, 2, 5, 20])):
        own = base[:]
        for _ in range(rng.choice([0, 1, 2, 3, 5])):
            own[rng.randrange(len(own))] = rng.choice("PQRS") + str(rng.randrange(50))
        if rng.random() < 0.3:
            own = own[: rng.randrange(1, len(own) + 1)]
        out.append(" ".join(own))
        base = own if rng.random() < 0.5 else base
    return out


FAMILIES = list(enumerate([text for _ in range(35) for text in family()]))


def groups_of(rows):
    """(id, size, smallest id) per row by brute force; nulls are never the smallest."""
    found = brute.near_groups([text for _, text in rows])
    least = defaultdict(list)
    for (name, _), (size, group) in zip(rows, found):
        if size and name is not None:
            least[group].append(name)
    out = []
    for (name, _), (size, group) in zip(rows, found):
        out.append((name, size, min(least[group], default=None) if size else name))
    return Counter(out)


@pytest.mark.parametrize("per_round", [2, 64])
def test_near_groups(spark, per_round):
    rows = FAMILIES[:: 3 if per_round == 2 else 1] + TEXTS
    found = ngram_join.groups(awkward(spark, rows), per_round=per_round)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    assert got == groups_of(rows)


def test_a_large_family_takes_few_comparisons(spark, monkeypatch):
    """Near copies of one text, some linked by way of others only; the text itself is not there."""
    own = random.Random(66)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for name in range(400):
        words = base[:]
        for place in own.sample(range(120), own.choice([0, 1, 1, 2, 3, 4, 5])):
            words[place] = f"x{own.randrange(10_000)}" if own.random() < 0.7 else f"y{place}"
        rows.append((name, " ".join(words)))
    asked = []
    made = ngram_join._overlaps

    def counted(pairs, core):
        asked.append(pairs.count())
        return made(pairs, core)

    monkeypatch.setattr(ngram_join, "_overlaps", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.groups(docs, per_round=16).collect()
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found)
    assert got == groups_of(rows)
    assert len({component for _, _, component in got}) > 1
    # All pairs would be 79,800.
    assert sum(asked) < 20 * len(rows)


def test_no_documents(spark):
    assert ngram_join.groups(empty(spark)).count() == 0
    assert ngram_join.one_each(empty(spark)).count() == 0
    assert decontaminate.matches(empty(spark), empty(spark, "item_id")).count() == 0
    assert decontaminate.clean(empty(spark), empty(spark, "item_id")).count() == 0
    assert sharding.propagated(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = awkward(spark, FAMILIES + TEXTS)
    kept = ngram_join.one_each(docs)
    assert kept.columns == docs.columns
    names = [r["doc_id"] for r in kept.collect()]
    rows = FAMILIES + TEXTS
    found = brute.near_groups([text for _, text in rows])
    worded = {group for size, group in found if size}
    wordless = {row for row, (size, _) in zip(rows, found) if not size}
    assert len(names) == len(worded) + len(wordless)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 1), (20, 21), (5, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20}
    chain = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert {r["component"] for r in components.components(chain).collect()} == {0}


def words(n):
    return " ".join(rng.choice("abc") for _ in range(n))


ITEMS = [(k, words(rng.choice([0, 1, 2, 3, 4, 5, 6, 9, 10, 11, 14, 30]))) for k in range(14)]
ITEMS += [(50, None), (None, "É x-y É"), (3, ITEMS[4][1])]
CORPUS = [
    (k, " ".join(rng.choice(["a", "b", "c", "D"]) for _ in range(rng.choice([0, 1, 5, 30, 300]))))
    for k in range(120)
] + [(902, "é É X y É " + (ITEMS[12][1] + " ! ") * 60)]


@pytest.mark.parametrize("chosen", ["all", "long", "none"])
def test_contamination(spark, chosen):
    items = {"all": ITEMS, "long": [i for i in ITEMS if i[1] and len(i[1].split()) > 8], "none": []}[chosen]
    rows = CORPUS + TEXTS
    docs, bench = awkward(spark, rows), awkward(spark, items, "item_id")
    found = decontaminate.matches(docs, bench).collect()
    want = brute.contamination([text for _, text in rows], items)
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found) == Counter(
        (name, n, hit, tuple(names)) for (name, _), (n, hit, names) in zip(rows, want)
    )
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(
        name for (name, _), (_, hit, _) in zip(rows, want) if not hit
    )


SHARDED = [(k, "hot") for k in range(300)] + [(k, f"x{k // 3}") for k in range(300, 600)]
SHARDED += [(k, f"u{k}") for k in range(600, 901)] + TEXTS


@pytest.mark.parametrize("shards", [3, 40])
def test_shards(spark, shards):
    found = sharding.propagated(awkward(spark, SHARDED), shards).collect()

    def data(text):
        return (text or "").encode()

    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (name, len(data(t)) + 16, zlib.crc32(data(t))) for name, t in SHARDED
    )
    slots, groups = defaultdict(list), defaultdict(Counter)
    for row in found:
        slots[row["shard"]].append(row["slot"])
        groups[row["text_crc32"], row["size"]][row["shard"]] += 1
    sizes = [len(slots[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    linked = [own for own in groups.values() if sum(own.values()) > 1]
    together = sum(len(own) == 1 for own in linked)
    assert together > 0.7 * len(linked)  # at random, about one in shards squared would be
    hot = max(linked, key=lambda own: sum(own.values()))
    assert len(hot) < shards or shards == 3


def test_fewer_rows_than_shards(spark):
    found = sharding.propagated(awkward(spark, TEXTS[:4])).collect()
    assert len(found) == 4 and len({r["shard"] for r in found}) == 4


@pytest.mark.parametrize(("copies", "percent"), [(2, 60), (5, 30), (5, 60), (7, 45)])
def test_groups_that_fit_stay_whole(spark, copies, percent):
    n = 8000
    linked = n * percent // 100 // copies * copies
    text = f"CASE WHEN id < {linked} THEN concat('copy ', id DIV {copies}) ELSE concat('own ', id) END"
    docs = spark.range(n).selectExpr("id AS doc_id", f"{text} AS text")
    found = sharding.propagated(docs).collect()
    assert set(Counter(r["shard"] for r in found).values()) == {n // sharding.SHARDS}
    homes = defaultdict(set)
    for r in found:
        if r["doc_id"] < linked:
            homes[r["doc_id"] // copies].add(r["shard"])
    assert sum(len(shards) > 1 for shards in homes.values()) == 0


def test_buckets_follow_the_ngrams(spark, monkeypatch):
    assert ngram_join._buckets(0) == ngram_join.BUCKETS
    many = 5_000_000_000
    assert many / ngram_join._buckets(many) <= ngram_join.PER_BUCKET
    used = []
    made = ngram_join._index
    monkeypatch.setattr(ngram_join, "_index", lambda *args: used.append(args[-1]) or made(*args))
    rows = FAMILIES[::3] + TEXTS
    for per_bucket in (10, 10**9):
        monkeypatch.setattr(ngram_join, "PER_BUCKET", per_bucket)
        found = ngram_join.groups(awkward(spark, rows)).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == groups_of(rows)
    assert used[0] > used[1] == ngram_join.BUCKETS
