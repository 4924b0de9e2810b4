"""The registered queries, and the pipeline's stages."""

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from blotter.llm import queries
from tests.llm import brute
from tests.llm.awkward import awkward
from tests.parity import assert_same_rows, duckdb_on

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "page_id bigint, url string, text string, n_chars bigint",
    "op2": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op3": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op4": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op6": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op7": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op9": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
    " labels string, score double",
    "op10": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op11": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op12": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op13": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}
BY_NUMBER = {name.split("_")[0]: name for name in queries.queries()}


def test_all_are_registered():
    assert BY_NUMBER.keys() == COLUMNS.keys()
    assert {*queries.queries(), "pipeline"} <= registry.queries().keys()
    assert queries.oracle_sql().keys() <= registry.oracle_sql().keys()


@pytest.mark.parametrize("number", COLUMNS)
def test_columns_and_rows(spark, number):
    found = queries.queries()[BY_NUMBER[number]](spark, SMALL)
    assert ", ".join(f"{name} {kind}" for name, kind in found.dtypes) == COLUMNS[number]
    if number in ("op11", "op13"):  # rows are phrases and words; test_sql_agrees counts them
        return
    given = "pages" if number == "op1" else "documents"
    assert found.count() == spark.read.parquet(f"{SMALL}/{given}.parquet").count()


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_sql_agrees(spark, name):
    con = duckdb_on(SF_DIR)
    assert assert_same_rows(queries.queries()[name](spark, SF_DIR), con, queries.oracle_sql()[name]) > 0


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SMALL)
        out.append(kept.collect())
        docs = spark.createDataFrame(out[-1], kept.schema)
    return out


def test_stages_take_what_the_one_before_kept(spark, stages):
    given, ruled, once, clean, hidden, tokens = stages
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_copies", "decontamination", "pii", "tokens"]
    for before, after in zip(stages, stages[1:5]):
        assert after[0].__fields__ == before[0].__fields__

    bad = {r["doc_id"] for r in given} - {r["doc_id"] for r in ruled}
    base = {r["doc_id"] for r in given
            if (m := brute.measures(r["text"]))[0] < 10 or 100 * m[4] > 20 * m[0]}
    assert base <= bad and len(bad) < len(given) / 3

    groups = brute.near_groups([r["text"] for r in ruled])
    least = {}
    for row, (_, group) in zip(ruled, groups):
        least[group] = min(row["doc_id"], least.get(group, row["doc_id"]))
    assert sorted(r["doc_id"] for r in once) == sorted(least.values())

    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.contamination([r["text"] for r in once], items)
    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for r, h in zip(once, hits) if not h[1])
    assert len(clean) < len(once)

    assert [r["doc_id"] for r in sorted(hidden)] == [r["doc_id"] for r in sorted(clean)]
    texts = {r["doc_id"]: r["text"] for r in clean}
    assert any("[EMAIL]" in r["text"] for r in hidden)
    for row in hidden:
        assert not brute.base_spans(row["text"]) and row["n_chars"] == len(row["text"])
        if not brute.base_spans(texts[row["doc_id"]]) and "[" not in row["text"]:
            assert row["text"] == texts[row["doc_id"]]
    assert {r["doc_id"] for r in tokens} == {r["doc_id"] for r in hidden}
    assert all(r["exact"] and r["n_tokens"] == len(r["ids"]) // 4 for r in tokens)


def test_run_is_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, SMALL)
    assert sorted(found.collect()) == sorted(stages[-1])


def test_stages_of_awkward_documents(spark):
    docs = awkward(spark).select("doc_id", "text", "kind", "n_chars").toDF(
        "doc_id", "text", "lang", "n_chars"
    )
    docs = docs.selectExpr("doc_id", "text", "lang", "lang AS source", "CAST(n_chars AS BIGINT) AS n_chars")
    for some in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, some, SMALL)
            assert kept.columns == docs.columns
            assert kept.count() <= some.count()
