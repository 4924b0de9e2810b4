"""What a stage of the pipeline holds at once, and what it leaves in Python workers."""

import ctypes
import re
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from blotter.llm.frames import BATCH, give_back, small_batches

STAGES = {name: stage for name, stage in corpus_pipeline.STAGES if name != "pii"}


@pytest.fixture
def unnamed(spark):
    """The session without limits of its own, also afterwards."""
    for key in BATCH:
        spark.conf.unset(key)
    yield spark
    for key in BATCH:
        spark.conf.unset(key)


@pytest.fixture
def folder(unnamed, tmp_path):
    items = unnamed.createDataFrame([("i", "a b c d e f g h i j")], "item_id string, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def largest_batch(spark, rows, width):
    """Rows and bytes of the largest batches that Python gets of so many texts of this length."""

    def measured(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    texts = spark.range(0, rows, 1, 1).select(F.repeat(F.lit("a"), width).alias("text"))
    return texts.mapInArrow(measured, "n bigint, size bigint").agg(F.max("n"), F.max("size")).first()


@pytest.mark.parametrize("name", STAGES)
def test_stages_take_few_texts_at_once(name, unnamed, folder):
    docs = unnamed.createDataFrame(
        [(1, "one two three", "en", "web", 13)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    STAGES[name](unnamed, docs, folder)
    assert largest_batch(unnamed, 3000, 10)[0] <= 1000
    assert largest_batch(unnamed, 900, 10_000)[1] <= (4 << 20) + 20_000


def test_limits_that_the_session_names_stay(unnamed):
    for key in BATCH:
        unnamed.conf.set(key, "7")
    small_batches(unnamed)
    assert {unnamed.conf.get(key) for key in BATCH} == {"7"}


@pytest.mark.skipif(
    sys.platform != "linux" or not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="not glibc"
)
def test_freed_memory_goes_back_to_the_system():
    def resident():
        with open("/proc/self/smaps_rollup") as file:
            return int(re.search(r"\nAnonymous:\s+(\d+)", file.read())[1]) / 1024

    held = [b"x" * 65_536 for _ in range(2000)]
    last = held.pop()  # lies above the others, so that they do not go back by themselves
    held.clear()
    before = resident()
    give_back()
    assert before - resident() > 80
    assert len(last) == 65_536
