"""Inputs no operator may stumble over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = "Word one, two THREE. " * 4000 + "x" * 9000 + " a@b.cd 1.2.3.4 under the MIT license"

TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (None, "no id here, but words enough to be read as a text by all"),
    (None, None),
    (4, LONG),
    (5, "same text twice, and the same id as well, so rows are equal"),
    (5, "same text twice, and the same id as well, so rows are equal"),
    (6, "same text twice, and the same id as well, so rows are equal"),
    (7, "ünïcödé 日本語 \U0001f600 \u0000 \x1c é İ"),
]

# Names that operators use for columns of their own.
CLASHES = (
    "n_words spans ids start end kind key n grams first at bits component node label group size"
    " shard slot rows found number place w gram row_key _row _key _text _m _cuts _rest _blocks"
    " _place score held_out decoded id text_crc32 law failures n_chars s runs window item_id"
).split()


def awkward(spark: SparkSession, texts=TEXTS, id_col="doc_id", text_col="text") -> DataFrame:
    rows = spark.createDataFrame(texts, f"{id_col} long, {text_col} string").repartition(3)
    names = [name for name in CLASHES if name not in (id_col, text_col)]
    return rows.select("*", *[F.lit(None).cast("string").alias(name) for name in names])


def empty(spark: SparkSession, id_col="doc_id", text_col="text") -> DataFrame:
    return awkward(spark, [], id_col, text_col)
