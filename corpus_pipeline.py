"""The corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes what the one before kept, and all but the last return the columns of
`documents`. run() applies them in turn.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import bpe, decontaminate, ngram_join, pii, quality_rules
from blotter.llm.frames import shared_folder, small_batches, table

#: The tokenizer file.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that fail a quality rule of policy v1."""
    small_batches(spark)
    return quality_rules.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    small_batches(spark)
    return ngram_join.one_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of a benchmark item."""
    small_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind; n_chars follows the text."""
    return pii.masked(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the texts. Per document: its id, language and source, and its ids.

    `exact` says whether decoding the ids gives the text back.
    """
    small_batches(spark)
    encoded = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), TOKENIZER, decoded_col="decoded")
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )


STAGES = [
    ("quality_rules", rules),
    ("near_copies", near_copies),
    ("decontamination", benchmark_free),
    ("pii", without_pii),
    ("tokens", tokens),
]

#: SQL has no tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{number}-{name}")
            docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
