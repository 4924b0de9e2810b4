"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import (
    bpe,
    collocations,
    decontaminate,
    license_scan,
    main_text,
    ngram_join,
    pii,
    quality_model,
    quality_rules,
    secret_scan,
    sharding,
    spelling,
    sql,
    token_files,
)
from blotter.llm.frames import table


BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(table(spark, sf_dir, "pages"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.by_document(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.expr(f"size(filter(spans, s -> s.base AND s.kind = '{kind}'))").cast("long").alias(f"n_{kind}")
        for kind in ("email", "ip", "card", "phone")
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded(docs, BYTE_BPE, decoded_col="decoded").select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: Scores from here on predict the label 1.
GOOD_SCORE = 0.3


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    found = quality_model.scored(docs, quality_model.fit(docs, labels))
    return found.withColumn("predicted", (F.col("score") >= GOOD_SCORE).cast("int"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.matches(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality_rules.passes(F.col("failures"), "base")).alias("base_failed"),
        quality_rules.passes(F.col("failures"), "v1").alias("kept"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.propagated(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    joined = [F.array_join(name, ",").alias(name) for name in ("base_labels", "labels")]
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score"
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.new_folder(spark)
    token_files.write(table(spark, sf_dir, "documents"), folder, WORD_BPE)
    return token_files.read_checksums(spark, folder)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.by_document(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.expr(f"size(filter(spans, s -> s.base AND s.kind = '{one.kind}'))").cast("long").alias(f"n_{one.kind}")
        for one in secret_scan.PATTERNS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        "op1_main_text": op1_main_text,
        "op2_pii": op2_pii,
        "op3_bpe": op3_bpe,
        "op4_quality_model": op4_quality_model,
        "op5_decontaminate": op5_decontaminate,
        "op6_ngram_join": op6_ngram_join,
        "op7_quality_rules": op7_quality_rules,
        "op8_sharding": op8_sharding,
        "op9_license_scan": op9_license_scan,
        "op10_token_files": op10_token_files,
        "op11_collocations": op11_collocations,
        "op12_secret_scan": op12_secret_scan,
        "op13_spelling": op13_spelling,
    }


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
