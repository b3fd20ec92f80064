"""The registered queries opN_<name>: each applies its operator, with
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import (
    decontaminate,
    divergence,
    language,
    lines,
    mixing,
    neighbours,
    packing,
    pii,
    quality,
    rules,
    simhash,
    spelling,
    toxicity,
)
from wayfare.llm.common import held_out, table
from wayfare.llm.oracle import ORACLE  # noqa: F401  (registered beside QUERIES)


def op1_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mixing.mix(docs, keep=["doc_id", "source"]).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = pii.find_personal_data(docs, pii.train(pii.labelled_table(spark)))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")


def op4_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.hex_code(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "lang_spans")


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), keep_text=False)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return rules.apply_rules(docs, keep=["doc_id"]).select("doc_id", *rules.METRICS, "base_failed", "kept", "n_removed_words")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.find_benchmark_words(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        listed.alias("items_sha256"), "contaminated")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergences(table(spark, sf_dir, "documents", "text", "lang", "source"))


QUERIES = {f.__name__: f for f in (
    op1_quality_mil, op2_mix_sources, op3_personal_data, op4_toxicity_gru, op5_simhash, op6_language, op7_pack,
    op8_quality_rules, op9_embedding_dedup, op10_line_dedup, op11_decontaminate, op12_spelling, op13_divergence)}
