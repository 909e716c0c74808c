"""Registered queries of this package and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tessera_spark.llm import brown, conversations, decontaminate, fingerprints, hard_negatives, jaccard_join, mixing, oracle, pages, quality, secrets, sharding, substring_dedup, tokens
from tessera_spark.llm.common import table


def op1_brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_texts(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.shard(table(spark, sf_dir, "documents")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), file="word_bpe_49k.json")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(table(spark, sf_dir, "pages"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start_word", "stop_word", "edits")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    repository = F.concat_ws("/", "source", "lang")
    return secrets.digest(secrets.scan_secrets(docs, repository=repository))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(conversations.damaged(table(spark, sf_dir, "conversations")), absent="gone")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", hard_negatives.noisy_label(F.col("vec_id"), F.col("label")))
    return hard_negatives.mine(rows, anchor=F.col("vec_id") % 100 == 0)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_brown_scores": op1_brown_scores,
        "op2_quality_rules": op2_quality_rules,
        "op3_sharding": op3_sharding,
        "op4_token_counts": op4_token_counts,
        "op5_html_extraction": op5_html_extraction,
        "op6_decontaminate": op6_decontaminate,
        "op7_mixing": op7_mixing,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_secrets": op10_secrets,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_fingerprints": op12_fingerprints,
        "op13_hard_negatives": op13_hard_negatives,
        "pipeline": corpus_pipeline.run,
    }


def all_sql() -> dict[str, str]:
    return {
        "op3_sharding": oracle.SHARDING,
        "op7_mixing": oracle.MIXING,
        "op9_jaccard_join": oracle.JACCARD_JOIN,
        "op11_conversation_repair": oracle.CONVERSATION_REPAIR,
        "op12_fingerprints": oracle.FINGERPRINTS,
        "op13_hard_negatives": oracle.HARD_NEGATIVES,
    }
