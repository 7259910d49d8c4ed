"""The registered queries of this subpackage: operator N as ``opN_<name>`` over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import centroids, decontaminate, line_dedup, mixing, substring_dedup, suffix_dedup

QueryFn = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ledgerflow.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerflow.llm.quality_rules import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerflow.llm.quality_classifier import quality_classifier
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_digest(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerflow.llm.lm_score import lm_scores
    return lm_scores(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digest(table(spark, sf_dir, "documents"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerflow.llm.simhash import simhash_digest
    return simhash_digest(table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerflow.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, sf_dir, "embeddings"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerflow.llm.turn_repair import repair_conversations
    return repair_conversations(table(spark, sf_dir, "conversations"))


QUERIES: list[QueryFn] = [op1_token_counts, op2_suffix_dedup, op3_line_dedup, op4_quality_rules, op5_quality_classifier, op6_lm_score,
                          op7_decontamination, op8_substring_dedup, op9_simhash_dedup, op10_source_mix, op11_toxicity, op12_centroid_clusters, op13_turn_repair]
ORACLE_SQL: dict[str, str] = {"op3_line_dedup": line_dedup.ORACLE, "op7_decontamination": decontaminate.ORACLE, "op10_source_mix": mixing.ORACLE,
                              "op12_centroid_clusters": centroids.ORACLE,
                              "op2_suffix_dedup": suffix_dedup.ORACLE, "op8_substring_dedup": substring_dedup.ORACLE}


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {k: v.strip() for k, v in ORACLE_SQL.items()}
