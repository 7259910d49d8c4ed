"""A training-data pipeline over ``documents``: each stage reads what the one before it wrote.

Every stage but the last returns documents (all their columns); the last returns the mix: for each
document that is left, how many of its words are taken. Stages call the operators of
``ledgerflow.llm`` with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm.decontaminate import drop_contaminated
from ledgerflow.llm.line_dedup import drop_repeated_lines
from ledgerflow.llm.mixing import mix_sources
from ledgerflow.llm.quality_rules import keep_good
from ledgerflow.llm.simhash import keep_one_of_each
from ledgerflow.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the rules reject go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: repeated lines go, except in the document with the smallest doc_id."""
    return drop_repeated_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group of near copies stays."""
    return keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: sources are mixed to their target weights."""
    return mix_sources(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix", mix),
]

# The fitted quality model and the fingerprints are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
