"""Bounded, deterministic samples of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm._frames import doc_texts


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, where: Column | None = None,
                    label: str = "quality") -> DataFrame:
    """``doc_id, text, y``: for each class (``label`` 1 and 0) at most ``per_class`` rows,
    those with the lowest hash of doc_id. Labels that are null or neither 0 nor 1, or that have no
    document, teach nothing. Two bounded lists of ids are broadcast (``per_class`` longs each)."""
    lab = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    if where is not None:
        lab = lab.where(where)
    texts, parts = doc_texts(docs), []
    for y in (0, 1):
        ids = lab.where((F.col("y") == y) & F.col("doc_id").isNotNull()).distinct()
        ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        parts.append(ids)
    found = texts.join(F.broadcast(parts[0].unionAll(parts[1])), "doc_id")
    # rows that repeat a doc_id must not break the bound
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(2 * per_class)
