"""Small helpers the operators share: their input frames and bounded Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Python workers get Arrow batches of about 4 MB of texts, however long the texts are (one
    longer text makes a batch of its own)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id BIGINT, text STRING`` of a documents frame, whatever other columns it has."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


RANGE_BYTES = 32 << 20


def ranges_for(texts: DataFrame, range_bytes: int = RANGE_BYTES) -> int:
    """How many ranges of hashes to deal to: the session's shuffle partitions, or more when a range
    would stand for over ``range_bytes`` of text, since a task holds the packed data of one range."""
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint")).alias("n")).first()["n"] or 0
    return max(shuffle_partitions(texts.sparkSession), -(-size // range_bytes))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
