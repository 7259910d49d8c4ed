"""Table scans (S1-S3). Column pruning and filter pushdown reach the Parquet scan because every
job is declared lazily on top of these readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Full scan of one table stored as ``<base>/<name>.parquet``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, base: str, names=DRIVER_TABLES, prefix: str = "") -> dict[str, str]:
    """S3: expose a set of tables to SQL text (read-only) under ``prefix + name``."""
    views = {}
    for n in names:
        view = f"{prefix}{n}"
        read_table(spark, base, n).createOrReplaceTempView(view)
        views[n] = view
    return views


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              partitions: int = 64, properties: dict | None = None) -> DataFrame:
    """S2/S3 against a database: read in parallel slices of ``partition_column``, so never over one
    connection for the whole table. (No database is at hand here: untested.)"""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
                   .option("partitionColumn", partition_column).option("lowerBound", lower)
                   .option("upperBound", upper).option("numPartitions", partitions))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()
