"""Incremental forms (I1, I2, I5) on Structured Streaming.

The streaming checkpoint replaces the reference's date watermark: each landed file is taken
exactly once; ``trigger(availableNow=True)`` processes what has landed and stops (a scheduled
batch run), a processing-time trigger keeps it running. Every micro-batch writes a new table
version named after the stream and the batch, so a replayed batch rewrites the same folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalar import as_text, log_level, log_tag, rstrip_ws
from ledgerflow.operators.checks import assert_unique
from ledgerflow.operators.joins import BROADCAST_BYTES, upsert
from ledgerflow.sinks.keyed import KeyedStore, Transaction
from ledgerflow.sinks.writers import current_version, drop_old_versions, publish


def merge_landings(df: DataFrame, key: str, sequence: str, update_columns: Sequence[str]) -> DataFrame:
    """Several landings as one change per key, with what running them one by one would leave: update
    columns take the value of the last landing, any other column that of the first (a later landing
    finds the row there). A key repeated inside one landing is an error. Rows without a key never
    conflict, so all of them stay."""
    keyed = df.where(F.col(key).isNotNull())
    assert_unique(keyed, [key, sequence], "key within one landing")
    last = [c for c in df.columns if c in set(update_columns) - {key}]
    first = [c for c in df.columns if c not in last and c != key]
    picks = [f(F.struct(*[F.col(c) for c in cols]), F.col(sequence)).alias(name)
             for f, cols, name in ((F.max_by, last, "_last"), (F.min_by, first, "_first")) if cols]
    merged = keyed.groupBy(key).agg(*picks)
    out = {key: F.col(key)} | {c: F.col("_last")[c] for c in last} | {c: F.col("_first")[c] for c in first}
    return merged.select(*[out[c].alias(c) for c in df.columns]).unionByName(df.where(F.col(key).isNull()))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when its checkpoint was made: another checkpoint, or one made
    anew at the same path, is another stream whose batches start at 0 again."""
    line = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return json.loads(line)["id"]


def upsert_batch(table_path: str, key: str, update_columns: Sequence[str], sequence: str, checkpoint: str,
                 small_source_bytes: int | None = BROADCAST_BYTES, keep_versions: int = 3) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: J6 upsert of one micro-batch into the published table. The version is
    named after the stream and the batch, so only a true replay is skipped."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = f"v={stream_id(spark, checkpoint)}-{batch_id:010d}"
        current = current_version(spark, table_path)
        if current == version:
            return  # replay of a batch already published: the upsert is idempotent, nothing to do
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read the landed files once per batch
        source = None
        try:
            if batch.isEmpty():
                return
            target = spark.read.parquet(f"{table_path}/{current}")
            source = merge_landings(batch, key, sequence, update_columns).select(*target.columns).persist(StorageLevel.MEMORY_AND_DISK)
            # merge_landings already guarantees one row per key
            merged = upsert(target, source, key, update_columns, check_source=False, small_source_bytes=small_source_bytes)
            publish(merged, table_path, version)
            drop_old_versions(spark, table_path, keep_versions)
        finally:
            batch.unpersist()
            if source is not None:
                source.unpersist()
    return run


def upsert_buckets(store: KeyedStore, table: str, update_columns: Sequence[str], sequence: str, checkpoint: str,
                   keep_commits: int = 3) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: J6 upsert of one micro-batch into a keyed table, rewriting the buckets
    that its keys touch. The batch's number is part of the commit, so a replay finds itself done."""
    def run(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(batch.sparkSession, checkpoint)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read the landed files once per batch
        try:
            if batch.isEmpty():
                return

            def work(txn: Transaction) -> None:
                if txn.seen(stream, batch_id):
                    return
                key = store.snapshot()["tables"][table]["key"]
                # merge_landings already guarantees one row per key
                txn.upsert(table, merge_landings(batch, key, sequence, update_columns), update_columns, check_source=False)
                txn.at_batch(stream, batch_id)

            store.run(work)
            store.vacuum(keep_commits)
        finally:
            batch.unpersist()
    return run


def run_keyed_stream(spark: SparkSession, landing: str, schema: T.StructType | str, store: KeyedStore, table: str,
                     update_columns: Sequence[str], sequence: str, checkpoint: str, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> None:
    """Landed change files -> upsert into a keyed table, until everything landed is processed."""
    _run_batches(spark, landing, schema, upsert_buckets(store, table, update_columns, sequence, checkpoint), checkpoint, fmt, max_files_per_trigger)


def run_upsert_stream(spark: SparkSession, landing: str, schema: T.StructType | str, table_path: str,
                      key: str, update_columns: Sequence[str], sequence: str, checkpoint: str,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None) -> None:
    """Landed change files -> upsert into the published table, until everything landed is processed."""
    _run_batches(spark, landing, schema, upsert_batch(table_path, key, update_columns, sequence, checkpoint), checkpoint, fmt, max_files_per_trigger)


def _run_batches(spark: SparkSession, landing: str, schema: T.StructType | str, body: Callable[[DataFrame, int], None],
                 checkpoint: str, fmt: str, max_files_per_trigger: int | None) -> None:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = reader.load(landing).writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def tag_log_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text (or bytes) lines -> right-trimmed non-empty lines with their
    tag and effective log level. Stateless, so it runs the same in batch and streaming."""
    dtype = lines.schema[column].dataType.typeName()
    text = rstrip_ws(as_text(F.col(column), dtype))
    out = lines.select(text.alias("line")).where(F.length("line") > 0)
    return out.select("line", log_tag("line").alias("tag"), log_level("line").alias("level"))


def run_log_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                   max_files_per_trigger: int | None = None) -> None:
    """S12 + I5: lines of new text files -> tagged rows appended to a Parquet sink."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (tag_log_lines(reader.load(landing)).writeStream.format("parquet").outputMode("append")
         .option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
