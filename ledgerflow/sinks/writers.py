"""Sinks (K1-K9). Tables are published as a new version folder and then pointed at, so readers
never see half a table and a path being read is never overwritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ledgerflow.sinks.commits import CommitConflict, CommitLog, Folder


class SchemaMismatch(ValueError):
    pass


def _missing(e: AnalysisException) -> bool:
    """Whether a read failed because its path isn't there; any other failure is one."""
    return (e.getCondition() or "").startswith("PATH_NOT_FOUND")


def _read_schema(spark: SparkSession, path: str) -> T.StructType | None:
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as e:
        if _missing(e):
            return None
        raise


def _pointers(spark: SparkSession, table_path: str) -> CommitLog:
    return CommitLog(spark, f"{table_path}/pointers")


ANY = object()  # whatever version is published


def _point_to(spark: SparkSession, table_path: str, version: str, expected: object = ANY) -> None:
    """Adds the next pointer, which only one writer can; none is ever rewritten, so a reader always
    finds the newest whole one. A writer that comes second tries the number after, unless the
    version it started from (``expected``, None: no table) is no longer the published one."""
    log = _pointers(spark, table_path)
    while True:
        number, now = log.latest()
        if expected is not ANY and now.get("version") != expected:
            raise CommitConflict(f"{table_path} is at {now.get('version')}, not at {expected}")
        versions = [v for v in now.get("versions", []) if v != version] + [version]
        if log.put({"version": version, "versions": versions}, number, now):
            log.compact()
            return


def current_version(spark: SparkSession, table_path: str) -> str | None:
    """The published version folder of a table written by ``publish`` (None if never written)."""
    return _pointers(spark, table_path).latest()[1].get("version")


def drop_old_versions(spark: SparkSession, table_path: str, keep: int = 3) -> list[str]:
    """Deletes the folders of versions published before the last ``keep``; returns their names.
    Readers that still hold an older version than that lose it, so keep as many as runs overlap."""
    log = _pointers(spark, table_path)
    while True:
        number, now = log.latest()
        versions = now.get("versions", [])
        old = versions[:-max(1, keep)]
        if not old or log.put(now | {"versions": versions[len(old):]}, number, now):
            break
    folder = Folder(spark, table_path)
    for v in old:
        folder.delete(v)
    log.compact()
    return old[::-1]


def read_published(spark: SparkSession, table_path: str, schema: T.StructType | None = None) -> DataFrame | None:
    v = current_version(spark, table_path)
    if v is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{table_path}/{v}")


def publish(df: DataFrame, table_path: str, version: str, partition_by: Sequence[str] = (),
            compression: str = "zstd", expected: object = ANY) -> str:
    """K1: replace a table: write ``<table>/<version>`` (a retried write of the same version
    overwrites only that folder), then add a pointer to it. With ``expected``, the version that the
    new one was made from (None: no table yet), a table that another writer has published in the
    meantime is left as it is and ``CommitConflict`` is raised."""
    w = _whole(df, compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{table_path}/{version}")
    _point_to(df.sparkSession, table_path, version, expected)
    return version


def _whole(df: DataFrame, compression: str) -> DataFrameWriter:
    """A writer that replaces all of its path, whatever the session's overwrite mode is."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", compression)


def truncate_load(df: DataFrame, table_path: str, version: str, schema: T.StructType,
                  force_recreate: bool = False) -> str:
    """K3: reload with the declared schema kept. The incoming frame must have exactly the declared
    columns; unless ``force_recreate``, its types and the existing table's must be the declared
    ones too (with it, values are cast)."""
    spark = df.sparkSession
    declared = [(f.name, f.dataType) for f in schema]
    if sorted(df.columns) != sorted(schema.names):
        raise SchemaMismatch(f"columns {df.columns} are not the declared {schema.names}")
    if not force_recreate:
        if any(df.schema[name].dataType != kind for name, kind in declared):
            raise SchemaMismatch(f"incoming {df.schema.simpleString()} differs from the declared {schema.simpleString()}")
        old = read_published(spark, table_path)
        if old is not None and [(f.name, f.dataType) for f in old.schema] != declared:
            raise SchemaMismatch("existing table schema differs from the declared schema")
    return publish(df.select(*[F.col(f"`{n}`").cast(k).alias(n) for n, k in declared]), table_path, version)


def append_checked(df: DataFrame, path: str) -> bool:
    """K2 + P17: append rows when there are any; an existing table with a different schema
    (unknown or missing columns, other types) is an error. Returns whether rows were written."""
    spark = df.sparkSession
    existing = _read_schema(spark, path)
    if existing is not None:
        if [(f.name, f.dataType) for f in existing] != [(f.name, f.dataType) for f in df.schema]:
            raise SchemaMismatch(f"cannot append {df.schema.simpleString()} to {existing.simpleString()}")
    if df.isEmpty():
        return False
    df.write.mode("append").parquet(path)
    return True


def export_parquet(df: DataFrame, path: str, compression: str = "zstd") -> None:
    """K4: full copy as Parquet (zstd), overwriting."""
    _whole(df, compression).parquet(path)


def export_by_bucket(df: DataFrame, path: str, bucket: str, compression: str = "zstd",
                     max_records_per_file: int = 5_000_000) -> None:
    """K5: one write partitioned by the year bucket (nulls land in the default partition, so the
    full copy is the whole folder and a yearly copy is one partition); buckets of an earlier export
    vanish. The rebalance by bucket makes few files for small buckets and lets Spark split a bucket
    that holds a third of the rows."""
    _whole(df.hint("rebalance", bucket), compression) \
        .option("maxRecordsPerFile", max_records_per_file).partitionBy(bucket).parquet(path)


def publish_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """K6/K6i: header CSV, values verbatim (blanks kept), an empty cell for null and for empty
    text, ISO dates/timestamps. Directory output by default; ``single_file`` (one task) only for
    small publications."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("dateFormat", "yyyy-MM-dd").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS")
        .csv(path))


def write_interval(df: DataFrame, path: str, label: str, interval_column: str = "interval") -> None:
    """K9: rows of one run interval; a re-run replaces its own interval partition, also when it
    has no rows. A row of another interval is an error."""
    if interval_column in df.columns:
        other = ~F.col(interval_column).eqNullSafe(F.lit(label))
        df = df.where(F.when(other, F.raise_error(F.lit(f"row outside interval {label}"))).otherwise(F.lit(True))).drop(interval_column)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{interval_column}={label}")


def outbox(df: DataFrame, key: str, payload) -> DataFrame:
    """K8: one JSON payload per key, as rows of an outbox table (sending is outside Spark)."""
    return df.select(F.col(key), F.to_json(payload).alias("payload"))
