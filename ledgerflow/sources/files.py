"""File sources: CSV snapshots (S4, S4n, S5, S10), JSON page envelopes (S7-S9), JSON text
and log lines (S12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalar import na_to_null
from ledgerflow.sources.quoted import SPLIT_BYTES, file_bytes, read_records

# Marker for a quoted empty cell (""), told apart from an unquoted empty cell (null) - S4n.
QUOTED_EMPTY = "\u0001"


def string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_csv_rows(spark: SparkSession, path: str, schema: T.StructType, header: bool, options: dict[str, str],
                  multiline: bool = True, split_bytes: int | None = SPLIT_BYTES) -> DataFrame:
    """Quoted CSV bound by position, FAILFAST. With ``multiline`` a cell may hold line breaks: Spark's
    reader then takes a file whole, in one task, so files over ``split_bytes`` are cut into records by
    many tasks first (``quoted``; the rows are the same). ``split_bytes=None`` never cuts."""
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"} | options
    if multiline and split_bytes is not None and max(file_bytes(spark, path), default=0) > split_bytes:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        cells = F.from_csv(F.col("record"), ddl, options | {"multiLine": "true", "lineSep": "\n"})
        return read_records(spark, path, header, split_bytes).select(cells.alias("_r")).select("_r.*")
    return spark.read.schema(schema).options(**options).option("header", header).option("enforceSchema", True).option("multiLine", multiline).csv(path)


def read_snapshot_csv(spark: SparkSession, path: str, schema: T.StructType | str,
                      multiline: bool = True, keep_quoted_empty: bool = True, split_bytes: int | None = SPLIT_BYTES) -> DataFrame:
    """S4/S4n/Q4: headed comma CSV bound **by position** to a declared schema (header skipped),
    RFC-4180 quoting (doubled quotes, quoted line breaks), FAILFAST on a malformed row.
    Unquoted empty -> null, quoted empty -> '' (``keep_quoted_empty``).
    ``multiline`` must stay on when a cell may hold a line break (``read_csv_rows``)."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    df = read_csv_rows(spark, path, schema, True, {"emptyValue": QUOTED_EMPTY} if keep_quoted_empty else {}, multiline, split_bytes)
    if not keep_quoted_empty:
        return df
    fixed = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c == QUOTED_EMPTY, F.lit("")).otherwise(c)
        fixed.append(c.alias(f.name))
    return df.select(*fixed)


def read_headless_csv(spark: SparkSession, path: str, names: Sequence[str], sep: str = ";",
                      na_tokens: bool = True, multiline: bool = True, split_bytes: int | None = SPLIT_BYTES) -> DataFrame:
    """Headless delimited text, every column a string, pandas NA tokens -> null. Quoting as
    in S4 (doubled quotes, quoted separators and line breaks; ``multiline`` as there)."""
    df = read_csv_rows(spark, path, string_schema(names), False, {"sep": sep, "emptyValue": ""}, multiline, split_bytes)
    if not na_tokens:
        return df
    return df.select(*[na_to_null(F.col(f"`{n}`")).alias(n) for n in names])


def read_string_csv(spark: SparkSession, path: str, names: Sequence[str], na_tokens: bool = True,
                    multiline: bool = True, split_bytes: int | None = SPLIT_BYTES) -> DataFrame:
    """Headed CSV re-read with every column a string (no inference) + NA tokens; quoting as S4."""
    df = read_csv_rows(spark, path, string_schema(names), True, {}, multiline, split_bytes)
    if not na_tokens:
        return df
    return df.select(*[na_to_null(F.col(f"`{n}`")).alias(n) for n in names])


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed page envelopes (one JSON object per line/file) with a declared schema."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_array_pages(spark: SparkSession, path: str, schema: T.StructType | str, one_page_per_file: bool = False) -> DataFrame:
    """Landed pages whose root is a JSON array: one row per element, union of all pages.
    Pages are one per line (splittable) unless ``one_page_per_file`` (a pretty-printed array per
    file, read whole)."""
    return spark.read.schema(schema).option("multiLine", one_page_per_file).option("mode", "FAILFAST").json(path)


def check_short_page(spark: SparkSession, path: str, page_rows: int) -> None:
    """A client asks for pages until one is not full, so exactly one landed page (one per line)
    may hold fewer than ``page_rows`` elements, an empty one included, and none may hold more."""
    size = F.coalesce(F.json_array_length("value"), F.lit(-1))
    got = spark.read.text(path).agg(F.count(F.lit(1)).alias("pages"), F.sum((size < page_rows).cast("int")).alias("short"),
                                    F.max(size).alias("most"), F.min(size).alias("least")).first()
    if got["short"] != 1 or got["most"] > page_rows or got["least"] < 0:
        raise ValueError(f"incomplete pages: {got.asDict()}")


def records(envelopes: DataFrame, data: str = "data") -> DataFrame:
    """The union of every page's records (``explode`` of the data list)."""
    return envelopes.select(F.explode(F.col(data)).alias("_r")).select("_r.*")


def parse_json_column(c: str | Column, schema: T.StructType | str) -> Column:
    """JSON text -> struct with forced types (a code declared STRING keeps leading zeros)."""
    return F.from_json(F.col(c) if isinstance(c, str) else c, schema, {"mode": "FAILFAST"})
