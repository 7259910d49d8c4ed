"""Projections and column reshaping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep and order columns; an unknown name is an error."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop by name; unknown names are ignored."""
    return df.drop(*columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; source names that are absent are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def align_columns(df: DataFrame, columns: Mapping[str, str | T.DataType]) -> DataFrame:
    """Add each declared column that is missing as a typed null; extra columns are kept."""
    missing = {name: F.lit(None).cast(dtype) for name, dtype in columns.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def drop_falsy(df: DataFrame, record: str) -> DataFrame:
    """Drop null records and empty objects (a struct whose fields are all null)."""
    fields = [f.name for f in df.schema[record].dataType.fields]
    any_set = F.lit(False)
    for f in fields:
        any_set = any_set | F.col(record)[f].isNotNull()
    return df.where(F.col(record).isNotNull() & any_set)


def blank_nulls(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """the columns (all by default) to text, null -> '' (``fillna('')`` skips non-text columns,
    so cast first)."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns])
