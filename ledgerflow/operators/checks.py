"""Data checks (Q1-Q3, A3; Q4 is the FAILFAST mode of the readers). Each check is one aggregate pass; failures raise ``DataCheckError``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class DataCheckError(ValueError):
    pass


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Q1 (lazy form): keys seen more than once, null keys excluded (they never conflict).
    The per-key count is a partial (map-side) aggregate, so a hot key is pre-combined."""
    keys = _keys(key)
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    return df.where(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, key: str | Sequence[str], what: str = "key") -> None:
    """Q1/Q3: raise when a key repeats. One aggregate over all rows, combined before the shuffle."""
    dup = duplicate_keys(df, key).limit(1).collect()
    if dup:
        raise DataCheckError(f"duplicate {what} {_keys(key)}: {dup[0].asDict()}")


def assert_many_to_one(right: DataFrame, key: str | Sequence[str]) -> None:
    """Q3: the look-up side of a left join must be unique on its key."""
    assert_unique(right, key, "look-up key")


def assert_required(df: DataFrame, columns: Iterable[str]) -> None:
    """Q2: required columns hold no null (single aggregate pass)."""
    cols = list(columns)
    row = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]).first()
    bad = {c: row[c] for c in cols if row[c]}
    if bad:
        raise DataCheckError(f"null values in required columns: {bad}")


def check_summary(df: DataFrame, key: str, columns: Iterable[str], name: str) -> DataFrame:
    """Q1+Q2+A3 in one pass: rows, duplicate keys and per-column null counts as one row.
    Stage 1 pre-aggregates per key (map-side combine); stage 2 folds keys into one row."""
    cols = list(columns)
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(f"_null_{c}") for c in cols],
    )
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.sum("_n").cast("bigint").alias("n_rows"),
        F.sum(F.when(F.col(key).isNotNull() & (F.col("_n") > 1), 1).otherwise(0)).cast("bigint").alias("n_dup_keys"),
        *[F.sum(f"_null_{c}").cast("bigint").alias(f"n_null_{c}") for c in cols],
    )


def observe_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A3: row count collected while the data flows to its sink (no extra scan)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
