"""Aggregates: first/last by order (A4), summary statistics with exact quartiles (A5; pandas
``describe`` interpolates linearly between order statistics). No column is gathered in one task."""

from __future__ import annotations

import math
import struct
from collections import Counter
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DESCRIBE_PROBS = (0.25, 0.5, 0.75)


def first_last(df: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """A4: min, max, and the value on the first and the last row in ``order`` (one pass)."""
    key = F.struct(*[F.col(c) for c in order])
    return df.agg(F.min(value).alias("min"), F.max(value).alias("max"),
                  F.min_by(value, key).alias("first"), F.max_by(value, key).alias("last"))


SIGN = (1 << 63) - 1
DIGIT_BITS = 16  # of an ordered key, told apart in one round


def ordered_key(value: Column) -> Column:
    """A double as a long of the same order (its bits, those of a negative number flipped)."""
    bits = F.call_function("reflect", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("bigint")  # -0.0 is 0.0
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(SIGN)))


def _value_of(key: int) -> float:
    return struct.unpack("<d", struct.pack("<q", key if key >= 0 else key ^ SIGN))[0]


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, dict[float, float | None]]:
    """Linear-interpolated quantiles of the non-null values of numeric columns, all in one go.

    Radix selection: a round counts the values of each column by the next 16 bits of their ordered
    key, within the prefixes that hold a wanted position, and keeps the bins that hold one. Only
    these counts are shuffled, combined in the tasks first: at most 2^16 for a prefix, however many
    rows or different values there are. A bin whose least and greatest key are one value is done; at
    the latest the fourth round is."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns]))
    keys = df.select(cells.alias("r")).select("r.*").where(F.col("value").isNotNull()).select("name", ordered_key(F.col("value")).alias("key"))
    keys = keys.persist(StorageLevel.MEMORY_AND_DISK)
    spark, found, total = df.sparkSession, {}, {}
    wanted: dict[tuple[str, int], list[tuple[int, int]]] = {}  # (column, prefix) -> (position, position in the prefix)
    try:
        for round_no in range(64 // DIGIT_BITS):
            shift = 64 - DIGIT_BITS * (round_no + 1)
            bins = keys.select("name", "key", F.shiftright("key", shift).alias("bin"))
            if round_no:
                # a few prefixes for each column
                look = spark.createDataFrame(list(wanted), "name string, prefix bigint")
                bins = bins.withColumn("prefix", F.shiftright("bin", DIGIT_BITS)).join(F.broadcast(look), ["name", "prefix"])
            counted = bins.groupBy("name", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()
            if not round_no:
                for c in columns:
                    total[c] = sum(r["n"] for r in counted if r["name"] == c)
                    if total[c]:
                        wanted[c, 0] = [(i, i) for i in sorted({f(p * (total[c] - 1)) for p in probs for f in (math.floor, math.ceil)})]
            seen, narrowed = Counter(), {}
            for r in sorted(counted, key=lambda r: (r["name"], r["bin"])):
                group = (r["name"], r["bin"] >> DIGIT_BITS if round_no else 0)
                before = seen[group]
                seen[group] += r["n"]
                inside = [(i, at - before) for i, at in wanted[group] if before <= at < seen[group]]
                if inside and r["lo"] == r["hi"]:
                    found |= {(r["name"], i): _value_of(r["lo"]) for i, _ in inside}
                elif inside:
                    narrowed[r["name"], r["bin"]] = inside
            wanted = narrowed
            if not wanted:
                break
    finally:
        keys.unpersist()
    out: dict[str, dict[float, float | None]] = {}
    for c in columns:
        out[c] = {}
        for p in probs:
            h = p * (total[c] - 1)
            lo, hi = math.floor(h), math.ceil(h)
            out[c][p] = None if not total[c] else found[c, lo] + (h - lo) * (found[c, hi] - found[c, lo])
    return out


def describe(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """A5: ``count, mean, std, min, 25%, 50%, 75%, max`` per numeric column, long format
    ``(column, stat, value)``. Moments come from one aggregate pass over all columns."""
    spark = df.sparkSession
    moments = df.agg(*[e for c in columns for e in (
        F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
        F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"))]).first()
    quantiles = exact_quantiles(df, columns, DESCRIBE_PROBS)
    rows = []
    for c in columns:
        n = moments[f"{c}__count"]
        q = quantiles[c]
        stats = [("count", float(n)), ("mean", moments[f"{c}__mean"]), ("std", moments[f"{c}__std"]),
                 ("min", moments[f"{c}__min"]), ("25%", q[0.25]), ("50%", q[0.5]), ("75%", q[0.75]),
                 ("max", moments[f"{c}__max"])]
        rows += [(c, s, None if v is None else round(float(v), digits)) for s, v in stats]
    return spark.createDataFrame(rows, "column string, stat string, value double")
