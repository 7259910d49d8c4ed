"""Ordinal operators (W1, W2): contiguous row numbers and the reload point.

Rows are numbered without ever standing in one task and without being written in between. A sample
of the order columns gives range bounds, which become literals of the plan: the range a row belongs
to is then a plain expression of the row, the same in every evaluation. So the rows of each range
can be counted by one cheap aggregate and numbered by a sort within the range, in separate passes.

``MAX_RANGES`` bounds the literals; a range is sorted externally by Spark, whatever its size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.session import shuffle_partitions

MAX_RANGES = 1024
SAMPLES_PER_RANGE = 40   # expected rows of the bounds' sample for each range
_HASHES = 1 << 30


@dataclass(frozen=True)
class Ranges:
    """``bounds`` in ascending order: each a list of literals, one for each order column."""
    columns: tuple[str, ...]
    bounds: list[list[Column | None]]
    values: list[tuple]

    @property
    def number(self) -> Column:
        """The range of a row: how many bounds are not above it (a decision tree of literals)."""
        def below(bound: list[Column | None]) -> Column:
            out = F.lit(False)
            for name, b in reversed(list(zip(self.columns, bound, strict=True))):
                c = F.col(f"`{name}`")
                if b is None:  # nulls come first: nothing is below one
                    out = c.isNull() & out
                else:
                    out = c.isNull() | (c < b) | ((c == b) & out)
            return out

        def tree(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(below(self.bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

        return tree(0, len(self.bounds))


def ranges_of(df: DataFrame, columns: Sequence[str], num_ranges: int | None = None) -> Ranges:
    """Range bounds of ``df`` in ascending order of ``columns`` (nulls first), from the rows with the
    lowest hashes of those columns: about ``SAMPLES_PER_RANGE`` rows for each range come to the
    driver, as text, and only so many literals go back."""
    n = min(num_ranges or shuffle_partitions(df.sparkSession), MAX_RANGES)
    total = df.count()
    if n < 2 or total < 2:
        return Ranges(tuple(columns), [], [])
    share = min(1.0, SAMPLES_PER_RANGE * n / total)
    keys = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)])
    kinds = [keys.schema[i].dataType for i in range(len(columns))]
    picked = keys.where(F.pmod(F.xxhash64(*keys.columns), F.lit(_HASHES)) <= int(share * _HASHES))
    # as text and back, so that the order is that of the literals
    text = picked.select(*[F.col(c).cast("string").alias(c) for c in keys.columns]).distinct()
    back = [F.col(c).cast(k) for c, k in zip(keys.columns, kinds, strict=True)]
    rows = [tuple(r) for r in text.orderBy(*back).collect()]
    cuts = list(dict.fromkeys(rows[len(rows) * i // n] for i in range(1, n))) if rows else []

    def literal(value: str | None, kind: T.DataType) -> Column | None:
        return None if value is None else F.lit(value).cast(kind)

    return Ranges(tuple(columns), [[literal(v, k) for v, k in zip(row, kinds, strict=True)] for row in cuts], cuts)


def _named(df: DataFrame, order: Sequence[str | Column]) -> tuple[DataFrame, list[str], list[str]]:
    """Order expressions as columns: the frame, their names, and those to drop afterwards."""
    names, extra = [], []
    for i, c in enumerate(order):
        if isinstance(c, str):
            names.append(c)
        else:
            df = df.withColumn(f"_order{i}", c)
            names.append(f"_order{i}")
            extra.append(f"_order{i}")
    return df, names, extra


def row_index(df: DataFrame, order: Sequence[str | Column], start: int = 1, name: str = "row_idx",
              num_partitions: int | None = None) -> DataFrame:
    """Numbers ``start .. start+n-1`` in ascending ``order`` (nulls first); ``order`` must be a
    total order (end it with a unique key) so that a retried task numbers the same rows alike."""
    df, names, extra = _named(df, order)
    ranges = ranges_of(df, names, num_partitions)
    counts = {r["_range"]: r["n"] for r in df.groupBy(ranges.number.alias("_range")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, at = [], start
    for k in range(len(ranges.bounds) + 1):
        offsets.append(at)
        at += counts.get(k, 0)
    numbered = (df.withColumn("_range", ranges.number)
                  .repartitionById(len(offsets), F.col("_range")).sortWithinPartitions(*names)
                  .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    first = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col("_range") + 1)
    return numbered.withColumn(name, (first + F.col("_pos")).cast("bigint")).drop("_range", "_pos", *extra)


def grouped_row_index(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], start: int = 1,
                      name: str = "row_idx", num_partitions: int | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Row numbers restarting at ``start`` in every group, without a task per group: a hot group is
    split over several ranges. Only a group that a range begins in the middle of needs an offset, so
    there are fewer of those than ranges. One shuffle. ``ties`` are ordered by too, inside a range."""
    df, names, extra = _named(df, order)
    ranges = ranges_of(df, [*group, *names], num_partitions)
    where = Window.partitionBy("_range", *group).orderBy(*names, *ties)
    numbered = df.withColumn("_range", ranges.number).withColumn(name, F.row_number().over(where).cast("bigint") + (start - 1))
    if not ranges.bounds:
        return numbered.drop("_range", *extra)
    spark = df.sparkSession
    schema = T.StructType([T.StructField(f"g{i}", T.StringType()) for i in range(len(group))])
    cut_groups = spark.createDataFrame(list(dict.fromkeys(v[:len(group)] for v in ranges.values)), schema)
    cut_groups = cut_groups.select(*[F.col(f"g{i}").cast(df.schema[g].dataType).alias(f"g{i}") for i, g in enumerate(group)])
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"g{i}"))
    # at most MAX_RANGES groups, each in at most MAX_RANGES ranges and all in fewer than 2 * MAX_RANGES
    inside = df.join(F.broadcast(cut_groups), same, "left_semi")
    rows = inside.groupBy(*group, ranges.number.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.select(*[F.col(g).alias(f"g{i}") for i, g in enumerate(group)], F.col("_range").alias("_in"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")).where("_off > 0")
    out = numbered.join(F.broadcast(offsets), same & (F.col("_range") == F.col("_in")), "left")
    out = out.withColumn(name, (F.col(name) + F.coalesce(F.col("_off"), F.lit(0))).cast("bigint"))
    return out.drop("_range", "_in", "_off", *[f"g{i}" for i in range(len(group))], *extra)


def load_point(report: DataFrame, position: str, day: str, number: str, start_day: str,
               first_position: int = 1, first_number: int = 0) -> DataFrame:
    """The last report row (by position) whose day is non-empty and ``< start_day``; the next
    position is where the reload starts and its number + 1 is the lowest number to reload.
    One aggregate, no sort. With no such row the reload starts at the given initial values."""
    hit = (F.col(day) != "") & F.col(day).isNotNull() & (F.col(day) < F.lit(start_day))
    agg = report.where(hit).agg(F.max(position).alias("_p"), F.max_by(number, position).alias("_n"))
    return agg.select(
        F.coalesce(F.col("_p") + 1, F.lit(first_position)).cast("bigint").alias("next_row_idx"),
        F.coalesce(F.col("_n") + 1, F.lit(first_number)).cast("bigint").alias("next_number"),
    )
