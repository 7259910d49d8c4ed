"""Joins (J1-J6).

Physical choice is left to Catalyst + AQE: a side is only hinted for broadcast when its bytes are
measured (``fits_broadcast``). Otherwise AQE measures the shuffled side at run time and converts the
sort-merge join to a broadcast join when it is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
and splits skewed partitions (``skewJoin``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.checks import assert_many_to_one, assert_unique


BROADCAST_BYTES = 32 << 20  # a side is hinted for broadcast up to so many bytes of row text


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Size check before a broadcast hint: whether the rows of ``df``, as JSON text, take at most
    ``max_bytes``. It reads ``df`` once, in one aggregate; persist ``df`` when it is costly."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return (df.agg(F.sum(size).alias("n")).first()["n"] or 0) <= max_bytes


def flag_left_join(df: DataFrame, flagged: DataFrame, key: str, flag: str, value: str = "oui") -> DataFrame:
    """Left join adding ``flag = value`` for keys present in ``flagged`` (null otherwise).
    As in a pandas index join, a key repeated on the right repeats the left row."""
    right = flagged.select(key).withColumn(flag, F.lit(value))
    return df.join(right, key, "left")


def lookup_left(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str, validate: bool = True) -> DataFrame:
    """Left look-up on differently named keys, many-to-one enforced (Q3 first). The right
    key is not kept (the frame keeps the left key)."""
    if validate:
        assert_many_to_one(lookup, right_key)
    return df.join(lookup.withColumnRenamed(right_key, "_lk"), F.col(left_key) == F.col("_lk"), "left").drop("_lk")


def lookup_array(df: DataFrame, arrays: DataFrame, key: str, name: str) -> DataFrame:
    """Per-row look-up of a list; no match (or a failed look-up) gives an empty list."""
    elem = arrays.schema[name].dataType
    return df.join(arrays.select(key, name), key, "left") \
             .withColumn(name, F.coalesce(F.col(name), F.array().cast(elem)))


def lookup_dimension(users: DataFrame, keys: DataFrame, key: str, user_id: str = "id") -> DataFrame:
    """Only the rows of ``users`` whose id occurs among ``keys`` (distinct look-up)."""
    wanted = keys.select(F.col(key).alias(user_id)).where(F.col(user_id).isNotNull()).distinct()
    return users.join(wanted, user_id, "left_semi")


def replace_children(target: DataFrame, new_children: DataFrame, key: str) -> DataFrame:
    """J5 (+U2, P14): children of every parent key present in ``new_children`` are replaced by
    the new rows; other parents keep theirs. Parents whose new list is empty are not touched
    (their key does not occur among the new rows)."""
    touched = new_children.select(key).where(F.col(key).isNotNull()).distinct()
    kept = target.join(touched, key, "left_anti")
    return kept.unionByName(new_children.select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, key: str, update_columns: Sequence[str],
           check_source: bool = True, small_source_bytes: int | None = None) -> DataFrame:
    """``INSERT .. ON CONFLICT (key) DO UPDATE SET <update_columns> = EXCLUDED.<col>``.

    * columns in ``update_columns`` take the source value on conflict, even a null one;
      the key and every other column keep the target value;
    * a source key occurring twice is an error (checked first);
    * null keys never conflict: rows without a key, of either side, are taken as they are and stay
      out of the join (they would all meet in one task).

    When ``small_source_bytes`` is given and the source is measured to be no larger, the large target
    is never shuffled: ``target LEFT JOIN broadcast(source)`` plus the source rows whose key the
    target lacks. Otherwise one full outer (sort-merge) join on the keys, which are unique in the
    source and so at most as skewed as the target's.
    """
    columns = target.columns
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    update = set(update_columns) - {key}
    if check_source:
        assert_unique(source, key, "source key")
    src = source.select(*columns)
    no_key = target.where(F.col(key).isNull()).unionByName(src.where(F.col(key).isNull()))
    src, target = src.where(F.col(key).isNotNull()), target.where(F.col(key).isNotNull())

    if small_source_bytes is not None and fits_broadcast(src, small_source_bytes):
        s = F.broadcast(src.select(*[F.col(c).alias(f"_s_{c}") for c in columns]).withColumn("_s", F.lit(True)))
        updated = target.join(s, F.col(key) == F.col(f"_s_{key}"), "left").select(
            *[(F.when(F.col("_s").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(c)) if c in update else F.col(c)).alias(c)
              for c in columns])
        hit_keys = target.select(key).join(F.broadcast(src.select(key)), key, "left_semi").distinct()
        inserted = src.join(F.broadcast(hit_keys), key, "left_anti")
        return updated.unionByName(inserted).unionByName(no_key)

    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in columns]).withColumn("_t", F.lit(True))
    s = src.select(*[F.col(c).alias(f"_s_{c}") for c in columns]).withColumn("_s", F.lit(True))
    joined = t.join(s, F.col(f"_t_{key}") == F.col(f"_s_{key}"), "full_outer")

    def pick(c: str) -> Column:
        if c in update:
            return F.when(F.col("_s").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}"))
        return F.when(F.col("_t").isNotNull(), F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}"))

    return joined.select(*[pick(c).alias(c) for c in columns]).unionByName(no_key)


def overlay_rows(report: DataFrame, reload: DataFrame, position: str) -> DataFrame:
    """K7: rows of a reload, numbered without gaps, replace exactly the report's rows at the same
    positions; rows before and after stay. A range filter and a union: the report is not shuffled."""
    at = reload.agg(F.min(position).alias("lo"), F.max(position).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if not at["n"]:
        return report
    if at["hi"] - at["lo"] + 1 != at["n"]:
        raise ValueError(f"reload positions {at['lo']}..{at['hi']} hold {at['n']} rows")
    return report.where(~F.col(position).between(at["lo"], at["hi"])).unionByName(reload.select(*report.columns))
