"""Data checks before publication (Q1/Q2/A3) and publication statistics (A4/A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.aggregates import describe, first_last
from ledgerflow.operators.checks import check_summary
from ledgerflow.plans.catalog import register
from ledgerflow.sources.tables import read_table


def _summary(df: DataFrame, key: str, columns: list[str], name: str) -> DataFrame:
    s = check_summary(df, key, columns, name)
    nulls = sum((F.col(f"n_null_{c}") for c in columns[1:]), F.col(f"n_null_{columns[0]}"))
    return s.select("table_name", "n_rows", "n_dup_keys", nulls.cast("bigint").alias("n_null"))


@register("data_checks", """
SELECT 'orders' AS table_name, CAST(count(*) AS BIGINT) AS n_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS n_dup_keys,
       CAST(sum(CAST(o_custkey IS NULL AS INTEGER) + CAST(o_orderstatus IS NULL AS INTEGER) + CAST(o_orderdate IS NULL AS INTEGER)) AS BIGINT) AS n_null
FROM orders
UNION ALL
SELECT 'labels' AS table_name, CAST(count(*) AS BIGINT),
       (SELECT CAST(count(*) AS BIGINT) FROM (
          SELECT doc_id FROM (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE quality = 1
                              UNION ALL SELECT doc_id FROM labels WHERE toxic = 1)
          GROUP BY doc_id HAVING count(*) > 1)),
       CAST(sum(CAST(quality IS NULL AS INTEGER) + CAST(toxic IS NULL AS INTEGER)) AS BIGINT)
FROM (SELECT doc_id, quality, toxic FROM labels
      UNION ALL SELECT doc_id, quality, toxic FROM labels WHERE quality = 1
      UNION ALL SELECT doc_id, NULL AS quality, toxic FROM labels WHERE toxic = 1)
""")
def data_checks_q(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders")
    labels = read_table(spark, sf, "labels")
    # A delivery with repeated keys and missing values: labels, plus re-sent quality rows, plus
    # toxic rows whose quality went missing.
    delivered = labels.unionByName(labels.where(F.col("quality") == 1)).unionByName(
        labels.where(F.col("toxic") == 1).withColumn("quality", F.lit(None).cast("int")))
    return _summary(orders, "o_orderkey", ["o_custkey", "o_orderstatus", "o_orderdate"], "orders") \
        .unionByName(_summary(delivered, "doc_id", ["quality", "toxic"], "labels"))


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]
_D_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", s.stat, round(s.value, 6) AS value FROM (
  SELECT unnest([{{'stat': 'count', 'value': CAST(count({c}) AS DOUBLE)}}, {{'stat': 'mean', 'value': avg({c})}},
                 {{'stat': 'std', 'value': stddev_samp({c})}}, {{'stat': 'min', 'value': CAST(min({c}) AS DOUBLE)}},
                 {{'stat': '25%', 'value': quantile_cont({c}, 0.25)}}, {{'stat': '50%', 'value': quantile_cont({c}, 0.5)}},
                 {{'stat': '75%', 'value': quantile_cont({c}, 0.75)}}, {{'stat': 'max', 'value': CAST(max({c}) AS DOUBLE)}}]) AS s
  FROM lineitem)""" for c in DESCRIBED)


@register("publish_stats", _D_SQL + """
UNION ALL
SELECT 'l_orderkey', 'first', CAST(arg_min(l_orderkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS DOUBLE) FROM lineitem
UNION ALL
SELECT 'l_orderkey', 'last', CAST(arg_max(l_orderkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS DOUBLE) FROM lineitem
UNION ALL
SELECT 'l_orderkey', 'min', CAST(min(l_orderkey) AS DOUBLE) FROM lineitem
UNION ALL
SELECT 'l_orderkey', 'max', CAST(max(l_orderkey) AS DOUBLE) FROM lineitem
""")
def publish_stats_q(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    stats = describe(li, DESCRIBED)
    fl = first_last(li, "l_orderkey", ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    fl = fl.select(F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value"))
                                       for s in ("first", "last", "min", "max")])).alias("r"))
    return stats.unionByName(fl.select(F.lit("l_orderkey").alias("column"), "r.stat", "r.value"))
