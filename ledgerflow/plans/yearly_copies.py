"""Yearly Parquet copies: year of the first known date, clamped into open-ended buckets
(F1/F2/P8), exported once as a full copy plus one partition per bucket (K4/K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalar import first_non_null, year_bucket, year_of
from ledgerflow.plans.catalog import register
from ledgerflow.session import scratch_path
from ledgerflow.sinks.writers import export_by_bucket, export_parquet
from ledgerflow.sources.tables import read_table

FIRST_YEAR, LAST_YEAR = 1996, 1999


def slips(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in slip table: signature date = ship date (unknown in Jan/Feb), creation date =
    order date (unknown in 1995)."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = li.join(o, "l_orderkey")
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.month("l_shipdate").isin(1, 2), None).otherwise(F.col("l_shipdate")).alias("emetteur_date_signature_emission"),
        F.when(F.year("o_orderdate") == 1995, None).otherwise(F.col("o_orderdate")).alias("date_creation"),
    )


@register("year_bucket", """
WITH s AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
         year(coalesce(CASE WHEN month(l.l_shipdate) IN (1, 2) THEN NULL ELSE l.l_shipdate END,
                       CASE WHEN year(o.o_orderdate) = 1995 THEN NULL ELSE o.o_orderdate END)) AS y
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y AS year,
       CASE WHEN y IS NULL THEN NULL WHEN y <= 1996 THEN 1996 WHEN y >= 1999 THEN 1999 ELSE y END AS year_bucket
FROM s
""")
def year_bucket_q(spark: SparkSession, sf: str) -> DataFrame:
    s = slips(spark, sf)
    y = year_of(first_non_null("emetteur_date_signature_emission", "date_creation"))
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", y.alias("year"),
                    year_bucket(y, FIRST_YEAR, LAST_YEAR).alias("year_bucket"))


@register("year_bucket_copies", """
WITH b AS (
  SELECT o_orderkey,
         CASE WHEN y IS NULL THEN NULL WHEN y <= 1996 THEN 1996 WHEN y >= 1999 THEN 1999 ELSE y END AS year_bucket
  FROM (SELECT o_orderkey,
               year(coalesce(CASE WHEN month(o_orderdate) = 1 THEN NULL ELSE o_orderdate END,
                             CASE WHEN year(o_orderdate) = 1995 THEN NULL ELSE o_orderdate END)) AS y
        FROM orders))
SELECT 'full' AS copy, o_orderkey, year_bucket FROM b
UNION ALL
SELECT 'plain' AS copy, o_orderkey, NULL AS year_bucket FROM orders
UNION ALL
SELECT 'yearly' AS copy, o_orderkey, year_bucket FROM b WHERE year_bucket = 1997
""")
def year_bucket_copies_q(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    emission = F.when(F.month("o_orderdate") == 1, None).otherwise(F.col("o_orderdate"))
    created = F.when(F.year("o_orderdate") == 1995, None).otherwise(F.col("o_orderdate"))
    year = year_of(first_non_null(emission, created))
    path = scratch_path(spark, "yearly_copies")
    # last year's run had another window; its buckets must not survive the next export
    export_by_bucket(o.withColumn("year_bucket", year_bucket(year, FIRST_YEAR - 2, LAST_YEAR - 1)), f"{path}/buckets", "year_bucket")
    export_by_bucket(o.withColumn("year_bucket", year_bucket(year, FIRST_YEAR, LAST_YEAR)), f"{path}/buckets", "year_bucket")
    export_parquet(o, f"{path}/plain")  # K4 by itself
    back = spark.read.parquet(f"{path}/buckets").withColumn("year_bucket", F.col("year_bucket").cast("bigint"))
    full = back.select(F.lit("full").alias("copy"), "o_orderkey", "year_bucket")
    plain = spark.read.parquet(f"{path}/plain").select(F.lit("plain").alias("copy"), "o_orderkey", F.lit(None).cast("bigint").alias("year_bucket"))
    # A yearly copy is a partition read: the bucket predicate prunes folders (PartitionFilters).
    yearly = back.where(F.col("year_bucket") == 1997).select(F.lit("yearly").alias("copy"), "o_orderkey", "year_bucket")
    return full.unionByName(plain).unionByName(yearly)
