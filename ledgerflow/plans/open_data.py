"""Open-data publications: company list with the non-disclosure flag (J1), config-driven
statistics publication (P7/P16) and a SQL-text scan published as CSV with the key first (S2/S3/K6i)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.filters import DatasetSpec, fan_out, from_year
from ledgerflow.operators.joins import flag_left_join
from ledgerflow.operators.reshape import drop_columns, select_columns
from ledgerflow.plans.catalog import register
from ledgerflow.session import scratch_path
from ledgerflow.sinks.writers import publish_csv
from ledgerflow.sources.tables import read_table, register_views


@register("flag_left_join", """
SELECT d.doc_id, d.lang, d.n_chars, f.non_diffusible
FROM documents d
LEFT JOIN (SELECT doc_id, 'oui' AS non_diffusible FROM labels) f ON d.doc_id = f.doc_id
""")
def flag_left_join_q(spark: SparkSession, sf: str) -> DataFrame:
    companies = drop_columns(read_table(spark, sf, "documents"), ["text", "source", "verificationStatus"])
    anonymous = read_table(spark, sf, "labels")
    out = flag_left_join(companies, anonymous, "doc_id", "non_diffusible")
    return select_columns(out, ["doc_id", "lang", "n_chars", "non_diffusible"])


# Two published datasets: a weekly one (day rule) and an annual one (year rule, chosen because
# the table name contains "annual").
STATS_SPECS = [
    DatasetSpec(name="weekly_events", table="events_weekly", since_day="2024-01-15"),
    DatasetSpec(name="annual_orders", table="orders_annual", since_year=1998),
]


def _stats_table(spark: SparkSession, sf: str, spec: DatasetSpec) -> DataFrame:
    if spec.table == "events_weekly":
        return read_table(spark, sf, "events").select(F.col("event_id").alias("key"),
                                                       F.col("ts").cast("date").alias("semaine"))
    orders = read_table(spark, sf, "orders").where(from_year("o_orderdate", spec.since_year))  # pushed to the scan
    return orders.select(F.col("o_orderkey").alias("key"),
                                                   F.year("o_orderdate").alias("annee"))


@register("range_publish", """
SELECT 'weekly_events' AS dataset, event_id AS key FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15'
UNION ALL
SELECT 'annual_orders' AS dataset, o_orderkey AS key FROM orders WHERE year(o_orderdate) >= 1998
""")
def range_publish_q(spark: SparkSession, sf: str) -> DataFrame:
    frames = fan_out(STATS_SPECS, lambda s: _stats_table(spark, sf, s))
    out = None
    for name, df in frames.items():
        part = df.select(F.lit(name).alias("dataset"), F.col("key").cast("bigint").alias("key"))
        out = part if out is None else out.unionByName(part)
    return out


FEDERATED_SQL = """
SELECT o_orderkey AS cle,
       CAST(o_orderdate AS DATE) AS date_inscription,
       CASE o_orderstatus WHEN 'F' THEN '  padded  ' WHEN 'P' THEN '' ELSE o_orderstatus END AS statut,
       o_orderpriority AS priorite
FROM {orders}
WHERE o_orderpriority <> '5-LOW'
"""


@register("federated_query", """
SELECT o_orderkey AS cle, CAST(o_orderdate AS DATE) AS date_inscription,
       CASE o_orderstatus WHEN 'F' THEN '  padded  ' WHEN 'P' THEN NULL ELSE o_orderstatus END AS statut,
       o_orderpriority AS priorite
FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def federated_query_q(spark: SparkSession, sf: str) -> DataFrame:
    views = register_views(spark, sf, ["orders"], prefix="lf_dwh_")
    df = spark.sql(FEDERATED_SQL.format(orders=views["orders"]))
    out = scratch_path(spark, "federated_csv")
    publish_csv(df, out)  # key first, header, ISO dates
    schema = "cle bigint, date_inscription date, statut string, priorite string"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(out)
