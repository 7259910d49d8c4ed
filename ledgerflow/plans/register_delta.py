"""Register delta: records flattened one level (N1/N2/T3), numbered and cursor page envelopes
landed as JSON and read back complete (S7/S8/U1), one partition per run interval (K9/F18/I1),
and log-level tagging of the indexer's output in batch and as a stream (F12/S12/I5)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalar import interval_label
from ledgerflow.operators.filters import closed_interval
from ledgerflow.operators.nested import flatten_one_level
from ledgerflow.plans.catalog import register
from ledgerflow.session import scratch_path
from ledgerflow.sinks.writers import write_interval
from ledgerflow.sources.files import read_envelopes, records
from ledgerflow.sources.tables import read_table
from ledgerflow.streaming.incremental import run_log_stream, tag_log_lines

# ---------------------------------------------------------------------------------------------
# flatten_record


def register_records(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in API records: scalars, a struct whose ``c_name`` clashes with the top-level one,
    and a list of two structs (empty for nation 0)."""
    c = read_table(spark, sf, "customer")
    n = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = read_table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = c.join(n, "c_nationkey").join(r, "n_regionkey")
    periods = F.array(F.struct(F.col("r_name"), F.col("n_regionkey").cast("bigint").alias("r_regionkey")),
                      F.struct(F.concat(F.col("r_name"), F.lit("_2")).alias("r_name"),
                               (F.col("n_regionkey") + 5).cast("bigint").alias("r_regionkey")))
    return j.select(
        "c_custkey", "c_name",
        F.struct(F.col("n_name"), F.upper("n_name").alias("c_name")).alias("uniteLegale"),
        F.filter(periods, lambda _: F.col("c_nationkey") != 0).alias("periodesEtablissement"),
        "c_acctbal",
    )


@register("flatten_record", """
SELECT c.c_custkey, upper(n.n_name) AS c_name, n.n_name,
       CASE WHEN c.c_nationkey = 0 THEN NULL ELSE r.r_name END AS r_name,
       CASE WHEN c.c_nationkey = 0 THEN NULL ELSE CAST(n.n_regionkey AS BIGINT) END AS r_regionkey,
       c.c_acctbal
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def flatten_record_q(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_one_level(register_records(spark, sf))


# ---------------------------------------------------------------------------------------------
# page_union

PAGE_ROWS = 100


def land_numbered_pages(df: DataFrame, key: str, page_rows: int, path: str) -> None:
    """Lands ``df`` as numbered page envelopes ``{page, total_pages, nombre, total, data:[...]}``.
    A page holds the keys ``page*page_rows ..`` so each list is bounded by ``page_rows``."""
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.col(key)).alias("k")).first()
    total, total_pages = stats["n"], (stats["k"] // page_rows + 1) if stats["k"] is not None else 0
    cols = [F.col(c) for c in df.columns]
    env = (df.withColumn("page", F.expr(f"{key} div {page_rows}"))
             .groupBy("page").agg(F.collect_list(F.struct(*cols)).alias("data"), F.count(F.lit(1)).alias("nombre"))
             .withColumn("total", F.lit(total)).withColumn("total_pages", F.lit(total_pages)))
    env.write.mode("overwrite").json(path)


def read_complete_pages(spark: SparkSession, path: str, record_schema: str) -> DataFrame:
    """Read landed envelopes and check, before the records are used, that every page arrived
    once and that the records in the lists (not their announced numbers) are the announced total."""
    env = read_envelopes(spark, path, f"page bigint, total_pages bigint, nombre bigint, total bigint, "
                                      f"data array<struct<{record_schema}>>")
    held = F.coalesce(F.size("data"), F.lit(0))
    got = env.agg(F.countDistinct("page").alias("pages"), F.count(F.lit(1)).alias("landed"), F.max("total_pages").alias("tp"),
                  F.sum(held).alias("n"), F.max("total").alias("t"),
                  F.sum((held != F.col("nombre")).cast("int")).alias("short")).first()
    if (got["pages"] or 0) != (got["tp"] or 0) or got["landed"] != got["pages"] or (got["n"] or 0) != (got["t"] or 0) or got["short"]:
        raise ValueError(f"incomplete page set: {got.asDict()}")
    return env.select("page", F.explode("data").alias("_r")).select("page", "_r.*")


@register("page_union", """
SELECT c_custkey, c_name, c_acctbal, c_custkey // 100 AS page FROM customer
""")
def page_union_q(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = scratch_path(spark, "numbered_pages")
    land_numbered_pages(c, "c_custkey", PAGE_ROWS, path)
    rows = read_complete_pages(spark, path, "c_custkey:bigint,c_name:string,c_acctbal:double")
    return rows.select("c_custkey", "c_name", "c_acctbal", "page")


# ---------------------------------------------------------------------------------------------
# interval_delta (S8/K9/F18/I1): three daily runs, a re-run of the second and an empty one of the third.

RUNS = [(date(2024, 10, 1), date(2024, 10, 2)), (date(2024, 10, 2), date(2024, 10, 3)),
        (date(2024, 10, 3), date(2024, 10, 4)), (date(2024, 10, 2), date(2024, 10, 3))]
EMPTIED = (date(2024, 10, 3), date(2024, 10, 4))  # re-run after the service withdrew all its changes
CURSOR_ROWS = 1000
ESTAB_SCHEMA = ("siret:bigint,denomination:string,"
                "adresseEtablissement:struct<codeCommuneEtablissement:string,libelleCommuneEtablissement:string>,"
                "periodesEtablissement:array<struct<etatAdministratifEtablissement:string>>,"
                "dateDernierTraitementEtablissement:date")


def register_changes(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("siret"), F.col("c_name").alias("denomination"),
        F.struct(F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("codeCommuneEtablissement"),
                 F.col("c_mktsegment").alias("libelleCommuneEtablissement")).alias("adresseEtablissement"),
        F.array(F.struct(F.col("c_mktsegment").alias("etatAdministratifEtablissement"))).alias("periodesEtablissement"),
        F.date_add(F.lit("2024-10-01").cast("date"), (F.col("c_custkey") % 4).cast("int")).alias("dateDernierTraitementEtablissement"),
    )


def land_cursor_pages(df: DataFrame, key: str, page_rows: int, path: str) -> None:
    """Cursor envelopes ``{header:{total,nombre,curseur,curseurSuivant}, etablissements:[...]}``;
    the last page's next cursor repeats its own (where the client stops)."""
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.expr(f"{key} div {page_rows}")).alias("last")).first()
    total, last = stats["n"], stats["last"]
    cols = [F.col(c) for c in df.columns]
    page = F.expr(f"{key} div {page_rows}")
    env = df.withColumn("_p", page).groupBy("_p").agg(F.collect_list(F.struct(*cols)).alias("etablissements"),
                                                      F.count(F.lit(1)).alias("nombre"))
    env = env.select(
        F.struct(F.lit(total).alias("total"), F.col("nombre"), F.col("_p").cast("string").alias("curseur"),
                 F.when(F.col("_p") == F.lit(last), F.col("_p")).otherwise(F.col("_p") + 1).cast("string").alias("curseurSuivant")
                 ).alias("header"),
        "etablissements")
    env.write.mode("overwrite").json(path)


def read_cursor_pages(spark: SparkSession, path: str) -> DataFrame:
    """The cursors must be one chain: every page landed once, every next cursor is a landed page,
    one page is nobody's next (the first) and one is its own next (the last, where the client
    stops); and the records in the lists must be the announced total. Only cursors are joined."""
    env = read_envelopes(spark, path, f"header struct<total:bigint,nombre:bigint,curseur:string,curseurSuivant:string>, "
                                      f"etablissements array<struct<{ESTAB_SCHEMA}>>")
    pages = env.select(F.col("header.curseur").alias("own"), F.col("header.curseurSuivant").alias("next"), F.col("header.total").alias("total"),
                       F.coalesce(F.size("etablissements"), F.lit(0)).alias("held"))
    steps = pages.where("own <> next").select(F.col("next").alias("to")).groupBy("to").agg(F.count(F.lit(1)).alias("n"))
    joined = pages.join(steps, pages["own"] == steps["to"], "full_outer")
    got = joined.agg(F.count("own").alias("landed"), F.countDistinct("own").alias("cursors"), F.sum("held").alias("n"), F.max("total").alias("t"),
                     F.sum((F.col("own") == F.col("next")).cast("int")).alias("last"),
                     F.sum((F.col("own").isNotNull() & F.col("to").isNull()).cast("int")).alias("first"),
                     F.sum(F.col("own").isNull().cast("int")).alias("missing"), F.max("n").alias("reached")).first()
    if got["landed"]:
        ends = (got["last"], got["first"]) == (1, 1) or (got["landed"] == 1 and got["last"] == 1)
        if got["landed"] != got["cursors"] or got["missing"] or not ends or (got["reached"] or 1) > 1 or got["n"] != got["t"]:
            raise ValueError(f"incomplete cursor pages: {got.asDict()}")
    return records(env, "etablissements")


@register("interval_delta", """
WITH c AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
                  DATE '2024-10-01' + CAST(c_custkey % 4 AS INTEGER) AS d FROM customer),
i(label, s, e) AS (VALUES ('20241001-20241002', DATE '2024-10-01', DATE '2024-10-02'),
                          ('20241002-20241003', DATE '2024-10-02', DATE '2024-10-03'))
SELECT i.label AS interval, c.c_custkey AS siret, c.c_name AS denomination,
       lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS codeCommuneEtablissement,
       c.c_mktsegment AS libelleCommuneEtablissement, c.c_mktsegment AS etatAdministratifEtablissement,
       c.d AS dateDernierTraitementEtablissement
FROM c JOIN i ON c.d BETWEEN i.s AND i.e
""")
def interval_delta_q(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "interval_delta")
    changes = register_changes(spark, sf)
    for k, (start, end) in enumerate([*RUNS, EMPTIED]):  # one scheduled run per interval; missed/re-run intervals replay here
        label = interval_label(start, end)
        landing = f"{root}/landing/{k}-{label}"
        offered = changes if k < len(RUNS) else changes.where(F.lit(False))
        land_cursor_pages(offered.where(closed_interval("dateDernierTraitementEtablissement", start, end)),
                          "siret", CURSOR_ROWS, landing)
        flat = flatten_one_level(read_cursor_pages(spark, landing)).withColumn("interval", F.lit(label))
        write_interval(flat, f"{root}/table", label)
    schema = ("siret bigint, denomination string, codeCommuneEtablissement string, libelleCommuneEtablissement string, "
              "etatAdministratifEtablissement string, dateDernierTraitementEtablissement date, interval string")
    return spark.read.schema(schema).parquet(f"{root}/table")


# ---------------------------------------------------------------------------------------------
# log_level / log_level_stream

def raw_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Indexer output stand-in: one line per event, tagged in several spellings, some untagged,
    one empty tag, trailing whitespace, and whitespace-only lines."""
    e = read_table(spark, sf, "events")
    sev = (F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "signup", "Info")
            .when(F.col("event_type") == "click", "debug").when(F.col("event_type") == "purchase", "Warning")
            .otherwise("notice"))
    k = F.col("event_id") % 4
    tag = (F.when(k == 0, F.lit("")).when(k == 1, F.concat(F.lit("@level@["), sev, F.lit("] ")))
            .when(k == 2, F.concat(F.lit("@LEVEL@["), sev, F.lit("] "))).otherwise(F.lit("@Level@[] ")))
    tail = F.when(F.col("event_id") % 5 == 0, F.lit(" \t ")).otherwise(F.lit(""))
    line = F.when(F.col("event_id") % 50 == 0, F.lit("   ")).otherwise(
        F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(" "), tag, F.col("event_type"), tail))
    return e.select("event_type", line.alias("value"))


LOG_ORACLE = r"""
WITH r AS (
  SELECT regexp_replace(
           CASE WHEN event_id % 50 = 0 THEN '   ' ELSE
             'event ' || CAST(event_id AS VARCHAR) || ' ' ||
             CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '@level@[' || sev || '] '
                               WHEN 2 THEN '@LEVEL@[' || sev || '] ' ELSE '@Level@[] ' END ||
             event_type || CASE WHEN event_id % 5 = 0 THEN ' ' || chr(9) || ' ' ELSE '' END END,
           '\s+$', '') AS line
  FROM (SELECT *, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'Info' WHEN 'click' THEN 'debug'
                                  WHEN 'purchase' THEN 'Warning' ELSE 'notice' END AS sev FROM events))
SELECT line,
       CASE WHEN regexp_matches(line, '@level@\[(.*?)\]', 'i') THEN lower(regexp_extract(line, '@level@\[(.*?)\]', 1, 'i')) END AS tag,
       CASE WHEN lower(regexp_extract(line, '@level@\[(.*?)\]', 1, 'i')) IN ('debug', 'info', 'warning', 'error', 'critical')
            THEN lower(regexp_extract(line, '@level@\[(.*?)\]', 1, 'i')) ELSE 'info' END AS level
FROM r WHERE length(line) > 0
"""


@register("log_level", LOG_ORACLE)
def log_level_q(spark: SparkSession, sf: str) -> DataFrame:
    return tag_log_lines(raw_log_lines(spark, sf))


@register("log_level_stream", LOG_ORACLE)
def log_level_stream_q(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "log_stream")
    lines = raw_log_lines(spark, sf)
    first = F.col("event_type").isin("signup", "click")
    for landed in (lines.where(first), lines.where(~first)):  # two landings, one run after each
        landed.select("value").write.mode("append").text(f"{root}/landing")
        run_log_stream(spark, f"{root}/landing", f"{root}/sink", f"{root}/checkpoint")
    return spark.read.schema("line string, tag string, level string").parquet(f"{root}/sink")
