"""Ticket report: look-ups (J2/J3/J4/F6/Q3), date/time parts (F4/F5/F7-F9), response delay
(F10/F11), row numbering and formulas (W1/T1/F10t), reload point (W2), the positional load
(K7) and the overlapping weekly reload (I3/F15/P9/P10)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalar import (blank_if_null, delay_days, delay_hours, fixed_decimal_text, format_ts,
                                         full_name, iso_week, left_chars, parse_utc, year_week)
from ledgerflow.operators.filters import at_least, closed_interval
from ledgerflow.operators.joins import lookup_array, lookup_dimension, lookup_left
from ledgerflow.operators.nested import join_text
from ledgerflow.operators.ordinal import load_point, row_index
from ledgerflow.plans.catalog import register
from ledgerflow.session import scratch_path
from ledgerflow.sinks.keyed import KeyedStore
from ledgerflow.sources.files import check_short_page, read_array_pages
from ledgerflow.sources.tables import read_table

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's report: the spreadsheet formulas written per
# row ({i} is the row number), in the report's column order.
FORMULA_CREATED_DAY = "=GAUCHE(R{i},10)"
FORMULA_CREATED_WEEK = "=NO.SEMAINE(D{i},21)"
FORMULA_CREATED_MONTH = "=GAUCHE(R{i},7)"
FORMULA_YEAR_WEEK = '=CONCAT(CONCAT(GAUCHE(D{i},4),"-"),C{i})'
FORMULA_DELAY_HOURS = '=SI(X{i}="","",X{i}-R{i})'
FORMULA_DELAY_DAYS = "=AJ{i}"
# ---------------------------------------------------------------------------------------------


def formula(template: str, idx) -> F.Column:
    """Fills ``{i}`` with the row number column."""
    parts = template.split("{i}")
    cols = [F.lit(parts[0])]
    for p in parts[1:]:
        cols += [idx.cast("string"), F.lit(p)]
    return F.concat(*cols)


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in user directory: first/last names with empty and missing cases, e-mail."""
    c = read_table(spark, sf, "customer")
    first = F.when(F.col("c_nationkey") == 1, F.lit("")).when(F.col("c_nationkey") == 2, F.lit(None)) \
             .otherwise(F.substring("c_name", 1, 8))
    last = F.when(F.col("c_nationkey").isin(1, 3), F.lit("")).otherwise(F.substring("c_name", 10, 9))
    email = F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.org"))
    return c.select(F.col("c_custkey").alias("id"), first.alias("firstname"), last.alias("lastname"),
                    email.alias("email"), "c_nationkey")


USERS_SQL = """
users AS (
  SELECT c_custkey AS id,
         CASE WHEN c_nationkey = 1 THEN '' WHEN c_nationkey = 2 THEN NULL ELSE substr(c_name, 1, 8) END AS firstname,
         CASE WHEN c_nationkey IN (1, 3) THEN '' ELSE substr(c_name, 10, 9) END AS lastname,
         lower(replace(c_name, '#', '.')) || '@example.org' AS email, c_nationkey
  FROM customer)"""


@register("lookup_dimension", f"""
WITH {USERS_SQL}
SELECT id, firstname || ' ' || lastname AS owner_name,
       CASE WHEN firstname = '' AND lastname = '' THEN email ELSE firstname || ' ' || lastname END AS customer_name
FROM users WHERE id IN (SELECT o_custkey FROM orders)
""")
def lookup_dimension_q(spark: SparkSession, sf: str) -> DataFrame:
    dim = lookup_dimension(users(spark, sf), read_table(spark, sf, "orders"), "o_custkey")
    return dim.select("id", full_name("firstname", "lastname").alias("owner_name"),
                      full_name("firstname", "lastname", "email").alias("customer_name"))


@register("lookup_join_m2o", f"""
WITH {USERS_SQL}
SELECT o.o_orderkey, o.o_custkey, u.firstname || ' ' || u.lastname AS owner_name, n.n_name AS nation_name
FROM orders o LEFT JOIN users u ON o.o_custkey = u.id LEFT JOIN nation n ON u.c_nationkey = n.n_nationkey
""")
def lookup_join_m2o_q(spark: SparkSession, sf: str) -> DataFrame:
    tickets = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    owners = users(spark, sf).select("id", full_name("firstname", "lastname").alias("owner_name"),
                                     F.col("c_nationkey").alias("owner_nation"))
    nations = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("nation_name"))
    out = lookup_left(tickets, owners, "o_custkey", "id")
    out = lookup_left(out, nations, "owner_nation", "id")
    return out.select("o_orderkey", "o_custkey", "owner_name", "nation_name")


@register("lookup_array", """
SELECT d.doc_id,
       coalesce(concat_ws(',', CASE WHEN l.quality = 1 THEN 'quality' END, CASE WHEN l.toxic = 1 THEN 'toxic' END), '') AS tags,
       CAST(coalesce(CAST(l.quality = 1 AS INTEGER) + CAST(l.toxic = 1 AS INTEGER), 0) AS BIGINT) AS n_tags
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def lookup_array_q(spark: SparkSession, sf: str) -> DataFrame:
    labels = read_table(spark, sf, "labels")
    tags = labels.select("doc_id", F.filter(F.array(F.when(F.col("quality") == 1, F.lit("quality")),
                                                     F.when(F.col("toxic") == 1, F.lit("toxic"))),
                                            lambda x: x.isNotNull()).alias("tags"))
    docs = read_table(spark, sf, "documents").select("doc_id")
    out = lookup_array(docs, tags, "doc_id", "tags")
    return out.select("doc_id", join_text("tags").alias("tags"), F.size("tags").cast("bigint").alias("n_tags"))


@register("row_index", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 99 AS row_idx FROM orders
""")
def row_index_q(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return row_index(o, ["o_orderdate", "o_orderkey"], start=100).select("o_orderkey", "row_idx")


def ticket_report(spark: SparkSession, sf: str) -> DataFrame:
    """Existing report stand-in: one row per event (header on row 1), day empty for errors."""
    e = read_table(spark, sf, "events")
    day = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    numbered = row_index(e.select("event_id", "event_type", "ts"), ["event_id"], start=2)
    return numbered.select("row_idx", F.col("event_id").alias("number"), day.alias("day"))


@register("load_point", """
WITH r AS (SELECT row_number() OVER (ORDER BY event_id) + 1 AS row_idx, event_id AS number,
                  CASE WHEN event_type = 'error' THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events)
SELECT CAST(max(row_idx) + 1 AS BIGINT) AS next_row_idx, CAST(arg_max(number, row_idx) + 1 AS BIGINT) AS next_number
FROM r WHERE day <> '' AND day < '2024-01-20'
""")
def load_point_q(spark: SparkSession, sf: str) -> DataFrame:
    return load_point(ticket_report(spark, sf), "row_idx", "day", "number", "2024-01-20", first_position=2)


@register("time_parts", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at, strftime(ts, '%Y-%m-%d') AS created_day,
       strftime(ts, '%Y-%m') AS created_month, CAST(weekofyear(ts) AS BIGINT) AS created_week,
       strftime(ts, '%Y') || '-' || CAST(weekofyear(ts) AS VARCHAR) AS created_year_week
FROM events
""")
def time_parts_q(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")  # the API's UTC text
    created = format_ts(parse_utc(iso))
    t = e.select("event_id", created.alias("created_at"))
    t = t.withColumn("created_day", left_chars("created_at", 10)).withColumn("created_month", left_chars("created_at", 7))
    t = t.withColumn("created_week", iso_week("created_day").cast("bigint"))
    return t.withColumn("created_year_week", year_week("created_day", "created_week"))


@register("response_delay", """
WITH f AS (SELECT l_orderkey, min(l_shipdate) AS first_response_at FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey,
       coalesce(strftime(f.first_response_at, '%Y-%m-%d %H:%M:%S'), '') AS first_response_at,
       coalesce(CAST(CAST(round((epoch(f.first_response_at) - epoch(o.o_orderdate)) / 3600.0, 3) AS DECIMAL(38, 3)) AS VARCHAR), '') AS delay_h,
       coalesce(CAST(CAST(round((epoch(f.first_response_at) - epoch(o.o_orderdate)) / 86400.0, 3) AS DECIMAL(38, 3)) AS VARCHAR), '') AS delay_d
FROM orders o LEFT JOIN f ON f.l_orderkey = o.o_orderkey
""")
def response_delay_q(spark: SparkSession, sf: str) -> DataFrame:
    # First response = earliest ship date of the order (pre-aggregated per key, map-side first).
    first = read_table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_response_at"))
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = o.join(first.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    return j.select(
        "o_orderkey",
        blank_if_null(format_ts("first_response_at")).alias("first_response_at"),
        blank_if_null(fixed_decimal_text(delay_hours("first_response_at", "o_orderdate"))).alias("delay_h"),
        blank_if_null(fixed_decimal_text(delay_days("first_response_at", "o_orderdate"))).alias("delay_d"),
    )


@register("formula_text", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 1 AS i FROM orders)
SELECT o_orderkey, i AS row_idx,
       '=GAUCHE(R' || i || ',10)' AS created_day,
       '=NO.SEMAINE(D' || i || ',21)' AS created_week,
       '=GAUCHE(R' || i || ',7)' AS created_month,
       '=CONCAT(CONCAT(GAUCHE(D' || i || ',4),"-"),C' || i || ')' AS created_year_week,
       '=SI(X' || i || '="","",X' || i || '-R' || i || ')' AS delay_h,
       '=AJ' || i AS delay_d
FROM r
""")
def formula_text_q(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    r = row_index(o, ["o_orderdate", "o_orderkey"], start=2)
    i = F.col("row_idx")
    return r.select("o_orderkey", "row_idx",
                    formula(FORMULA_CREATED_DAY, i).alias("created_day"),
                    formula(FORMULA_CREATED_WEEK, i).alias("created_week"),
                    formula(FORMULA_CREATED_MONTH, i).alias("created_month"),
                    formula(FORMULA_YEAR_WEEK, i).alias("created_year_week"),
                    formula(FORMULA_DELAY_HOURS, i).alias("delay_h"),
                    formula(FORMULA_DELAY_DAYS, i).alias("delay_d"))


@register("interval_filter", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-03-31 00:00:00' AND o_orderkey >= 5000
""")
def interval_filter_q(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    start, end = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"), F.lit("1996-03-31 00:00:00").cast("timestamp_ntz")
    out = o.where(closed_interval("o_orderdate", start, end) & at_least("o_orderkey", 5000))
    return out.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))


POSITIONS = 10_000  # rows of a report's range


# ---------------------------------------------------------------------------------------------
# positional_load (K7/W1): the report holds rows 1..N; a reload of the 1997 orders starts at its
# first row and replaces exactly those rows, the rows after it stay.

@register("positional_load", """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_idx, o_orderkey,
       CASE WHEN year(o_orderdate) = 1997 THEN lower(o_orderstatus) ELSE o_orderstatus END AS statut
FROM orders
""")
def positional_load_q(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    report = row_index(o, ["o_orderdate", "o_orderkey"], start=1).select("row_idx", "o_orderkey",
                                                                         F.col("o_orderstatus").alias("statut"))
    first = o.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")).count() + 1
    changed = o.where(F.year("o_orderdate") == 1997).select("o_orderkey", "o_orderdate",
                                                             F.lower("o_orderstatus").alias("statut"))
    reload = row_index(changed, ["o_orderdate", "o_orderkey"], start=first).select("row_idx", "o_orderkey", "statut")
    store = KeyedStore(spark, scratch_path(spark, "positional_load"))
    store.run(lambda txn: txn.create_positions("report", report, "row_idx", POSITIONS))
    store.run(lambda txn: txn.replace_positions("report", reload))
    return store.read("report")


# ---------------------------------------------------------------------------------------------
# report_reload (S9/S13/I3/F15/W2/K7): the report was last built on 2024-01-20; the run of
# 2024-01-25 reloads from 7 days before its start, from the load point on, and must equal a
# full rebuild.

RUN_START, RUN_END = date(2024, 1, 25), date(2024, 1, 31)
LAST_BUILD = date(2024, 1, 20)


def _tickets(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    return e.select(F.col("event_id").alias("number"), "ts",
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
                    F.date_format("ts", "yyyy-MM-dd").alias("day"))


TICKET_PAGE_ROWS = 50
TICKET_SCHEMA = "number bigint, ts timestamp_ntz, created_at string, day string"


def land_ticket_pages(tickets: DataFrame, path: str) -> None:
    """The ticket service's answer as landed files: pages of 50 tickets in the order of their
    numbers, each page one JSON array (one page per line), the last one not full (or empty)."""
    numbered = row_index(tickets, ["number"], start=0, name="_i")
    pages = numbered.groupBy(F.expr(f"_i div {TICKET_PAGE_ROWS}").alias("page")).agg(
        F.to_json(F.collect_list(F.struct("number", "ts", "created_at", "day"))).alias("value")).select("value")
    if tickets.count() % TICKET_PAGE_ROWS == 0:
        pages = pages.unionAll(tickets.sparkSession.createDataFrame([("[]",)], "value string"))
    pages.write.mode("overwrite").text(path)


@register("report_reload", """
SELECT row_number() OVER (ORDER BY ts, event_id) + 1 AS row_idx, event_id AS number,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at, strftime(ts, '%Y-%m-%d') AS day
FROM events WHERE strftime(ts, '%Y-%m-%d') <= '2024-01-30'
""")
def report_reload_q(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "report_reload")
    tickets = _tickets(spark, sf)
    cols = ["row_idx", "number", "created_at", "day"]
    # the report as the previous run left it (header on row 1)
    existing = row_index(tickets.where(F.col("day") < F.lit(f"{LAST_BUILD:%Y-%m-%d}")), ["ts", "number"], start=2)
    store = KeyedStore(spark, f"{root}/store")
    store.run(lambda txn: txn.create_positions("report", existing.select(*cols), "row_idx", POSITIONS))
    report = store.read("report")                                          # S13: read the report back
    start_day = RUN_START - timedelta(days=7)                               # F15
    end_day = RUN_END - timedelta(days=1)
    point = load_point(report, "row_idx", "day", "number", f"{start_day:%Y-%m-%d}", first_position=2).first()
    # P9 + P10: the service query; its answer lands as array pages (S9) and is read back as one union
    wanted = tickets.where(closed_interval("day", f"{start_day:%Y-%m-%d}", f"{end_day:%Y-%m-%d}")
                           & at_least("number", point["next_number"]))
    land_ticket_pages(wanted, f"{root}/pages")
    check_short_page(spark, f"{root}/pages", TICKET_PAGE_ROWS)
    pages = read_array_pages(spark, f"{root}/pages", TICKET_SCHEMA)
    reload = row_index(pages, ["ts", "number"], start=point["next_row_idx"]).select(*cols)
    store.run(lambda txn: txn.replace_positions("report", reload))          # K7
    return store.read("report")
