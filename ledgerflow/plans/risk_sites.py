"""Risk-site incremental load: watermark (A1/P11), rename + align (P3/P4/P1), upsert with an
explicit update list (J6), replacement of child rows (J5), explode of child lists (N3), the
streaming form with landed change files (I2) and the checked append (K2/P13/P17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalar import left_chars
from ledgerflow.operators.joins import replace_children, upsert
from ledgerflow.operators.nested import explode_children, union_of_keys
from ledgerflow.operators.reshape import align_columns, drop_falsy, rename_columns, select_columns
from ledgerflow.plans.catalog import register
from ledgerflow.session import scratch_path
from ledgerflow.sinks.keyed import KeyedStore
from ledgerflow.sinks.writers import SchemaMismatch, append_checked
from ledgerflow.sources.tables import read_table
from ledgerflow.streaming.incremental import run_keyed_stream

# ---------------------------------------------------------------------------------------------
# rename_align

SITE_RENAME = {"s_suppkey": "code_aiot", "s_name": "raison_sociale", "s_nationkey": "code_insee",
               "s_acctbal": "longitude", "coordonneeXAIOT": "x"}  # the last source name is absent
SITE_COLUMNS = {"code_aiot": "bigint", "raison_sociale": "string", "code_insee": "int", "longitude": "double",
                "adresse1": "string", "code_postal": "string"}
SITE_ORDER = ["raison_sociale", "adresse1", "code_postal", "code_insee", "longitude", "code_aiot"]


@register("rename_align", """
SELECT s_name AS raison_sociale, CAST(NULL AS VARCHAR) AS adresse1, CAST(NULL AS VARCHAR) AS code_postal,
       s_nationkey AS code_insee, s_acctbal AS longitude, s_suppkey AS code_aiot
FROM supplier
""")
def rename_align_q(spark: SparkSession, sf: str) -> DataFrame:
    df = rename_columns(read_table(spark, sf, "supplier"), SITE_RENAME)
    return select_columns(align_columns(df, SITE_COLUMNS), SITE_ORDER)


# ---------------------------------------------------------------------------------------------
# changed_since (A1/P11): the warehouse holds the orders of the years before 1999.

def last_update_day(target: DataFrame, column: str, initial: str = "1900-01-01") -> str:
    """A1: max of the target's modification column cut to 10 characters (one scalar; an empty
    target gives the explicit initial date instead of failing)."""
    row = target.agg(left_chars(F.max(F.col(column)).cast("string"), 10).alias("d")).first()
    return row["d"] if row and row["d"] else initial


@register("changed_since", """
WITH w AS (SELECT substr(CAST(max(o_orderdate) AS VARCHAR), 1, 10) AS d FROM orders WHERE o_orderdate < DATE '1999-01-01')
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_maj
FROM orders, w WHERE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) >= w.d
""")
def changed_since_q(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders")
    watermark = last_update_day(orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")), "o_orderdate")
    day = F.col("o_orderdate").cast("date").cast("string")
    # The changed-since pull is a plain predicate on the source: pushed down to the scan.
    return orders.where(F.col("o_orderdate") >= F.lit(watermark).cast("timestamp_ntz")) \
                 .select("o_orderkey", day.alias("date_maj")).where(F.col("date_maj") >= F.lit(watermark))


# ---------------------------------------------------------------------------------------------
# upsert_customer

CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
# c_nationkey plays the column left out of the update list: it keeps the stored value.
CUSTOMER_UPDATE = ["c_name", "c_acctbal", "c_mktsegment"]


def customer_target(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "customer").where(F.col("c_mktsegment") != "MACHINERY").select(*CUSTOMER_COLUMNS)


def customer_changes(spark: SparkSession, sf: str, segments: list[str], bump: float, name_upper: bool,
                     nation_shift: int, null_segment: bool) -> DataFrame:
    c = read_table(spark, sf, "customer").where(F.col("c_mktsegment").isin(segments))
    seg = F.when(F.col("c_nationkey") < 5, F.lit(None).cast("string")).otherwise(F.lower("c_mktsegment")) \
        if null_segment else F.col("c_mktsegment")
    return c.select(
        "c_custkey",
        (F.upper("c_name") if name_upper else F.col("c_name")).alias("c_name"),
        (F.col("c_nationkey") + F.lit(nation_shift)).alias("c_nationkey"),
        (F.col("c_acctbal") + F.lit(bump)).alias("c_acctbal"),
        seg.alias("c_mktsegment"),
    )


@register("upsert_customer", """
WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'),
s AS (SELECT c_custkey, upper(c_name) AS c_name, c_nationkey + 100 AS c_nationkey, c_acctbal + 1.0 AS c_acctbal,
             CASE WHEN c_nationkey < 5 THEN NULL ELSE lower(c_mktsegment) END AS c_mktsegment
      FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING'))
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_nationkey ELSE s.c_nationkey END AS c_nationkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey
UNION ALL SELECT NULL, c_name, c_nationkey, c_acctbal, c_mktsegment FROM t WHERE c_nationkey = 3
UNION ALL SELECT NULL, c_name, c_nationkey, c_acctbal, c_mktsegment FROM s WHERE c_nationkey = 104
""")
def upsert_customer_q(spark: SparkSession, sf: str) -> DataFrame:
    source = customer_changes(spark, sf, ["MACHINERY", "BUILDING"], 1.0, True, 100, True)
    target = customer_target(spark, sf)
    # rows without a key on either side: they never conflict
    no_key = F.lit(None).cast("bigint")
    target = target.unionByName(target.where("c_nationkey = 3").withColumn("c_custkey", no_key))
    source = source.unionByName(source.where("c_nationkey = 104").withColumn("c_custkey", no_key))
    return upsert(target, source, "c_custkey", CUSTOMER_UPDATE)


# ---------------------------------------------------------------------------------------------
# replace_children (J5/U2/P14): urgent orders come back with a changed set of lines 1-2.

CHILD_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@register("replace_children", """
WITH n AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + 1 AS l_quantity
  FROM lineitem
  WHERE l_linenumber <= 2 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.l_orderkey = lineitem.l_orderkey)
UNION ALL
SELECT * FROM n
""")
def replace_children_q(spark: SparkSession, sf: str) -> DataFrame:
    target = read_table(spark, sf, "lineitem").select(*CHILD_COLUMNS)
    urgent = read_table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_orderkey").alias("l_orderkey"))
    new = target.join(urgent, "l_orderkey", "left_semi").where(F.col("l_linenumber") <= 2) \
        .withColumn("l_quantity", F.col("l_quantity") + 1)
    return replace_children(target, new, "l_orderkey")


# ---------------------------------------------------------------------------------------------
# explode_children

CHILD_RENAME = {"numeroRubrique": "rubrique", "regimeAutoriseAlinea": "regime", "quantiteTotale": "quantite_totale"}


def site_records(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in API records: one per order with its lines as a ``rubriques`` list (a delivered record
    holds its own children; an order without lines has a null list)."""
    item = F.struct(F.col("l_linenumber").alias("numeroRubrique"), F.col("l_returnflag").alias("regimeAutoriseAlinea"),
                    F.col("l_quantity").alias("quantiteTotale"))
    nested = read_table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("codeAIOT")).agg(F.collect_list(item).alias("rubriques"))
    parents = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("codeAIOT"), "o_orderstatus")
    return parents.join(nested, "codeAIOT", "left")


@register("explode_children", """
SELECT o.o_orderkey AS code_aiot, l.l_linenumber AS rubrique, l.l_returnflag AS regime, l.l_quantity AS quantite_totale
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def explode_children_q(spark: SparkSession, sf: str) -> DataFrame:
    rows = explode_children(site_records(spark, sf), "codeAIOT", "rubriques", CHILD_RENAME)
    return rows.withColumnRenamed("codeAIOT", "code_aiot")


# ---------------------------------------------------------------------------------------------
# union_of_keys (N7): landed site records as JSON lines, of which each has the keys it has a value for;
# one key is a number in some and a text in others.

@register("union_of_keys", """
SELECT s_suppkey AS "codeAIOT", CASE WHEN s_nationkey = 1 THEN NULL ELSE s_name || ' "x"' END AS "raisonSociale",
       CASE WHEN s_suppkey % 10 = 0 THEN CAST(s_nationkey AS BIGINT) END AS bovins, CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal END AS longitude,
       CASE s_suppkey % 3 WHEN 0 THEN CAST(s_nationkey AS VARCHAR) WHEN 1 THEN 'about ' || CAST(s_nationkey AS VARCHAR) END AS rayon,
       CASE WHEN s_suppkey % 4 = 0 THEN '[{"n":' || CAST(s_nationkey AS VARCHAR) || '}]' END AS rubriques, s_suppkey % 2 = 0 AS seveso
FROM supplier
""")
def union_of_keys_q(spark: SparkSession, sf: str) -> DataFrame:
    s = read_table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    number = F.to_json(F.struct(F.when(key % 3 == 0, F.col("s_nationkey")).alias("rayon")))
    text = F.to_json(F.struct(F.when(key % 3 == 1, F.concat(F.lit("about "), F.col("s_nationkey").cast("string"))).alias("rayon")))
    rest = F.to_json(F.struct(
        key.alias("codeAIOT"), F.when(F.col("s_nationkey") != 1, F.concat("s_name", F.lit(' "x"'))).alias("raisonSociale"),
        F.when(key % 10 == 0, F.col("s_nationkey")).alias("bovins"), F.when(key % 3 == 0, F.col("s_acctbal")).alias("longitude"),
        F.when(key % 4 == 0, F.array(F.struct(F.col("s_nationkey").alias("n")))).alias("rubriques"), (key % 2 == 0).alias("seveso")))
    # an object without keys is {}
    joined = F.concat(F.regexp_replace(rest, r"\}$", ""), F.regexp_replace(F.when(key % 3 == 0, number).otherwise(text), r"^\{(?=.)", ","))
    record = F.regexp_replace(joined, r",\}$", "}")
    path = scratch_path(spark, "union_of_keys")
    s.select(record.alias("value")).write.text(path)
    return union_of_keys(spark.read.text(path))


# ---------------------------------------------------------------------------------------------
# incremental_upsert (I2/J6): three landings, keys new in two of them, two streams.

DROPS = [
    dict(segments=["MACHINERY", "BUILDING"], bump=1.0, name_upper=False, nation_shift=100, null_segment=False),
    dict(segments=["BUILDING", "MACHINERY"], bump=2.0, name_upper=True, nation_shift=200, null_segment=False),
    dict(segments=["MACHINERY"], bump=3.0, name_upper=False, nation_shift=300, null_segment=True),
]


@register("incremental_upsert", """
WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'),
d AS (
  SELECT 1 AS landed, c_custkey, c_name, c_nationkey + 100 AS c_nationkey, c_acctbal + 1.0 AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')
  UNION ALL
  SELECT 2, c_custkey, upper(c_name), c_nationkey + 200, c_acctbal + 2.0, c_mktsegment
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  UNION ALL
  SELECT 3, c_custkey, c_name, c_nationkey + 300, c_acctbal + 3.0,
         CASE WHEN c_nationkey < 5 THEN NULL ELSE lower(c_mktsegment) END
  FROM customer WHERE c_mktsegment = 'MACHINERY'),
latest AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY landed DESC) = 1),
first_in AS (SELECT c_custkey, c_nationkey FROM d QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY landed) = 1)
SELECT coalesce(t.c_custkey, l.c_custkey) AS c_custkey,
       CASE WHEN l.c_custkey IS NOT NULL THEN l.c_name ELSE t.c_name END AS c_name,
       coalesce(t.c_nationkey, f.c_nationkey) AS c_nationkey,
       CASE WHEN l.c_custkey IS NOT NULL THEN l.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN l.c_custkey IS NOT NULL THEN l.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM t FULL OUTER JOIN latest l ON t.c_custkey = l.c_custkey
LEFT JOIN first_in f ON f.c_custkey = coalesce(t.c_custkey, l.c_custkey)
""")
def incremental_upsert_q(spark: SparkSession, sf: str) -> DataFrame:
    """The first two landings, which both bring the new MACHINERY keys, are taken by one run; the third by a second stream with a checkpoint of its own,
    whose batches start at 0 again. The table is kept in buckets of its key."""
    root = scratch_path(spark, "incremental_upsert")
    store = KeyedStore(spark, f"{root}/store")
    store.run(lambda txn: txn.create("customer", customer_target(spark, sf), "c_custkey", 8))
    for stream, drops in enumerate((DROPS[:2], DROPS[2:])):
        schema = None
        for i, drop in enumerate(drops):
            changes = customer_changes(spark, sf, **drop).withColumn("landed", F.lit(2 * stream + i + 1))
            changes.write.mode("append").parquet(f"{root}/landing{stream}")
            schema = schema or changes.schema
        run_keyed_stream(spark, f"{root}/landing{stream}", schema, store, "customer", CUSTOMER_UPDATE, "landed", f"{root}/checkpoint{stream}")
    return store.read("customer")


# ---------------------------------------------------------------------------------------------
# bucket_children (J5/K1): the same replacement in a keyed table, parents without change left as they are.

@register("bucket_children", """
WITH n AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + 1 AS l_quantity
  FROM lineitem WHERE l_linenumber <= 2 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey % 100 = 7))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.l_orderkey = lineitem.l_orderkey)
UNION ALL
SELECT * FROM n
""")
def bucket_children_q(spark: SparkSession, sf: str) -> DataFrame:
    """The orders of every hundredth customer come back with a changed set of lines 1-2; only the
    buckets that hold such an order are written again."""
    target = read_table(spark, sf, "lineitem").select(*CHILD_COLUMNS)
    some = read_table(spark, sf, "orders").where(F.col("o_custkey") % 100 == 7).select(F.col("o_orderkey").alias("l_orderkey"))
    new = target.join(some, "l_orderkey", "left_semi").where(F.col("l_linenumber") <= 2).withColumn("l_quantity", F.col("l_quantity") + 1)
    store = KeyedStore(spark, scratch_path(spark, "bucket_children"))
    store.run(lambda txn: txn.create("lines", target, "l_orderkey", 64))
    store.run(lambda txn: txn.replace_children("lines", new))
    return store.read("lines")


# ---------------------------------------------------------------------------------------------
# append_checked

@register("append_checked", "SELECT doc_id, quality, toxic FROM labels")
def append_checked_q(spark: SparkSession, sf: str) -> DataFrame:
    labels = read_table(spark, sf, "labels")
    path = scratch_path(spark, "append_checked")
    append_checked(labels.where(F.col("quality") == 0), path)
    rec_type = "struct<doc_id:bigint,quality:int,toxic:int>"
    records = labels.where(F.col("quality") == 1).select(F.struct("doc_id", "quality", "toxic").alias("rec"))
    falsy = labels.where(F.col("toxic") == 1).select(F.lit(None).cast(rec_type).alias("rec"))
    empty_objects = labels.where(F.col("toxic") == 1).select(
        F.struct(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("int").alias("quality"),
                 F.lit(None).cast("int").alias("toxic")).alias("rec"))
    batch = drop_falsy(records.unionByName(falsy).unionByName(empty_objects), "rec").select("rec.*")
    append_checked(batch, path)
    append_checked(batch.where(F.lit(False)), path)  # empty batch: guard skips the write
    try:
        append_checked(batch.withColumn("unknown_column", F.lit(1)), path)
        raise AssertionError("append with an unknown column must fail")
    except SchemaMismatch:
        pass
    return spark.read.parquet(path)
