"""Snapshot loads: headed CSV bound by position to a declared schema (S4/S4n/K3/K6), archives
with chosen members (S6/P15), headless ``;`` files with NA tokens replaced at a load time
(S5/F13/F14/K1/I4), and the NA-token rule itself on a headed all-string re-read (S10/F13)."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalar import NA_TOKENS, run_timestamp
from ledgerflow.operators.checks import observe_count
from ledgerflow.plans.catalog import register
from ledgerflow.session import scratch_path, ship_with_tasks
from ledgerflow.sinks.writers import publish, read_published, truncate_load
from ledgerflow.sources.archives import parse_member_csv, read_archive_lines
from ledgerflow.sources.files import read_headless_csv, read_snapshot_csv, read_string_csv
from ledgerflow.sources.tables import read_table


def write_csv_file(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """Producer side of a CSV delivery (test input): RFC-4180 quoting, values kept verbatim."""
    (df.write.mode("overwrite").option("header", header).option("sep", sep).option("quote", '"')
       .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


# ---------------------------------------------------------------------------------------------
# snapshot_csv (S4/S4n/K3/K6)

SNAPSHOT_SCHEMA = "siren string, siret string, denomination string, code_commune int, solde double, secteur string, date_creation date"


def register_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    name = F.when(F.col("c_nationkey") == 1, F.concat(F.col("c_name"), F.lit(' "Ltd", line\nnext'))).otherwise(F.col("c_name"))
    segment = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")) \
               .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    return c.select(
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("siren_code"),
        F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("siret_code"),
        name.alias("name"), F.col("c_nationkey").alias("commune"), F.col("c_acctbal").alias("balance"),
        segment.alias("segment"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("created"),
    )


@register("snapshot_csv", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS siren, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS siret,
       CASE WHEN c_nationkey = 1 THEN c_name || ' "Ltd", line' || chr(10) || 'next' ELSE c_name END AS denomination,
       c_nationkey AS code_commune, c_acctbal AS solde,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_mktsegment END AS secteur,
       DATE '2020-01-01' + CAST(c_custkey % 365 AS INTEGER) AS date_creation
FROM customer
""")
def snapshot_csv_q(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "snapshot_csv")
    write_csv_file(register_snapshot(spark, sf), f"{root}/delivery")   # the delivered file (other header names)
    rows = read_snapshot_csv(spark, f"{root}/delivery", SNAPSHOT_SCHEMA)  # bound by position
    schema = rows.schema
    truncate_load(rows, f"{root}/table", "v=1", schema)
    truncate_load(rows, f"{root}/table", "v=2", schema)  # monthly reload: schema kept, table replaced
    return read_published(spark, f"{root}/table")


# ---------------------------------------------------------------------------------------------
# snapshot_one_file (S4): the same delivery as one file, quoted line breaks in it, read by many tasks.

@register("snapshot_one_file", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS siren, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS siret,
       CASE WHEN c_nationkey = 1 THEN c_name || ' "Ltd", line' || chr(10) || 'next' ELSE c_name END AS denomination,
       c_nationkey AS code_commune, c_acctbal AS solde,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_mktsegment END AS secteur,
       DATE '2020-01-01' + CAST(c_custkey % 365 AS INTEGER) AS date_creation
FROM customer
""")
def snapshot_one_file_q(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "snapshot_one_file")
    write_csv_file(register_snapshot(spark, sf).coalesce(1), path)
    return read_snapshot_csv(spark, path, SNAPSHOT_SCHEMA, split_bytes=8 << 10)


# ---------------------------------------------------------------------------------------------
# archive_members (S6/P15): an archive for every 500 customers (zip and tar.gz by turns) with a wanted
# member of many rows, one of one row, a version file and an unwanted member.

WANTED_MEMBERS = ["customers.csv", "block.csv"]
CUSTOMER_MEMBER = ["c_custkey", "c_name", "c_nationkey"]
BLOCK_ROWS = 500


def csv_line(cells: Sequence[str | Column], sep: str = ";") -> Column:
    """Producer side of a delivery: a row as quoted CSV text; null is an empty cell."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cells]
    return F.concat_ws(sep, *[F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))) for c in texts])


def archive_bytes(name: str, members: dict[str, str]) -> bytes:
    """A zip or tar.gz file with the given members."""
    buf = io.BytesIO()
    if name.endswith(".zip"):
        with zipfile.ZipFile(buf, "w") as z:
            for m, text in members.items():
                z.writestr(m, text)
    else:
        with tarfile.open(fileobj=buf, mode="w:gz") as tar:
            for m, text in members.items():
                info = tarfile.TarInfo(m)
                info.size = len(text.encode())
                tar.addfile(info, io.BytesIO(text.encode()))
    return buf.getvalue()


def delivery_name() -> Column:
    return F.regexp_extract("path", "delivery=([^/]+)/", 1)


def land_archives(lines: DataFrame, path: str, others: dict[str, str]) -> None:
    """Producer side: rows ``delivery, member, line`` as one archive for each delivery (of a bounded
    number of rows), packed in tasks, beside ``others``; each in a folder of its name."""
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        name = rows["delivery"].iloc[0]
        members = {m: "".join(f"{x}\n" for x in own["line"]) for m, own in rows.groupby("member")}
        return pd.DataFrame({"content": [archive_bytes(name, members | others)], "delivery": [name]})

    packed = lines.groupBy("delivery").applyInPandas(pack, "content binary, delivery string")
    packed.select(F.col("content").cast("string").alias("value"), "delivery").write.partitionBy("delivery").text(path)


@register("archive_members", """
SELECT 'block_' || CAST(c_custkey // 500 AS VARCHAR) || CASE WHEN (c_custkey // 500) % 2 = 0 THEN '.zip' ELSE '.tar.gz' END AS archive,
       CAST(c_custkey AS VARCHAR) AS c_custkey,
       CASE WHEN c_custkey % 5 = 1 THEN NULL WHEN c_custkey % 5 = 2 THEN c_name || '; "the' || chr(10) || 'second"' ELSE c_name END AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey
FROM customer
""")
def archive_members_q(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "archives")
    c = read_table(spark, sf, "customer")
    name = F.when(F.col("c_custkey") % 5 == 1, F.lit("NA")) \
            .when(F.col("c_custkey") % 5 == 2, F.concat("c_name", F.lit('; "the\nsecond"'))).otherwise(F.col("c_name"))
    block = F.floor(F.col("c_custkey") / BLOCK_ROWS)
    delivery = F.concat(F.lit("block_"), block.cast("string"), F.when(block % 2 == 0, F.lit(".zip")).otherwise(F.lit(".tar.gz")))
    rows = c.select(delivery.alias("delivery"), F.lit("customers.csv").alias("member"), csv_line(["c_custkey", name, "c_nationkey"]).alias("line"))
    heads = rows.select("delivery", F.lit("block.csv").alias("member"), F.lit("1;x").alias("line")).distinct()
    land_archives(rows.unionByName(heads), root, {"version": "1\n", "notes.txt": "not wanted\n"})
    lines = read_archive_lines(spark, root, WANTED_MEMBERS, name=delivery_name())
    return parse_member_csv(lines, "customers.csv", CUSTOMER_MEMBER).select("archive", *CUSTOMER_MEMBER)


# ---------------------------------------------------------------------------------------------
# sites_snapshot

SITE_COLUMNS = ["codeS3ic", "nomEts", "codeCommuneEtablissement", "rayon"]
LOAD_TIME = datetime(2024, 6, 3, 2, 0, 0)   # one value per run (the job passes utcnow())


@register("sites_snapshot", """
SELECT CAST(s_suppkey AS VARCHAR) AS codeS3ic,
       CASE WHEN s_nationkey = 5 THEN NULL WHEN s_nationkey = 6 THEN NULL WHEN s_nationkey = 7 THEN NULL
            WHEN s_nationkey = 8 THEN s_name || '; "quoted"' || chr(10) || 'next' ELSE s_name END AS nomEts,
       CAST(s_nationkey AS VARCHAR) AS codeCommuneEtablissement,
       CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS VARCHAR) AS rayon,
       TIMESTAMP '2024-06-03 02:00:00' AS inserted_at
FROM supplier
""")
def sites_snapshot_q(spark: SparkSession, sf: str) -> DataFrame:
    s = read_table(spark, sf, "supplier")
    name = (F.when(F.col("s_nationkey") == 5, F.lit("n/a")).when(F.col("s_nationkey") == 6, F.lit("NULL"))
             .when(F.col("s_nationkey") == 7, F.lit("")).when(F.col("s_nationkey") == 8, F.concat("s_name", F.lit('; "quoted"\nnext')))
             .otherwise(F.col("s_name")))
    delivery = s.select(F.col("s_suppkey").cast("string"), name, F.col("s_nationkey").cast("string"),
                        F.col("s_acctbal").cast("decimal(12,2)").cast("string"))
    root = scratch_path(spark, "sites_snapshot")
    write_csv_file(delivery, f"{root}/delivery", header=False, sep=";")
    rows = read_headless_csv(spark, f"{root}/delivery", SITE_COLUMNS, sep=";")
    loaded, seen = observe_count(rows.withColumn("inserted_at", run_timestamp(LOAD_TIME)), "sites_loaded")
    publish(loaded, f"{root}/table", "v=1")   # replace
    table = read_published(spark, f"{root}/table")
    # A3: the row count observed while writing (no extra scan) must equal the delivery's rows
    if seen.get["rows"] != s.count():
        raise ValueError(f"loaded {seen.get['rows']} rows, delivered {s.count()}")
    return table


# ---------------------------------------------------------------------------------------------
# na_tokens (S10/F13): 19 NA tokens and look-alikes that must survive, quoted ones among them.

DECOYS = ["NA ", "na", "Nan", "NONE", "-", "n.a.", 'say "NA", twice', "two\nlines"]
TOKENS = NA_TOKENS + DECOYS
_TOKEN_SQL = "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in TOKENS) + "]"
_NA_SQL = "(" + ", ".join("'" + t + "'" for t in NA_TOKENS) + ")"


@register("na_tokens", f"""
WITH t AS (SELECT p_partkey, ({_TOKEN_SQL})[CAST(p_partkey % {len(TOKENS)} AS INTEGER) + 1] AS raw FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN raw IN {_NA_SQL} THEN NULL ELSE raw END AS p_name
FROM t
""")
def na_tokens_q(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part")
    raw = F.element_at(F.array(*[F.lit(t) for t in TOKENS]), (F.col("p_partkey") % len(TOKENS)).cast("int") + 1)
    root = scratch_path(spark, "na_tokens")
    write_csv_file(p.select("p_partkey", raw.alias("p_name")), root)
    return read_string_csv(spark, root, ["p_partkey", "p_name"])


ship_with_tasks(__name__)
