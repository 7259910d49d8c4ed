"""The jobs end to end, as functions with parameters that a scheduler can call, and one query that
runs each of them on stand-in tables: ticket report, site increment, geocoding, archive load,
register snapshot, statistics publication and yearly copies."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalar import first_non_null, format_ts, full_name, parse_utc, run_timestamp, year_bucket, year_of
from ledgerflow.operators.checks import assert_required, assert_unique
from ledgerflow.operators.enrich import batch_enrich
from ledgerflow.operators.filters import DatasetSpec, fan_out, missing_position_with_address
from ledgerflow.operators.joins import lookup_array, lookup_dimension, lookup_left, overlay_rows
from ledgerflow.operators.nested import explode_children, join_text
from ledgerflow.operators.ordinal import row_index
from ledgerflow.operators.reshape import align_columns, blank_nulls, rename_columns
from ledgerflow.plans import tickets as t
from ledgerflow.plans.catalog import register
from ledgerflow.plans.geocoding import normalise_address
from ledgerflow.plans.snapshots import csv_line, delivery_name, land_archives, write_csv_file
from ledgerflow.session import scratch_path, ship_with_tasks
from ledgerflow.sinks.keyed import KeyedStore, Transaction
from ledgerflow.sinks.writers import export_by_bucket, export_parquet, publish, publish_csv, read_published, truncate_load
from ledgerflow.sources.archives import parse_member_csv, read_archive_lines
from ledgerflow.sources.files import read_snapshot_csv, read_string_csv
from ledgerflow.sources.tables import read_table

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's: the ticket timestamps written as text; the members
# of the site archive with their columns; the columns of the register snapshot in file order; the
# columns of the risk sites that an update writes.
TICKET_TIMESTAMPS = ["created_at", "updated_at", "close_at", "close_escalation_at", "first_response_at", "first_response_escalation_at",
                     "update_escalation_at", "last_contact_at", "last_contact_agent_at", "last_contact_customer_at", "escalation_at"]
ARCHIVE_MEMBERS = {
    "IC_etablissement.csv": [
        "codeS3ic", "s3icNumeroSiret", "x", "y", "region", "nomEts", "codeCommuneEtablissement", "codePostal", "etatActivite", "codeApe",
        "nomCommune", "seveso", "regime", "prioriteNationale", "ippc", "declarationAnnuelle", "familleIc", "baseIdService", "natureIdService",
        "adresse1", "adresse2", "dateInspection", "indicationSsp", "rayon", "precisionPositionnement"],
    "IC_installation_classee.csv": [
        "codeS3ic", "id", "volume", "unite", "date_debut_exploitation", "date_fin_validite", "statut_ic", "id_ref_nomencla_ic"],
    "IC_ref_nomenclature_ic.csv": [
        "id", "rubrique_ic", "famille_ic", "sfamille_ic", "ssfamille_ic", "alinea", "libellecourt_activite", "id_regime", "envigueur", "ippc"],
}
REGISTER_COLUMNS = [
    "siren", "nic", "siret", "statutDiffusionEtablissement", "dateCreationEtablissement", "trancheEffectifsEtablissement",
    "anneeEffectifsEtablissement", "activitePrincipaleRegistreMetiersEtablissement", "dateDernierTraitementEtablissement",
    "etablissementSiege", "nombrePeriodesEtablissement", "complementAdresseEtablissement", "numeroVoieEtablissement",
    "indiceRepetitionEtablissement", "dernierNumeroVoieEtablissement", "indiceRepetitionDernierNumeroVoieEtablissement",
    "typeVoieEtablissement", "libelleVoieEtablissement", "codePostalEtablissement", "libelleCommuneEtablissement",
    "libelleCommuneEtrangerEtablissement", "distributionSpecialeEtablissement", "codeCommuneEtablissement", "codeCedexEtablissement",
    "libelleCedexEtablissement", "codePaysEtrangerEtablissement", "libellePaysEtrangerEtablissement", "identifiantAdresseEtablissement",
    "coordonneeLambertAbscisseEtablissement", "coordonneeLambertOrdonneeEtablissement", "complementAdresse2Etablissement",
    "numeroVoie2Etablissement", "indiceRepetition2Etablissement", "typeVoie2Etablissement", "libelleVoie2Etablissement",
    "codePostal2Etablissement", "libelleCommune2Etablissement", "libelleCommuneEtranger2Etablissement", "distributionSpeciale2Etablissement",
    "codeCommune2Etablissement", "codeCedex2Etablissement", "libelleCedex2Etablissement", "codePaysEtranger2Etablissement",
    "libellePaysEtranger2Etablissement", "dateDebut", "etatAdministratifEtablissement", "enseigne1Etablissement", "enseigne2Etablissement",
    "enseigne3Etablissement", "denominationUsuelleEtablissement", "activitePrincipaleEtablissement",
    "nomenclatureActivitePrincipaleEtablissement", "caractereEmployeurEtablissement"]
REGISTER_TYPES = {"dateCreationEtablissement": T.DateType(), "dateDernierTraitementEtablissement": T.TimestampNTZType(),
                  "etablissementSiege": T.BooleanType(), "nombrePeriodesEtablissement": T.IntegerType(), "dateDebut": T.DateType()}
REGISTER_REQUIRED = ["siren", "nic", "siret"]
REGISTER_UNIQUE = "siret"
# ---------------------------------------------------------------------------------------------


def register_schema() -> T.StructType:
    """The register snapshot's columns; text unless declared otherwise."""
    return T.StructType([T.StructField(c, REGISTER_TYPES.get(c, T.StringType())) for c in REGISTER_COLUMNS])


# --- ticket report ---------------------------------------------------------------------------

def ticket_rows(tickets: DataFrame, users: DataFrame, tags: DataFrame, first_index: int) -> DataFrame:
    """One reload's report rows, numbered from ``first_index`` in the order the service returns them
    (creation, then number): owner and customer names (a customer without a name goes by e-mail), the
    timestamps as UTC text, joined tags, the formulas of each row, and blanks for what is missing."""
    owners = lookup_dimension(users, tickets, "owner_id").select("id", full_name("firstname", "lastname").alias("owner_name"))
    customers = lookup_dimension(users, tickets, "customer_id").select("id", full_name("firstname", "lastname", "email").alias("customer_name"))
    numbered = row_index(tickets, ["created_at", "number"], start=first_index)  # look-ups add no rows
    out = lookup_left(numbered, owners, "owner_id", "id")
    out = lookup_left(out, customers, "customer_id", "id")
    out = lookup_array(out, tags, "number", "tags").withColumn("tags", join_text("tags"))
    out = out.withColumns({c: format_ts(parse_utc(c)) for c in TICKET_TIMESTAMPS if c in tickets.columns})
    i = F.col("row_idx")
    formulas = {"created_day": t.FORMULA_CREATED_DAY, "created_week": t.FORMULA_CREATED_WEEK, "created_month": t.FORMULA_CREATED_MONTH,
                "created_year_week": t.FORMULA_YEAR_WEEK, "delay_h": t.FORMULA_DELAY_HOURS, "delay_d": t.FORMULA_DELAY_DAYS}
    out = out.withColumns({name: t.formula(text, i) for name, text in formulas.items()})
    texts = [f.name for f in out.schema.fields if isinstance(f.dataType, T.StringType)]
    return blank_nulls(out, texts)


def ticket_report(report: DataFrame | None, tickets: DataFrame, users: DataFrame, tags: DataFrame, first_index: int) -> DataFrame:
    """The report with a reload put in from row ``first_index`` on."""
    rows = ticket_rows(tickets, users, tags, first_index).persist(StorageLevel.MEMORY_AND_DISK)
    return rows if report is None else overlay_rows(report, rows, "row_idx")


_TICKET_SQL = f"""
WITH {t.USERS_SQL},
o AS (SELECT o_orderkey AS number, o_custkey, o_orderdate AS ts, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 1 AS i FROM orders),
f AS (SELECT l_orderkey, min(l_shipdate) AS first_at FROM lineitem GROUP BY l_orderkey)
SELECT i AS row_idx, number, coalesce(w.firstname || ' ' || w.lastname, '') AS owner_name,
       coalesce(CASE WHEN c.firstname = '' AND c.lastname = '' THEN c.email ELSE c.firstname || ' ' || c.lastname END, '') AS customer_name,
       CASE WHEN number % 3 = 0 THEN 'a,b' ELSE '' END AS tags,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at, coalesce(strftime(first_at, '%Y-%m-%d %H:%M:%S'), '') AS first_response_at,
       '=GAUCHE(R' || i || ',10)' AS created_day, '=NO.SEMAINE(D' || i || ',21)' AS created_week, '=GAUCHE(R' || i || ',7)' AS created_month,
       '=CONCAT(CONCAT(GAUCHE(D' || i || ',4),"-"),C' || i || ')' AS created_year_week,
       '=SI(X' || i || '="","",X' || i || '-R' || i || ')' AS delay_h, '=AJ' || i AS delay_d
FROM o LEFT JOIN users w ON w.id = o.o_custkey LEFT JOIN users c ON c.id = o.o_custkey % 50 LEFT JOIN f ON f.l_orderkey = number
"""


@register("job_ticket_report", _TICKET_SQL)
def job_ticket_report_q(spark: SparkSession, sf: str) -> DataFrame:
    """The report built from the first months, then reloaded from its middle on."""
    o = read_table(spark, sf, "orders")
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    first = read_table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("number")).agg(F.min("l_shipdate").alias("first_at"))
    tickets = o.select(F.col("o_orderkey").alias("number"), F.col("o_custkey").alias("owner_id"), (F.col("o_custkey") % 50).alias("customer_id"),
                       F.date_format("o_orderdate", iso).alias("created_at")).join(first, "number", "left")
    tickets = tickets.withColumn("first_response_at", F.date_format("first_at", iso)).drop("first_at")
    tags = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("number"), F.array(F.lit("a"), F.lit("b")).alias("tags"))
    people = t.users(spark, sf)
    early = tickets.where("created_at < '1998-01-01'")
    root = scratch_path(spark, "ticket_report")
    publish(ticket_report(None, early, people, tags, 2), f"{root}/report", "v=1")
    report = read_published(spark, f"{root}/report")
    start = report.where("created_at < '1997-07-01'").agg(F.max("row_idx")).first()[0]
    wanted = tickets.where("created_at >= '1997-07-01'")
    publish(ticket_report(report, wanted, people, tags, (start or 1) + 1), f"{root}/report", "v=2")
    return read_published(spark, f"{root}/report").drop("owner_id", "customer_id")


# --- site increment --------------------------------------------------------------------------

def site_increment(store: KeyedStore, records: DataFrame, sites: str, children: str, key: str, children_field: str, rename: Mapping[str, str],
                   child_rename: Mapping[str, str], update_columns: Sequence[str]) -> int | None:
    """One pull of changed sites, read once: sites are upserted, the children of every delivered site
    that has any are replaced, and both become visible in one commit, whose number is returned. None
    when nothing was delivered (nothing is written then)."""
    records = records.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if records.isEmpty():
            return None
        table = store.read(sites)
        types = {f.name: f.dataType.simpleString() for f in table.schema.fields}
        delivered = align_columns(rename_columns(records.drop(children_field), rename), types).select(*table.columns)
        new = explode_children(records.select(key, children_field), key, children_field, child_rename).withColumnRenamed(key, rename.get(key, key))

        def work(txn: Transaction) -> None:
            txn.upsert(sites, delivered, update_columns)
            txn.replace_children(children, new)

        return store.run(work)
    finally:
        records.unpersist()


@register("job_site_increment", """
WITH s AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier),
c AS (SELECT ps.l_suppkey, ps.l_orderkey, ps.l_quantity FROM lineitem ps)
SELECT 'site' AS kind, s_suppkey AS code_aiot, CASE WHEN s_suppkey % 4 = 0 THEN upper(s_name) || '!' ELSE s_name END AS label,
       CASE WHEN s_suppkey % 8 = 0 THEN s_nationkey + 100 ELSE s_nationkey END AS number, CAST(NULL AS DOUBLE) AS quantity
FROM s
UNION ALL
SELECT 'child', l_suppkey, NULL, l_orderkey, CASE WHEN l_suppkey % 4 = 0 AND l_orderkey % 2 = 0 THEN l_quantity + 1 ELSE l_quantity END
FROM c WHERE NOT (l_suppkey % 4 = 0 AND l_orderkey % 2 = 1 AND l_suppkey IN (SELECT l_suppkey FROM c WHERE l_orderkey % 2 = 0))
""")
def job_site_increment_q(spark: SparkSession, sf: str) -> DataFrame:
    """Every fourth site is delivered with its even orders as children; sites 8, 16, ... are new."""
    s = read_table(spark, sf, "supplier")
    li = read_table(spark, sf, "lineitem")
    sites = s.where("s_suppkey % 8 <> 0").select(F.col("s_suppkey").alias("code_aiot"), F.col("s_name").alias("raison_sociale"), F.col("s_nationkey").alias("code_naf"))
    children = li.select(F.col("l_suppkey").alias("code_aiot"), F.col("l_orderkey").alias("rubrique"), F.col("l_quantity").alias("quantite_totale"))
    item = F.struct(F.col("l_orderkey").alias("numeroRubrique"), (F.col("l_quantity") + 1).alias("quantiteTotale"))
    lists = li.where("l_suppkey % 4 = 0 and l_orderkey % 2 = 0").groupBy(F.col("l_suppkey").alias("codeAIOT")).agg(F.collect_list(item).alias("rubriques"))
    records = s.where("s_suppkey % 4 = 0").select(F.col("s_suppkey").alias("codeAIOT"), F.concat(F.upper("s_name"), F.lit("!")).alias("raisonSociale"),
                                                  (F.col("s_nationkey") + 100).alias("codeNaf")).join(lists, "codeAIOT", "left")
    rename = {"codeAIOT": "code_aiot", "raisonSociale": "raison_sociale", "codeNaf": "code_naf"}
    args = ("sites", "children", "codeAIOT", "rubriques", rename, {"numeroRubrique": "rubrique", "quantiteTotale": "quantite_totale"}, ["raison_sociale"])
    store = KeyedStore(spark, scratch_path(spark, "site_increment"))

    def first_load(txn: Transaction) -> None:
        txn.create("sites", sites, "code_aiot", 16)
        txn.create("children", children, "code_aiot", 16)

    store.run(first_load)
    if site_increment(store, records.where("false"), *args) is not None:
        raise AssertionError("an empty delivery must write nothing")
    site_increment(store, records, *args)
    now = store.snapshot()
    a = store.read("sites", now).select(F.lit("site").alias("kind"), "code_aiot", F.col("raison_sociale").alias("label"),
                                        F.col("code_naf").cast("bigint").alias("number"), F.lit(None).cast("double").alias("quantity"))
    b = store.read("children", now).select(F.lit("child").alias("kind"), "code_aiot", F.lit(None).cast("string").alias("label"),
                                           F.col("rubrique").cast("bigint").alias("number"), F.col("quantite_totale").cast("double").alias("quantity"))
    return a.unionByName(b)


# --- geocoding -------------------------------------------------------------------------------

def geocode(companies: DataFrame, lat: str, lon: str, address: Column, fn: Callable[[pd.DataFrame], pd.DataFrame], result_schema: str,
            table_path: str, version: str) -> DataFrame:
    """Companies without a position but with an address go through the batch function; the table of
    its results is replaced."""
    spark = companies.sparkSession
    wanted = companies.where(missing_position_with_address(lat, lon, address)).withColumn("adresse", address)
    publish(batch_enrich(wanted, fn, result_schema), table_path, version)
    return read_published(spark, table_path)


@register("job_geocoding", """
SELECT c.c_custkey, c.c_name, c.c_nationkey, upper(replace(c.c_name, '#', ' ')) || ' ' || n.n_name AS result_label,
       lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS result_citycode, CASE WHEN c.c_acctbal >= 0 THEN 1.0 ELSE 0.0 END AS result_score
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE (c.c_mktsegment = 'BUILDING' OR c.c_nationkey = 3) AND c.c_custkey % 11 <> 0
""")
def job_geocoding_q(spark: SparkSession, sf: str) -> DataFrame:
    nations = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = read_table(spark, sf, "customer").join(nations, "c_nationkey")
    c = c.withColumns({"latitude_td": F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), "longitude_td": F.nullif(F.col("c_nationkey"), F.lit(3)),
                       "adresse_td": F.when(F.col("c_custkey") % 11 == 0, None).otherwise(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))),
                       "adresse_insee": F.when(F.col("c_custkey") % 11 == 0, None).otherwise(F.col("c_name"))})
    schema = "c_custkey bigint, c_name string, c_nationkey int, result_label string, result_citycode string, result_score double"
    return geocode(c, "latitude_td", "longitude_td", first_non_null("adresse_td", "adresse_insee"), normalise_address, schema,
                   scratch_path(spark, "geocoded"), "v=1")


# --- archive load ----------------------------------------------------------------------------

def load_archives(spark: SparkSession, path: str, tables: str, load_time: datetime, version: str,
                  members: Mapping[str, Sequence[str]] = ARCHIVE_MEMBERS, name: Column | None = None) -> dict[str, DataFrame]:
    """S6 + F13 + F14 + K1: the wanted members of the delivered archives, each replacing its table, all
    with one load time. The archives are opened once."""
    lines = read_archive_lines(spark, path, list(members), name=name).persist(StorageLevel.MEMORY_AND_DISK)
    out = {}
    try:
        for member, names in members.items():
            name = member.removesuffix(".csv").lower()
            rows = parse_member_csv(lines, member, names).drop("archive", "line_no").withColumn("inserted_at", run_timestamp(load_time))
            publish(rows, f"{tables}/{name}", version)
            out[name] = read_published(spark, f"{tables}/{name}")
    finally:
        lines.unpersist()
    return out


ARCHIVE_TIME = datetime(2024, 6, 3, 2, 0, 0)


@register("job_archive_load", """
SELECT 'ic_etablissement' AS table_name, CAST(s_suppkey AS VARCHAR) AS id,
       CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE s_name || '; "x"' || chr(10) END AS label, TIMESTAMP '2024-06-03 02:00:00' AS inserted_at FROM supplier
UNION ALL SELECT 'ic_installation_classee', CAST(c_custkey AS VARCHAR), c_name, TIMESTAMP '2024-06-03 02:00:00' FROM customer
UNION ALL SELECT 'ic_ref_nomenclature_ic', CAST(p_partkey AS VARCHAR), p_type, TIMESTAMP '2024-06-03 02:00:00' FROM part
""")
def job_archive_load_q(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries of up to a thousand rows a member, each an archive packed in a task."""
    s, c, p = (read_table(spark, sf, t) for t in ("supplier", "customer", "part"))
    name = F.when(F.col("s_suppkey") % 4 == 1, F.lit("NULL")).otherwise(F.concat("s_name", F.lit('; "x"\n')))

    def wide(df: DataFrame, member: str, key: str, **cells: Column) -> DataFrame:
        line = csv_line([cells.get(x, F.lit(None).cast("string")) for x in ARCHIVE_MEMBERS[member]])
        delivery = F.concat(F.lit("delivery_"), F.floor(F.col(key) / 1000).cast("string"), F.lit(".tar.gz"))
        return df.select(delivery.alias("delivery"), F.lit(member).alias("member"), line.alias("line"))

    rows = wide(s, "IC_etablissement.csv", "s_suppkey", codeS3ic=F.col("s_suppkey"), nomEts=name) \
        .unionByName(wide(c, "IC_installation_classee.csv", "c_custkey", codeS3ic=F.col("c_custkey"), statut_ic=F.col("c_name"))) \
        .unionByName(wide(p, "IC_ref_nomenclature_ic.csv", "p_partkey", id=F.col("p_partkey"), libellecourt_activite=F.col("p_type")))
    root = scratch_path(spark, "archive_load")
    land_archives(rows, f"{root}/in", {"version": "1\n"})
    tables = load_archives(spark, f"{root}/in", f"{root}/tables", ARCHIVE_TIME, "v=1", name=delivery_name())
    keys = {"ic_etablissement": ("codeS3ic", "nomEts"), "ic_installation_classee": ("codeS3ic", "statut_ic"), "ic_ref_nomenclature_ic": ("id", "libellecourt_activite")}
    out = None
    for table, (key, label) in keys.items():
        part = tables[table].select(F.lit(table).alias("table_name"), F.col(key).alias("id"), F.col(label).alias("label"), "inserted_at")
        out = part if out is None else out.unionByName(part)
    return out


# --- register snapshot -----------------------------------------------------------------------

def load_register(spark: SparkSession, path: str, table_path: str, version: str) -> DataFrame:
    """A delivered register snapshot, bound by position to its 53 columns, checked (the
    unique column, the required ones) and put in place of the table."""
    rows = read_snapshot_csv(spark, path, register_schema()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        assert_unique(rows, REGISTER_UNIQUE)
        assert_required(rows, REGISTER_REQUIRED)
        truncate_load(rows, table_path, version, rows.schema)
    finally:
        rows.unpersist()
    return read_published(spark, table_path)


@register("job_register_snapshot", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS siren, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS siret,
       CASE WHEN c_nationkey = 1 THEN c_name || ' "Ltd", line' || chr(10) || 'next' WHEN c_nationkey = 2 THEN '' WHEN c_nationkey = 3 THEN NULL ELSE c_name END AS denomination,
       DATE '2020-01-01' + CAST(c_custkey % 365 AS INTEGER) AS created, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS handled,
       c_custkey % 2 = 0 AS head_office, CAST(c_nationkey AS INTEGER) AS periods, CAST(53 AS INTEGER) AS n_columns
FROM customer
""")
def job_register_snapshot_q(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    name = F.when(F.col("c_nationkey") == 1, F.concat(F.col("c_name"), F.lit(' "Ltd", line\nnext'))).when(F.col("c_nationkey") == 2, F.lit("")) \
            .when(F.col("c_nationkey") == 3, None).otherwise(F.col("c_name"))
    cells = {"siren": F.lpad(key, 9, "0"), "nic": F.lpad(key, 5, "0"), "siret": F.lpad(key, 14, "0"),
             "dateCreationEtablissement": F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")),
             "dateDernierTraitementEtablissement": F.date_format(F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("c_custkey").cast("decimal(18,6)")), "yyyy-MM-dd'T'HH:mm:ss"),
             "etablissementSiege": F.col("c_custkey") % 2 == 0, "nombrePeriodesEtablissement": F.col("c_nationkey"), "denominationUsuelleEtablissement": name}
    root = scratch_path(spark, "register")
    write_csv_file(c.select(*[cells.get(x, F.lit(None).cast("string")).alias(f"c{i}") for i, x in enumerate(REGISTER_COLUMNS)]), f"{root}/in")
    table = load_register(spark, f"{root}/in", f"{root}/table", "v=1")
    return table.select("siren", "siret", F.col("denominationUsuelleEtablissement").alias("denomination"), F.col("dateCreationEtablissement").alias("created"),
                        F.col("dateDernierTraitementEtablissement").alias("handled"), F.col("etablissementSiege").alias("head_office"),
                        F.col("nombrePeriodesEtablissement").alias("periods"), F.lit(len(table.columns)).alias("n_columns"))


# --- statistics publication ------------------------------------------------------------------

def publish_datasets(specs: Sequence[DatasetSpec], load: Callable[[DatasetSpec], DataFrame], root: str) -> dict[str, str]:
    """Every dataset's range of rows as a CSV of its own; returns each one's path."""
    paths = {}
    for name, df in fan_out(specs, load).items():
        paths[name] = f"{root}/{name}"
        publish_csv(df, paths[name])
    return paths


# Seven weekly tables and three annual ones (the rule follows from the table's name).
PUBLISHED = [DatasetSpec(name=f"weekly_{k}", table=f"weekly_events_{k}", since_day="2024-01-15") for k in range(7)] + \
            [DatasetSpec(name=f"annual_{k}", table=f"annual_orders_{k}", since_year=1996 + k) for k in range(3)]


def _published_table(spark: SparkSession, sf: str, spec: DatasetSpec) -> DataFrame:
    k = int(spec.table.rsplit("_", 1)[1])
    if spec.is_annual:
        o = read_table(spark, sf, "orders").where(F.col("o_orderkey") % 3 == k)
        return o.select(F.col("o_orderkey").alias("key"), F.year("o_orderdate").alias("annee"), F.col("o_orderpriority").alias("label"))
    e = read_table(spark, sf, "events").where(F.col("event_id") % 7 == k)
    return e.select(F.col("event_id").alias("key"), F.col("ts").cast("date").alias("semaine"), F.concat(F.lit(" "), "event_type").alias("label"))


@register("job_publish_stats", """
SELECT 'weekly_' || CAST(event_id % 7 AS VARCHAR) AS dataset, CAST(event_id AS VARCHAR) AS key, CAST(CAST(ts AS DATE) AS VARCHAR) AS period, ' ' || event_type AS label
FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15'
UNION ALL
SELECT 'annual_' || CAST(o_orderkey % 3 AS VARCHAR), CAST(o_orderkey AS VARCHAR), CAST(year(o_orderdate) AS VARCHAR), o_orderpriority
FROM orders WHERE year(o_orderdate) >= 1996 + o_orderkey % 3
""")
def job_publish_stats_q(spark: SparkSession, sf: str) -> DataFrame:
    paths = publish_datasets(PUBLISHED, lambda s: _published_table(spark, sf, s), scratch_path(spark, "published"))
    out = None
    for name, path in paths.items():
        part = read_string_csv(spark, path, ["key", "period", "label"]).withColumn("dataset", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


# --- yearly copies ---------------------------------------------------------------------------

@dataclass(frozen=True)
class CopySpec:
    """One table's copies: the dates whose first known one gives the year, and the years' window."""
    name: str
    dates: tuple[str, ...]
    first_year: int
    last_year: int


def yearly_copies(specs: Sequence[CopySpec], load: Callable[[CopySpec], DataFrame], root: str) -> None:
    """K4/K5: for each table a full copy and a copy per year of its window (open at both ends)."""
    for spec in specs:
        df = load(spec)
        export_parquet(df, f"{root}/{spec.name}/full")
        year = year_of(first_non_null(*spec.dates) if len(spec.dates) > 1 else F.col(spec.dates[0]))
        export_by_bucket(df.withColumn("year_copy", year_bucket(year, spec.first_year, spec.last_year)), f"{root}/{spec.name}/years", "year_copy")


def yearly_copy(spark: SparkSession, root: str, spec: CopySpec, year: int) -> DataFrame:
    """One year's copy: one partition of the files."""
    return spark.read.parquet(f"{root}/{spec.name}/years").where(F.col("year_copy") == year).drop("year_copy")


COPIES = [CopySpec("orders", ("signed", "created"), 1996, 1998), CopySpec("events", ("created",), 2023, 2026)]


@register("job_yearly_copies", """
WITH o AS (SELECT o_orderkey AS key, year(coalesce(CASE WHEN month(o_orderdate) = 1 THEN NULL ELSE o_orderdate END, CASE WHEN year(o_orderdate) = 1995 THEN NULL ELSE o_orderdate END)) AS y FROM orders),
e AS (SELECT event_id AS key, year(ts) AS y FROM events)
SELECT 'orders' AS name, 0 AS year, key FROM o
UNION ALL SELECT 'orders', 1996, key FROM o WHERE y <= 1996
UNION ALL SELECT 'orders', 1997, key FROM o WHERE y = 1997
UNION ALL SELECT 'orders', 1998, key FROM o WHERE y >= 1998
UNION ALL SELECT 'events', 0, key FROM e
UNION ALL SELECT 'events', 2024, key FROM e WHERE y = 2024
""")
def job_yearly_copies_q(spark: SparkSession, sf: str) -> DataFrame:
    def load(spec: CopySpec) -> DataFrame:
        if spec.name == "events":
            return read_table(spark, sf, "events").select(F.col("event_id").alias("key"), F.col("ts").alias("created"))
        o = read_table(spark, sf, "orders")
        return o.select(F.col("o_orderkey").alias("key"), F.when(F.month("o_orderdate") == 1, None).otherwise(F.col("o_orderdate")).alias("signed"),
                        F.when(F.year("o_orderdate") == 1995, None).otherwise(F.col("o_orderdate")).alias("created"))

    root = scratch_path(spark, "yearly_jobs")
    yearly_copies(COPIES, load, root)
    parts = [(s, 0, spark.read.parquet(f"{root}/{s.name}/full")) for s in COPIES]
    parts += [(COPIES[0], y, yearly_copy(spark, root, COPIES[0], y)) for y in (1996, 1997, 1998)]
    parts += [(COPIES[1], 2024, yearly_copy(spark, root, COPIES[1], 2024))]
    out = None
    for spec, year, df in parts:
        part = df.select(F.lit(spec.name).alias("name"), F.lit(year).alias("year"), F.col("key").cast("bigint").alias("key"))
        out = part if out is None else out.unionByName(part)
    return out


ship_with_tasks(__name__)
