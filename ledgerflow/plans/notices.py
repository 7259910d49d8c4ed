"""Outlier notices: one payload per company (K8/N5/N4/A6), its records as a sorted CSV in base64
(T2/N6/F16), and a JSON frame parsed with a forced text column (S11/F17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalar import left_chars
from ledgerflow.operators.nested import as_objects, csv_base64, csv_row, ordered_document
from ledgerflow.plans.catalog import register
from ledgerflow.sinks.writers import outbox
from ledgerflow.sources.files import parse_json_column
from ledgerflow.sources.tables import read_table

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's output: the attachment's CSV header, in order.
ATTACHMENT_HEADER = ["Numéro du bordereau", "Type de bordereau", "Quantité en tonne", "Date de réception"]
ATTACHMENT_NAME = "bordereaux.csv"
# ---------------------------------------------------------------------------------------------
TEMPLATE_ID = 1                                                       # message template (a job parameter)
REPLY_TO = {"email": "reply@example.org", "name": "Service"}          # a job parameter


def notice_payload(to: Column, company_name: Column, siret: Column, n_items: Column, attachment: Column,
                   template_id: int = TEMPLATE_ID, reply_to: dict[str, str] = REPLY_TO) -> Column:
    """One message: recipients, template, reply address, parameters and the attached file."""
    return F.struct(
        to.alias("to"),
        F.lit(template_id).alias("templateId"),
        F.struct(F.lit(reply_to["email"]).alias("email"), F.lit(reply_to["name"]).alias("name")).alias("replyTo"),
        F.struct(company_name.alias("nom_societe"), siret.alias("siret"), n_items.alias("num_bordereaux")).alias("params"),
        F.array(F.struct(attachment.alias("content"), F.lit(ATTACHMENT_NAME).alias("name"))).alias("attachment"),
    )


def attachments(items: DataFrame, group: str, order: list[str], fields: list[str]) -> DataFrame:
    """``group, n_items, attachment``: a company's records, sorted, as one CSV with one
    header, in base64."""
    docs = ordered_document(items, [group], order, csv_row(fields), head=",".join(ATTACHMENT_HEADER) + "\n")
    return docs.select(group, "n_items", csv_base64("document").alias("attachment"))


def outlier_notices(companies: DataFrame, items: DataFrame, order: list[str], fields: list[str]) -> DataFrame:
    """The job: ``siret, company_name, user_emails`` companies and their records -> an outbox of one
    complete payload per company that has records, with the true number of them."""
    files = attachments(items, "siret", order, fields)
    joined = companies.join(files, "siret")
    payload = notice_payload(as_objects("user_emails", "email"), F.col("company_name"), F.col("siret").cast("string"),
                             F.col("n_items"), F.col("attachment"))
    return outbox(joined, "siret", payload)


def _records(orders: DataFrame) -> DataFrame:
    """Stand-in records: a fifth of all orders are one company's (over 1000 from sf0.01 on), some
    reception dates are missing."""
    siret = F.when(F.col("o_orderkey") % 5 == 0, F.lit(0)).otherwise(F.col("o_custkey"))
    day = F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_orderdate"))
    return orders.select(siret.cast("bigint").alias("siret"), day.alias("day"), F.col("o_orderkey").alias("readable_id"),
                         F.col("o_orderpriority").alias("bordereau_type"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("quantity"),
                         F.date_format(day, "yyyy-MM-dd").alias("received_at"))


RECORD_FIELDS = ["readable_id", "bordereau_type", "quantity", "received_at"]
_FILES_SQL = """
r AS (
  SELECT CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_custkey END AS siret, o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS day,
         o_orderpriority, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS q
  FROM orders),
files AS (
  SELECT siret, count(*) AS n_items,
         base64(encode('Numéro du bordereau,Type de bordereau,Quantité en tonne,Date de réception' || chr(10) ||
                string_agg(CAST(o_orderkey AS VARCHAR) || ',' || o_orderpriority || ',' || q || ',' || coalesce(strftime(day, '%Y-%m-%d'), '') || chr(10),
                           '' ORDER BY day NULLS LAST, o_orderkey))) AS attachment
  FROM r GROUP BY siret)"""


@register("nested_csv_base64", f"WITH {_FILES_SQL} SELECT siret, n_items, attachment FROM files")
def nested_csv_base64_q(spark: SparkSession, sf: str) -> DataFrame:
    return attachments(_records(read_table(spark, sf, "orders")), "siret", ["day", "readable_id"], RECORD_FIELDS)


@register("array_payload", f"""
WITH {_FILES_SQL},
c AS (SELECT c_custkey AS siret, c_name, [lower(c_mktsegment) || '@example.org', 'user' || CAST(c_custkey % 7 AS VARCHAR) || '@example.org'] AS emails FROM customer
      UNION ALL SELECT 0, 'All "others"', ['all@example.org'])
SELECT c.siret,
       CAST(to_json({{'to': list_transform(emails, lambda e: {{'email': e}}), 'templateId': 1,
                     'replyTo': {{'email': 'reply@example.org', 'name': 'Service'}},
                     'params': {{'nom_societe': c_name, 'siret': CAST(c.siret AS VARCHAR), 'num_bordereaux': n_items}},
                     'attachment': [{{'content': attachment, 'name': 'bordereaux.csv'}}]}}) AS VARCHAR) AS payload
FROM c JOIN files ON files.siret = c.siret
""")
def array_payload_q(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    emails = F.array(F.concat(F.lower("c_mktsegment"), F.lit("@example.org")),
                     F.concat(F.lit("user"), (F.col("c_custkey") % 7).cast("string"), F.lit("@example.org")))
    companies = c.select(F.col("c_custkey").cast("bigint").alias("siret"), F.col("c_name").alias("company_name"), emails.alias("user_emails"))
    rest = c.select(F.lit(0).cast("bigint").alias("siret"), F.lit('All "others"').alias("company_name"),
                    F.array(F.lit("all@example.org")).alias("user_emails")).limit(1)
    return outlier_notices(companies.unionByName(rest), _records(read_table(spark, sf, "orders")), ["day", "readable_id"], RECORD_FIELDS)


@register("json_typed", """
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS siret,
       substr(lpad(CAST(c_custkey AS VARCHAR), 14, '0'), 1, 10) AS siret_head,
       c_name AS company_name, c_acctbal AS balance
FROM customer
""")
def json_typed_q(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    text = F.to_json(F.struct(F.col("c_custkey"), F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("siret"),
                              F.col("c_name").alias("company_name"), F.col("c_acctbal").alias("balance")))
    frame = c.select(text.alias("json"))
    parsed = frame.select(parse_json_column("json", "c_custkey bigint, siret string, company_name string, balance double").alias("r"))
    return parsed.select("r.c_custkey", "r.siret", left_chars("r.siret", 10).alias("siret_head"),
                         "r.company_name", "r.balance")
