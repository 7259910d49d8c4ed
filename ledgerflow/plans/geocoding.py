"""Company geocoding: companies with a missing position and a known address (P6/F1), then a
caller-supplied batch enrichment (J7)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalar import first_non_null
from ledgerflow.operators.enrich import batch_enrich
from ledgerflow.operators.filters import missing_position_with_address
from ledgerflow.plans.catalog import register
from ledgerflow.sources.tables import read_table
from ledgerflow.session import ship_with_tasks

# Stand-in columns: latitude/longitude are missing for one segment / one nation, the
# warehouse address is the segment, the register address is the name (missing for one name).
_NO_ADDRESS_NAME = "Customer#000000007"


def companies_to_geocode(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    c = c.select(
        F.col("c_custkey").alias("siret"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("latitude_td"),
        F.nullif(F.col("c_nationkey"), F.lit(3)).alias("longitude_td"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("adresse_td"),
        F.nullif(F.col("c_name"), F.lit(_NO_ADDRESS_NAME)).alias("adresse_insee"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("code_commune_insee"),
    )
    adresse = first_non_null("adresse_td", "adresse_insee")
    return c.where(missing_position_with_address("latitude_td", "longitude_td", adresse)) \
            .select("siret", adresse.alias("adresse"), "code_commune_insee")


@register("null_or_filter", f"""
SELECT c_custkey AS siret,
       coalesce(nullif(c_mktsegment, 'BUILDING'), nullif(c_name, '{_NO_ADDRESS_NAME}')) AS adresse,
       lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS code_commune_insee
FROM customer
WHERE (nullif(c_mktsegment, 'BUILDING') IS NULL OR nullif(c_nationkey, 3) IS NULL)
  AND coalesce(nullif(c_mktsegment, 'BUILDING'), nullif(c_name, '{_NO_ADDRESS_NAME}')) IS NOT NULL
""")
def null_or_filter_q(spark: SparkSession, sf: str) -> DataFrame:
    return companies_to_geocode(spark, sf)


ENRICH_SCHEMA = ("c_custkey bigint, c_name string, c_nationkey int, result_label string, "
                 "result_citycode string, result_score double")


def normalise_address(pdf: pd.DataFrame) -> pd.DataFrame:
    """Example batch function (the caller's service): input columns plus result columns."""
    out = pdf[["c_custkey", "c_name", "c_nationkey"]].copy()
    out["result_label"] = pdf["c_name"].str.upper().str.replace("#", " ", regex=False) + " " + pdf["n_name"]
    out["result_citycode"] = pdf["c_nationkey"].astype(str).str.zfill(5)
    out["result_score"] = (pdf["c_acctbal"] >= 0).astype(float)
    return out


@register("batch_enrich", """
SELECT c.c_custkey, c.c_name, c.c_nationkey,
       upper(replace(c.c_name, '#', ' ')) || ' ' || n.n_name AS result_label,
       lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS result_citycode,
       CASE WHEN c.c_acctbal >= 0 THEN 1.0 ELSE 0.0 END AS result_score
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def batch_enrich_q(spark: SparkSession, sf: str) -> DataFrame:
    # The commune constraint of the service is the nation key; its reference name travels with
    # the row (a join Catalyst broadcasts by the nation file's size), then the batch function runs.
    rows = read_table(spark, sf, "customer").join(
        read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    return batch_enrich(rows.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "n_name"),
                        normalise_address, ENRICH_SCHEMA)


ship_with_tasks(__name__)
