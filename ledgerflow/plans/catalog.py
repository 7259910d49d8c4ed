"""Registry of the acceptance queries: name -> (spark, sf_dir) -> DataFrame, plus the equivalent
SQL an independent engine runs on the same tables (the correctness oracle)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

PLAN_MODULES = ("open_data", "geocoding", "yearly_copies", "risk_sites", "register_delta", "notices",
                "tickets", "snapshots", "stats", "jobs")


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(f"ledgerflow.plans.{m}")


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE_SQL)
