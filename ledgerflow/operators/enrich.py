"""Batch enrichment through a caller-supplied function over Arrow batches.

The reference posts one CSV of every pending row to an address service; here each Spark task
sends its own bounded batches (``batch_rows``) through ``fn`` (pandas in, pandas out: the input
columns plus the result columns), so the work spreads over the cluster and no batch holds the
whole table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerflow.session import ship_with_tasks


def batch_enrich(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], result_schema: T.StructType | str,
                 batch_rows: int = 5_000) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), batch_rows):
                yield fn(pdf.iloc[i:i + batch_rows].reset_index(drop=True))
    return df.mapInPandas(run, result_schema)


ship_with_tasks(__name__)
