"""Exact quartiles by radix selection, against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import aggregates


def check(spark, columns, probs=(0.25, 0.5, 0.75)):
    rows = list(zip(*columns.values(), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    got = aggregates.exact_quantiles(df, list(columns), probs)
    for c, values in columns.items():
        known = [v for v in values if v is not None]
        for p in probs:
            want = float(np.quantile(known, p)) if known else None
            assert got[c][p] == want or math.isclose(got[c][p], want, rel_tol=1e-12), (c, p)


def test_quantiles_of_all_kinds_of_numbers(spark):
    rng = random.Random(3)
    n = 400
    check(spark, {
        "wide": [rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(n)],
        "near": [1.0 + rng.randrange(5) * 2 ** -52 for _ in range(n)],   # told apart by the last bits only
        "hot": [7.0 if i % 3 else rng.gauss(0, 1) for i in range(n)],
        "zeros": [0.0 if i % 2 else -0.0 for i in range(n)],
        "some": [None if i % 2 else float(i) for i in range(n)],
        "none": [None] * n,
        "ints": [float(rng.randrange(-50, 50)) for _ in range(n)]})
    check(spark, {"one": [4.5]})
    check(spark, {"two": [1.0, -2.0]}, (0.0, 0.1, 1.0))


@pytest.mark.parametrize("rows", [2_000, 20_000])
def test_what_is_shuffled_does_not_follow_the_distinct_values(spark, rows):
    """At most the bins of the wanted prefixes: the same for ten times as many different values."""
    seen = []
    plain = aggregates.F.broadcast
    df = spark.range(rows).select((F.col("id") * 0.37 + 1000.0).alias("v"))
    try:
        aggregates.F.broadcast = lambda look: seen.append(look.count()) or plain(look)
        got = aggregates.exact_quantiles(df, ["v"], (0.25, 0.5, 0.75))
    finally:
        aggregates.F.broadcast = plain
    assert all(n <= 6 for n in seen) and len(seen) <= 3
    assert math.isclose(got["v"][0.5], (rows - 1) / 2 * 0.37 + 1000.0)
