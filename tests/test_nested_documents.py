"""Documents of ordered lines, and the union of keys of JSON records."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.nested import csv_row, ordered_document, union_of_keys


def test_documents_of_a_hot_group_with_ties_and_nulls(spark):
    rng = random.Random(2)
    rows = [(None if i % 50 == 0 else ("hot" if i % 3 else f"g{i % 7}"), None if i % 11 == 0 else rng.randrange(40), f"x,{rng.randrange(5)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o int, t string").repartition(6)
    got = {r["g"]: (r["n_items"], r["document"]) for r in ordered_document(df, ["g"], ["o"], csv_row(["o", "t"]), head="h\n", tail="end").collect()}
    want = {}
    for g in {r[0] for r in rows}:
        lines = sorted((o is None, o or 0, f'{"" if o is None else o},"{t}"\n') for k, o, t in rows if k == g)
        want[g] = (len(lines), "h\n" + "".join(x[2] for x in lines) + "end")
    assert got == want
    assert ordered_document(df.where("false"), ["g"], ["o"], csv_row(["o"])).count() == 0


def test_equal_rows_are_spread(spark):
    df = spark.range(4000).select(F.lit("g").alias("g"), F.lit(1).alias("o"), F.lit("same").alias("t")).repartition(4)
    row = ordered_document(df, ["g"], ["o"], F.col("t"), sep="|").first()
    assert row["n_items"] == 4000 and row["document"] == "|".join(["same"] * 4000)


def test_union_of_keys(spark):
    lines = ['{"a": 1, "b": "x"}', '{"b": null, "c": 1.5, "a": 2}', '{"c": 2, "d": true, "odd key": [1, 2]}', "{}", None, "null",
             '{"d": false, "mixed": 1, "o": {"k": 1}, "big": 12345678901234567890}', '{"mixed": "one", "o": {"l": 2}, "void": null}', '{"mixed": {"x": 1}}']
    out = union_of_keys(spark.createDataFrame([(x,) for x in lines], "value string").repartition(4))
    assert {f.name: f.dataType.simpleString() for f in out.schema} == {"a": "bigint", "b": "string", "big": "double", "c": "double", "d": "boolean",
                                                                     "mixed": "string", "o": "string", "odd key": "string", "void": "string"}
    assert out.columns == sorted(out.columns)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    none = (None,) * 9
    want = [(1, "x", *none[2:]), (2, None, None, 1.5, *none[4:]), (None, None, None, 2.0, True, None, None, "[1,2]", None), none, none, none,
            (None, None, 12345678901234567890.0, None, False, "1", '{"k":1}', None, None), (None, None, None, None, None, "one", '{"l":2}', None, None),
            (None, None, None, None, None, '{"x":1}', None, None, None)]
    assert got == sorted(want, key=str)


def test_union_of_keys_of_odd_tables(spark):
    none = spark.createDataFrame([], "value string")
    assert union_of_keys(none).columns == [] and union_of_keys(none).count() == 0
    quoted = spark.createDataFrame([('{"a \\"q\\"": 1, "b`c": 2, "OBJECT<": 3}',)], "value string")
    assert union_of_keys(quoted).first().asDict() == {'a "q"': 1, "b`c": 2, "OBJECT<": 3}
    for bad in ("[1]", "3", '"x"'):
        with pytest.raises(Exception, match="not an object"):
            union_of_keys(spark.createDataFrame([(bad,)], "value string")).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        union_of_keys(spark.createDataFrame([("{",)], "value string")).collect()
