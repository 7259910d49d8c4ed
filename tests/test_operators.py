"""Operator unit tests on tiny literal inputs: the semantics-to-keep notes of each ID."""

import base64

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import scalar as fx
from ledgerflow.operators import checks, joins, nested, ordinal, reshape
from ledgerflow.operators.aggregates import describe, first_last
from ledgerflow.operators.checks import DataCheckError


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- P: reshape -------------------------------------------------------------------------------

def test_rename_ignores_absent_and_align_adds_typed_nulls(spark):
    df = spark.createDataFrame([(1, "a")], "k bigint, n string")
    out = reshape.rename_columns(df, {"k": "key", "absent": "x"})
    out = reshape.align_columns(out, {"key": "bigint", "extra": "int"})
    assert out.columns == ["key", "n", "extra"]
    assert out.schema["extra"].dataType.typeName() == "integer"
    with pytest.raises(Exception):
        reshape.select_columns(out, ["missing"]).collect()


def test_drop_falsy_drops_null_and_empty_records(spark):
    df = spark.createDataFrame([((1, "a"),), (None,), ((None, None),)], "r struct<a:int,b:string>")
    assert rows(reshape.drop_falsy(df, "r").select("r.a")) == [(1,)]


def test_blank_nulls_casts_every_column(spark):
    df = spark.createDataFrame([(None, None, 1.5)], "a int, b string, c double")
    assert rows(reshape.blank_nulls(df)) == [("", "", "1.5")]


# --- F: scalar functions ----------------------------------------------------------------------

def test_full_name_and_email_fallback(spark):
    df = spark.createDataFrame([("", "", "e@x"), ("a", None, "e@x"), ("a", "", "e@x"), ("a", "b", "e@x")],
                               "f string, l string, e string")
    out = df.select(fx.full_name("f", "l").alias("o"), fx.full_name("f", "l", "e").alias("c"))
    assert rows(out) == [(" ", "e@x"), (None, None), ("a ", "a "), ("a b", "a b")]


def test_iso_week_and_year_week_on_new_year(spark):
    df = spark.createDataFrame([("2021-01-01",), ("2024-12-30",)], "d string")
    out = df.select(fx.iso_week("d").alias("w"), fx.year_week("d", fx.iso_week("d")).alias("yw"))
    assert rows(out) == [(53, "2021-53"), (1, "2024-1")]


def test_year_bucket_open_ends_and_null(spark):
    df = spark.createDataFrame([(1990,), (1997,), (2030,), (None,)], "y int")
    assert [r[0] for r in df.select(fx.year_bucket("y", 1996, 1999)).collect()] == [1996, 1997, 1999, None]


def test_parse_utc_and_format(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.678Z",), ("2024-01-02T05:04:05+02:00",), (None,)], "s string")
    out = df.select(fx.format_ts(fx.parse_utc("s")).alias("t"))
    assert [r[0] for r in out.collect()] == ["2024-01-02 03:04:05", "2024-01-02 03:04:05", None]


def test_na_tokens_exact_match_only(spark):
    vals = fx.NA_TOKENS + ["NA ", "none", "ok"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = [r[0] for r in df.select(fx.na_to_null("s")).collect()]
    assert out == [None] * 19 + ["NA ", "none", "ok"]


def test_log_level_rules(spark):
    lines = ["x @level@[WARNING] y", "x @LEVEL@[Error]", "no tag", "@level@[]", "@level@[verbose] z",
             "a @level@[debug] b @level@[error]"]
    df = spark.createDataFrame([(v,) for v in lines], "v string")
    out = rows(df.select(fx.log_tag("v"), fx.log_level("v")))
    assert out == [("warning", "warning"), ("error", "error"), (None, "info"), ("", "info"),
                   ("verbose", "info"), ("debug", "debug")]


def test_rstrip_and_bytes_to_text(spark):
    df = spark.createDataFrame([(bytearray("é \t ".encode()),)], "b binary")
    assert df.select(fx.rstrip_ws(fx.as_text("b", "binary"))).first()[0] == "é"


def test_base64_is_one_line_and_decodes(spark):
    text = "Numéro," * 200
    got = spark.createDataFrame([(text,)], "t string").select(fx.base64_text("t")).first()[0]
    assert "\n" not in got and base64.b64decode(got).decode("utf-8") == text


def test_csv_field_quotes_like_pandas(spark):
    df = spark.createDataFrame([('a,b', 'say "hi"', None, "x\ny", "plain")], "a string, b string, c string, d string, e string")
    assert df.select(fx.csv_line("a", "b", "c", "d", "e")).first()[0] == '"a,b","say ""hi""",,"x\ny",plain'


# --- Q: checks --------------------------------------------------------------------------------

def test_unique_check_ignores_null_keys_and_raises_on_duplicates(spark):
    ok = spark.createDataFrame([(1,), (None,), (None,)], "k int")
    checks.assert_unique(ok, "k")
    with pytest.raises(DataCheckError):
        checks.assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_required_columns(spark):
    with pytest.raises(DataCheckError):
        checks.assert_required(spark.createDataFrame([(1, None)], "a int, b int"), ["a", "b"])


def test_check_summary_one_row(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (2, 3)], "k int, v int")
    r = checks.check_summary(df, "k", ["v"], "t").first()
    assert (r.n_rows, r.n_dup_keys, r.n_null_v) == (3, 1, 1)


def test_observe_count(spark, tmp):
    df, obs = checks.observe_count(spark.range(7), "n")
    df.write.mode("overwrite").parquet(tmp + "/o")
    assert obs.get["rows"] == 7


# --- J: joins ---------------------------------------------------------------------------------

def _target(spark):
    return spark.createDataFrame([(1, "a", "naf1", 10.0), (2, "b", "naf2", 20.0), (None, "n", "naf0", 0.0)],
                                 "k int, name string, naf string, v double")


def _source(spark):
    return spark.createDataFrame([(2, "B", "NAF2", None), (3, "c", "naf3", 30.0), (None, "m", "nafm", 1.0)],
                                 "k int, name string, naf string, v double")


@pytest.mark.parametrize("small", [None, 100])
def test_upsert_semantics(spark, small):
    out = joins.upsert(_target(spark), _source(spark), "k", ["name", "v"], small_source_bytes=small)
    got = sorted(rows(out), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    # 2: name and v (even null) from the source, naf kept; 3 inserted; null keys never conflict
    assert got == [(1, "a", "naf1", 10.0), (2, "B", "naf2", None), (3, "c", "naf3", 30.0),
                   (None, "m", "nafm", 1.0), (None, "n", "naf0", 0.0)]


@pytest.mark.parametrize("small", [None, 100])
def test_upsert_idempotent_and_rejects_duplicate_source_keys(spark, small):
    once = joins.upsert(_target(spark), _source(spark).where("k is not null"), "k", ["name", "v"], small_source_bytes=small)
    twice = joins.upsert(once, _source(spark).where("k is not null"), "k", ["name", "v"], small_source_bytes=small)
    assert sorted(rows(once), key=str) == sorted(rows(twice), key=str)
    dup = _source(spark).unionByName(_source(spark).where("k = 3"))
    with pytest.raises(DataCheckError):
        joins.upsert(_target(spark), dup, "k", ["name"])


def test_replace_children_keeps_untouched_parents(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "p int, c string")
    new = spark.createDataFrame([(1, "z")], "p int, c string")
    assert rows(joins.replace_children(target, new, "p"), "p", "c") == [(1, "z"), (2, "c"), (3, "d")]


def test_flag_join_repeats_rows_for_repeated_keys(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(joins.flag_left_join(left, right, "k", "f"), "k") == [(1, "oui"), (1, "oui"), (2, None)]


def test_lookup_many_to_one_is_enforced(spark):
    left = spark.createDataFrame([(1,), (2,)], "owner int")
    dim = spark.createDataFrame([(1, "x"), (1, "y")], "id int, name string")
    with pytest.raises(DataCheckError):
        joins.lookup_left(left, dim, "owner", "id")
    dim = spark.createDataFrame([(1, "x")], "id int, name string")
    assert rows(joins.lookup_left(left, dim, "owner", "id"), "owner") == [(1, "x"), (2, None)]


def test_lookup_array_defaults_to_empty(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    tags = spark.createDataFrame([(1, ["a", "b"])], "k int, tags array<string>")
    assert rows(joins.lookup_array(left, tags, "k", "tags"), "k") == [(1, ["a", "b"]), (2, [])]


def test_lookup_dimension_only_wanted_ids(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, n string")
    keys = spark.createDataFrame([(1,), (1,), (3,), (None,)], "owner int")
    assert rows(joins.lookup_dimension(users, keys, "owner"), "id") == [(1, "a"), (3, "c")]


# --- N: nested --------------------------------------------------------------------------------

def test_flatten_one_level_clash_first_element_and_empty_list(spark):
    df = spark.createDataFrame(
        [(1, "top", ("inner", "x"), [("p1",), ("p2",)]), (2, "t2", ("i2", "y"), [])],
        "k int, name string, s struct<name:string,other:string>, l array<struct<period:string>>")
    out = nested.flatten_one_level(df)
    assert out.columns == ["k", "name", "other", "period"]
    assert rows(out, "k") == [(1, "inner", "x", "p1"), (2, "i2", "y", None)]


def test_explode_children_drops_childless_and_child_key_overrides(spark):
    df = spark.createDataFrame([(1, [(10, 5)]), (2, []), (3, None)], "code int, kids array<struct<num:int,q:int>>")
    assert rows(nested.explode_children(df, "code", "kids", {"num": "rubrique"})) == [(1, 10, 5)]
    df2 = spark.createDataFrame([(1, [(9, 5)])], "code int, kids array<struct<code:int,q:int>>")
    assert rows(nested.explode_children(df2, "code", "kids")) == [(9, 5)]


def test_a_hot_group_is_chunked_in_order_and_put_together(spark):
    df = spark.range(0, 2500).select(F.lit(1).alias("g"), F.when(F.col("id") < 3, None).otherwise(F.col("id")).alias("v"), F.col("id")) \
        .unionByName(spark.range(0, 3).select(F.lit(2).alias("g"), F.col("id").alias("v"), F.col("id")))
    chunks = nested.ordered_chunks(df, ["g"], ["v", "id"], ["id"], chunk_items=1000)
    got = {(r.g, r.chunk): [x.id for x in r["items"]] for r in chunks.collect()}
    assert sorted(got) == [(1, 0), (1, 1), (1, 2), (2, 0)]
    # null order values come last
    assert got[1, 0] + got[1, 1] + got[1, 2] == [*range(3, 2500), 0, 1, 2] and got[2, 0] == [0, 1, 2]
    docs = nested.one_document(chunks, ["g"], nested.csv_lines("items", ["id"]), F.size("items"), head="ID\n")
    want = "ID\n" + "".join(f"{i}\n" for i in [*range(3, 2500), 0, 1, 2])
    assert {r.g: (r.n_items, r.document) for r in docs.collect()} == {1: (2500, want), 2: (3, "ID\n0\n1\n2\n")}


def test_csv_base64_document(spark):
    df = spark.createDataFrame([([("7", "t,1")],)], "l array<struct<a:string,b:string>>")
    got = df.select(nested.csv_base64(F.concat(F.lit("A,B\n"), nested.csv_lines("l", ["a", "b"])))).first()[0]
    assert base64.b64decode(got).decode() == 'A,B\n7,"t,1"\n'


def test_list_size_null_is_error(spark):
    df = spark.createDataFrame([(None,)], "l array<int>")
    with pytest.raises(Exception):
        df.select(nested.list_size("l")).collect()


# --- W: ordinal -------------------------------------------------------------------------------

def test_row_index_contiguous_across_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("d"), F.col("id"))
    out = ordinal.row_index(df, ["d", "id"], start=100, num_partitions=6)
    got = sorted((r.d, r.id, r.row_idx) for r in out.collect())
    assert [x[2] for x in got] == list(range(100, 5100))


def test_grouped_row_index_restarts_per_group(spark):
    df = spark.range(0, 3000).select((F.col("id") < 2000).cast("int").alias("g"), F.col("id"))
    out = ordinal.grouped_row_index(df, ["g"], ["id"], start=1, num_partitions=5)
    for g, n in ((0, 1000), (1, 2000)):
        got = sorted((r.id, r.row_idx) for r in out.where(F.col("g") == g).collect())
        assert [x[1] for x in got] == list(range(1, n + 1))


def test_numbering_needs_no_checkpoint_and_handles_nulls_and_types(spark, tmp):
    df = spark.range(0, 4000).select(F.when(F.col("id") % 11 == 0, None).otherwise(F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id % 50)")).alias("t"),
                                     F.concat(F.lit("k"), F.col("id") % 9).alias("s"), (F.col("id") / 7).alias("x"), F.col("id"))
    out = ordinal.row_index(df, ["t", "s", "x", "id"], start=5, num_partitions=7)
    assert "Scan ExistingRDD" not in out._jdf.queryExecution().executedPlan().toString()
    want = [r.id for r in df.orderBy("t", "s", "x", "id").collect()]
    assert [r.id for r in out.orderBy("row_idx").collect()] == want
    assert [r.row_idx for r in out.orderBy("row_idx").collect()] == list(range(5, 4005))
    hot = df.withColumn("g", F.when(F.col("id") % 3 > 0, None).otherwise(F.col("id") % 4))
    for g, n in hot.groupBy("g").count().collect():
        got = ordinal.grouped_row_index(hot, ["g"], ["t", "id"], num_partitions=6).where(F.col("g").eqNullSafe(F.lit(g))).orderBy("row_idx").collect()
        assert [r.row_idx for r in got] == list(range(1, n + 1))
        assert [r.id for r in got] == [r.id for r in hot.where(F.col("g").eqNullSafe(F.lit(g))).orderBy("t", "id").collect()]


def test_no_rows_are_numbered(spark):
    none = spark.range(0).withColumn("g", F.lit(1))
    assert ordinal.row_index(none, ["id"]).count() == 0 and ordinal.grouped_row_index(none, ["g"], ["id"]).count() == 0


def test_load_point_by_position_and_initial_values(spark):
    report = spark.createDataFrame([(2, 10, "2024-01-01"), (3, 11, ""), (4, 12, "2024-01-09"), (5, 13, "2024-01-03")],
                                   "row_idx long, number long, day string")
    assert tuple(ordinal.load_point(report, "row_idx", "day", "number", "2024-01-05").first()) == (6, 14)
    none = ordinal.load_point(report, "row_idx", "day", "number", "2000-01-01", first_position=2, first_number=1)
    assert tuple(none.first()) == (2, 1)


# --- A: aggregates ----------------------------------------------------------------------------

def test_describe_matches_pandas(spark):
    import pandas as pd
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.stat: r.value for r in describe(df, ["x"]).collect()}
    want = pd.Series(vals).describe()
    for k in ("count", "mean", "std", "min", "25%", "50%", "75%", "max"):
        assert got[k] == pytest.approx(float(want[k]), abs=1e-6)


def test_first_last_by_order(spark):
    df = spark.createDataFrame([(5, 2), (7, 1), (9, 3)], "v int, o int")
    assert tuple(first_last(df, "v", ["o"]).first()) == (5, 9, 7, 9)


def test_run_timestamp_and_delays_ignore_session_zone(spark):
    from datetime import datetime
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        df = spark.createDataFrame([("2024-03-30 12:00:00", "2024-04-01 12:00:00")], "a string, b string") \
            .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
        r = df.select(fx.run_timestamp(datetime(2024, 6, 3, 2, 0)).cast("string").alias("t"),
                      fx.delay_hours("b", "a").alias("h")).first()
        assert r.t == "2024-06-03 02:00:00" and r.h == 48.0   # DST change in between: still 48 h
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/New_York"])
def test_parse_utc_ignores_the_session_zone_and_its_clock_changes(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [("2024-03-31T02:30:00Z",), ("2024-10-27T01:30:00.25Z",), ("2024-03-31 02:30:00",), ("2024-03-31T04:30:00+02:00",), ("2024-03-10T02:30:00Z",), (None,)]
        df = spark.createDataFrame(rows, "s string").select(fx.parse_utc("s").cast("string").alias("t"))
        assert [r.t for r in df.collect()] == ["2024-03-31 02:30:00", "2024-10-27 01:30:00.25", "2024-03-31 02:30:00", "2024-03-31 02:30:00", "2024-03-10 02:30:00", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
