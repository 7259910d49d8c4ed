"""Sources, sinks and the incremental forms on tiny literal inputs."""

import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.joins import upsert
from ledgerflow.sinks import writers
from ledgerflow.sources import archives, files
from ledgerflow.streaming import incremental


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_snapshot_csv_quoting_nulls_and_positional_binding(spark, tmp):
    _write(f"{tmp}/in/a.csv",
           'whatever,other,third\n'
           '000123,"say ""hi""","line\nbreak"\n'
           '000124,,""\n')
    df = files.read_snapshot_csv(spark, f"{tmp}/in", "code string, name string, note string")
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("000123", 'say "hi"', "line\nbreak"), ("000124", None, "")]


def test_snapshot_csv_malformed_row_fails(spark, tmp):
    _write(f"{tmp}/bad/a.csv", "d\n2024-01-01\nnot-a-date\n")
    with pytest.raises(Exception):
        files.read_snapshot_csv(spark, f"{tmp}/bad", "d date").collect()


def test_headless_semicolon_all_strings_with_na(spark, tmp):
    _write(f"{tmp}/h/a.csv", "0012;n/a;x\n0013;NA ;\n")
    df = files.read_headless_csv(spark, f"{tmp}/h", ["a", "b", "c"])
    assert sorted(tuple(r) for r in df.collect()) == [("0012", None, "x"), ("0013", "NA ", None)]


def test_archive_members_filtered(spark, tmp):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        for name, text in (("want.csv", "1;a\n2;b\n"), ("skip.csv", "x\n")):
            data = text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    os.makedirs(f"{tmp}/arc")
    with open(f"{tmp}/arc/one.tar.gz", "wb") as fh:
        fh.write(buf.getvalue())
    lines = archives.read_archive_lines(spark, f"{tmp}/arc", ["want.csv"])
    parsed = archives.parse_member_csv(lines, "want.csv", ["k", "v"])
    assert sorted((r.k, r.v) for r in parsed.collect()) == [("1", "a"), ("2", "b")]
    assert {r.member for r in lines.collect()} == {"want.csv"}


def test_json_column_keeps_leading_zeros(spark):
    df = spark.createDataFrame([('{"siret": "00012", "n": 1}',)], "j string")
    assert df.select(files.parse_json_column("j", "siret string, n int").alias("r")).first().r.siret == "00012"


def test_append_checked_schema_and_empty_guard(spark, tmp):
    path = f"{tmp}/t"
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert writers.append_checked(df, path)
    assert not writers.append_checked(df.where("false"), path)
    with pytest.raises(writers.SchemaMismatch):
        writers.append_checked(df.withColumn("x", F.lit(1)), path)
    assert spark.read.parquet(path).count() == 1


def test_publish_switches_version_and_truncate_load_checks_schema(spark, tmp):
    path = f"{tmp}/tbl"
    a = spark.createDataFrame([(1,)], "k int")
    writers.publish(a, path, "v=1")
    writers.publish(a.union(a), path, "v=2")
    assert writers.current_version(spark, path) == "v=2"
    assert writers.read_published(spark, path).count() == 2
    with pytest.raises(writers.SchemaMismatch):
        writers.truncate_load(a, path, "v=3", spark.createDataFrame([], "k string").schema)
    writers.truncate_load(a, path, "v=3", spark.createDataFrame([], "k string").schema, force_recreate=True)
    assert writers.read_published(spark, path).schema.simpleString() == "struct<k:string>"


def test_interval_partition_rerun_overwrites_only_its_partition(spark, tmp):
    path, schema = f"{tmp}/iv", "k int, interval string"

    def run(rows, label):
        writers.write_interval(spark.createDataFrame(rows, schema), path, label)

    def got():
        return sorted((r.k, r.interval) for r in spark.read.schema(schema).parquet(path).collect())

    run([(1, "20240101-20240102")], "20240101-20240102")
    run([(2, "20240102-20240103")], "20240102-20240103")
    run([(3, "20240102-20240103")], "20240102-20240103")
    assert got() == [(1, "20240101-20240102"), (3, "20240102-20240103")]
    run([], "20240102-20240103")  # a re-run without rows clears its partition
    assert got() == [(1, "20240101-20240102")]
    with pytest.raises(Exception, match="outside interval"):
        run([(4, "20240101-20240102")], "20240102-20240103")


def test_published_csv_keeps_values(spark, tmp):
    rows = [(1, "  lead trail  "), (2, ""), (3, None), (4, 'say "hi", twice'), (5, "line\nbreak")]
    writers.publish_csv(spark.createDataFrame(rows, "k int, v string"), f"{tmp}/csv", single_file=True)
    text = "".join(open(f"{tmp}/csv/{f}", newline="").read() for f in os.listdir(f"{tmp}/csv") if f.endswith(".csv"))
    assert sorted(text.split("\n")) == sorted('k,v\n1,  lead trail  \n2,\n3,\n4,"say ""hi"", twice"\n5,"line\nbreak"\n'.split("\n"))


def test_re_export_leaves_no_stale_buckets(spark, tmp):
    df = spark.createDataFrame([(1, 1996), (2, 1997), (3, None)], "k int, b int")
    writers.export_by_bucket(df, f"{tmp}/x", "b")
    writers.export_by_bucket(df.withColumn("b", F.lit(1999)), f"{tmp}/x", "b")
    assert sorted((r.k, r.b) for r in spark.read.parquet(f"{tmp}/x").collect()) == [(1, 1999), (2, 1999), (3, 1999)]


def test_pointer_is_never_rewritten_and_old_versions_go(spark, tmp):
    path, df = f"{tmp}/t", spark.range(1)
    before = set()
    for i in range(5):
        writers.publish(df, path, f"v={i}")
        files_now = {f for f in os.listdir(f"{path}/pointers") if f.startswith("part-")}
        assert before <= files_now
        before = files_now
    assert writers.drop_old_versions(spark, path, keep=2) == ["v=2", "v=1", "v=0"]
    assert sorted(d for d in os.listdir(path) if d.startswith("v=")) == ["v=3", "v=4"]
    assert writers.current_version(spark, path) == "v=4"
    with open(f"{tmp}/plain", "w") as fh:
        fh.write("no table")
    with pytest.raises(Exception):  # something is there, but no Parquet: not taken for "no table"
        writers.append_checked(df, f"{tmp}/plain")


def test_truncate_load_checks_the_incoming_frame(spark, tmp):
    schema = spark.createDataFrame([], "k int, v string").schema
    with pytest.raises(writers.SchemaMismatch):
        writers.truncate_load(spark.createDataFrame([("x", "y")], "k string, v string"), f"{tmp}/t", "v=1", schema)
    with pytest.raises(writers.SchemaMismatch):
        writers.truncate_load(spark.createDataFrame([(1,)], "k int"), f"{tmp}/t", "v=1", schema)


def test_quoted_cells_of_headless_files_headed_files_and_members(spark, tmp):
    body = '1;"say ""hi""; x";z\n2;"line\nbreak";NA\n3;"";n/a\n'
    want = [("1", 'say "hi"; x', "z"), ("2", "line\nbreak", None), ("3", None, None)]
    _write(f"{tmp}/h/a.csv", body)
    assert sorted(map(tuple, files.read_headless_csv(spark, f"{tmp}/h", ["a", "b", "c"]).collect())) == want
    _write(f"{tmp}/s/a.csv", 'a,b,c\n1,"say ""hi""; x",z\n2,"line\nbreak",NA\n3,"",n/a\n')
    assert sorted(map(tuple, files.read_string_csv(spark, f"{tmp}/s", ["a", "b", "c"]).collect())) == want
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        info = tarfile.TarInfo("m.csv")
        info.size = len(body.encode())
        tar.addfile(info, io.BytesIO(body.encode()))
    os.makedirs(f"{tmp}/arc")
    with open(f"{tmp}/arc/one.tar.gz", "wb") as fh:
        fh.write(buf.getvalue())
    parsed = archives.parse_member_csv(archives.read_archive_lines(spark, f"{tmp}/arc"), "m.csv", ["a", "b", "c"])
    assert sorted((r.a, r.b, r.c) for r in parsed.collect()) == want


def test_stream_upsert_equals_batch_for_any_split(spark, tmp):
    cols = "k int, name string, v double, landed int"
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, v double")
    drops = [[(2, "B", None, 1), (3, "c", 3.0, 1)], [(3, "C", 30.0, 2), (4, "d", 4.0, 2)], [(1, "A", 10.0, 3)]]
    table, landing, ckpt = f"{tmp}/table", f"{tmp}/landing", f"{tmp}/ckpt"
    writers.publish(target, table, "v=initial")
    for d in drops:
        spark.createDataFrame(d, cols).write.mode("append").parquet(landing)
        incremental.run_upsert_stream(spark, landing, cols, table, "k", ["name", "v"], "landed", ckpt)
    streamed = sorted(tuple(r) for r in writers.read_published(spark, table).collect())
    batch = target
    for d in drops:
        batch = upsert(batch, spark.createDataFrame(d, cols).drop("landed"), "k", ["name", "v"])
    assert streamed == sorted(tuple(r) for r in batch.collect())
    # all drops landed before one single run give the same table (later landing wins)
    table2, ckpt2 = f"{tmp}/table2", f"{tmp}/ckpt2"
    writers.publish(target, table2, "v=initial")
    incremental.run_upsert_stream(spark, landing, cols, table2, "k", ["name", "v"], "landed", ckpt2)
    assert sorted(tuple(r) for r in writers.read_published(spark, table2).collect()) == streamed


def test_stream_keeps_the_first_value_of_columns_outside_the_update_list(spark, tmp):
    cols = "k int, name string, born int, landed int"
    target = spark.createDataFrame([(1, "a", 10)], "k int, name string, born int")
    drops = [[(2, "b", 20, 1), (1, "A", 11, 1)], [(2, "B", 21, 2), (3, "c", 30, 2)], [(3, "C", 31, 3), (None, "x", 0, 3)]]
    batch = target
    for i, d in enumerate(drops):
        df = spark.createDataFrame(d, cols)
        df.write.mode("append").parquet(f"{tmp}/landing")
        batch = upsert(batch, df.drop("landed"), "k", ["name"])
    want = sorted((tuple(r) for r in batch.collect()), key=str)
    for name, files_at_once in (("one", None), ("many", 1)):
        writers.publish(target, f"{tmp}/{name}", "v=initial")
        incremental.run_upsert_stream(spark, f"{tmp}/landing", cols, f"{tmp}/{name}", "k", ["name"], "landed", f"{tmp}/ck-{name}",
                                      max_files_per_trigger=None)
        assert sorted((tuple(r) for r in writers.read_published(spark, f"{tmp}/{name}").collect()), key=str) == want


def test_a_second_checkpoint_is_no_replay(spark, tmp):
    cols = "k int, name string, landed int"
    writers.publish(spark.createDataFrame([(1, "a")], "k int, name string"), f"{tmp}/t", "v=initial")
    for i in (1, 2):  # both streams start at batch 0
        spark.createDataFrame([(i + 1, f"new{i}", i)], cols).write.parquet(f"{tmp}/land{i}")
        incremental.run_upsert_stream(spark, f"{tmp}/land{i}", cols, f"{tmp}/t", "k", ["name"], "landed", f"{tmp}/ck{i}")
    assert sorted(tuple(r) for r in writers.read_published(spark, f"{tmp}/t").collect()) == [(1, "a"), (2, "new1"), (3, "new2")]


def test_log_stream_equals_batch(spark, tmp):
    lines = ["a @level@[ERROR] x  ", "   ", "plain", "b @LEVEL@[Debug]"]
    _write(f"{tmp}/land/part-0.txt", "\n".join(lines) + "\n")
    incremental.run_log_stream(spark, f"{tmp}/land", f"{tmp}/sink", f"{tmp}/ck")
    streamed = sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/sink").collect())
    batch = sorted(tuple(r) for r in incremental.tag_log_lines(spark.read.text(f"{tmp}/land")).collect())
    assert streamed == batch == sorted([("a @level@[ERROR] x", "error", "error"), ("plain", None, "info"),
                                        ("b @LEVEL@[Debug]", "debug", "debug")])


def _pages(spark, path, pages):
    import json
    _write(f"{path}/p.json", "".join(json.dumps(p) + "\n" for p in pages))
    return path


def test_numbered_pages_must_be_whole(spark, tmp):
    from ledgerflow.plans.register_delta import read_complete_pages

    def page(k, rows, held=None):
        return {"page": k, "total_pages": 2, "nombre": rows, "total": 4, "data": [{"id": 10 * k + i} for i in range(rows if held is None else held)]}

    assert read_complete_pages(spark, _pages(spark, f"{tmp}/ok", [page(0, 2), page(1, 2)]), "id:bigint").count() == 4
    for name, bad in {"twice": [page(0, 2), page(0, 2)], "short": [page(0, 2), page(1, 2, held=1)], "missing": [page(0, 2)],
                      "again": [page(0, 2), page(1, 2), page(1, 2)]}.items():
        with pytest.raises(ValueError, match="incomplete"):
            read_complete_pages(spark, _pages(spark, f"{tmp}/{name}", bad), "id:bigint")


def test_cursor_pages_must_be_one_chain(spark, tmp):
    from ledgerflow.plans.register_delta import read_cursor_pages

    def page(own, nxt, rows, total=5):
        return {"header": {"total": total, "nombre": rows, "curseur": own, "curseurSuivant": nxt}, "etablissements": [{"siret": i} for i in range(rows)]}

    assert read_cursor_pages(spark, _pages(spark, f"{tmp}/ok", [page("a", "b", 2), page("b", "c", 2), page("c", "c", 1)])).count() == 5
    assert read_cursor_pages(spark, _pages(spark, f"{tmp}/one", [page("a", "a", 5)])).count() == 5
    for name, bad in {"twice for another": [page("a", "b", 2), page("a", "b", 2), page("c", "c", 1)], "gap": [page("a", "b", 4), page("c", "c", 1)],
                      "short": [page("a", "b", 2), page("b", "b", 2)], "no end": [page("a", "b", 2), page("b", "a", 3)]}.items():
        with pytest.raises(ValueError, match="incomplete"):
            read_cursor_pages(spark, _pages(spark, f"{tmp}/{name}", bad))


def test_array_pages_end_with_one_that_is_not_full(spark, tmp):
    _write(f"{tmp}/ok/p.txt", '[{"a":1},{"a":2}]\n[{"a":3}]\n')
    _write(f"{tmp}/empty/p.txt", '[{"a":1},{"a":2}]\n[]\n')
    _write(f"{tmp}/cut/p.txt", '[{"a":1},{"a":2}]\n[{"a":3},{"a":4}]\n')
    files.check_short_page(spark, f"{tmp}/ok", 2)
    files.check_short_page(spark, f"{tmp}/empty", 2)
    with pytest.raises(ValueError, match="incomplete"):
        files.check_short_page(spark, f"{tmp}/cut", 2)
