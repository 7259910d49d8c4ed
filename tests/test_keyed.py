"""Keyed tables in buckets, the commit log and conditional publication."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.checks import DataCheckError
from ledgerflow.operators.joins import overlay_rows, replace_children, upsert
from ledgerflow.sinks import keyed, writers
from ledgerflow.sinks.commits import CommitConflict, CommitLog, Folder
from ledgerflow.sinks.keyed import BUCKET, KeyedStore, bucket_of
from ledgerflow.streaming import incremental


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def data_files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.fixture()
def store(spark, tmp):
    s = KeyedStore(spark, f"{tmp}/store")
    sites = spark.range(200).select("id", F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 7).alias("code"))
    kids = spark.range(600).select((F.col("id") % 200).alias("id"), F.col("id").alias("kid"))

    def work(txn):
        txn.create("sites", sites, "id", 16)
        txn.create("kids", kids, "id", 16)

    s.run(work)
    return s


def test_upsert_writes_the_touched_buckets_only(spark, store):
    before, old = data_files(store.root), store.read("sites").cache()
    source = spark.createDataFrame([(3, "x", 50), (4, None, 51), (1000, "new", 52)], "id bigint, name string, code bigint")
    touched = {r[0] for r in source.select(bucket_of("id", 16)).collect()}
    want = rows(upsert(old, source, "id", ["name"]))
    store.run(lambda txn: txn.upsert("sites", source, ["name"]))
    assert rows(store.read("sites")) == want
    new = data_files(store.root) - before
    assert before <= data_files(store.root)
    assert {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in new} == touched
    named = store.snapshot()["tables"]["sites"]["folders"]
    assert len({f for b, fs in named.items() if int(b) not in touched for f in fs}) == 1  # the folder of the first load


def test_children_of_touched_parents(spark, store):
    old = store.read("kids").cache()
    new = spark.createDataFrame([(5, 9000), (5, 9001), (777, 9002), (None, 9003)], "id bigint, kid bigint")
    want = rows(replace_children(old, new, "id"))
    store.run(lambda txn: txn.replace_children("kids", new))
    assert rows(store.read("kids")) == want
    assert rows(store.read("sites")) and store.tables() == ["kids", "sites"]


def test_rows_without_a_key_stay_and_their_folders_stay_few(spark, store, monkeypatch):
    monkeypatch.setattr(keyed, "LOOSE_FOLDERS", 3)
    source = spark.createDataFrame([(None, "loose", 1)], "id bigint, name string, code bigint")
    for _ in range(6):
        store.run(lambda txn: txn.upsert("sites", source, ["name"]))
    assert store.read("sites").where("id IS NULL").count() == 6
    assert len(store.snapshot()["tables"]["sites"]["folders"]["-1"]) <= 4


def test_two_tables_change_together_or_not_at_all(spark, store):
    sites = spark.createDataFrame([(3, "x", 0)], "id bigint, name string, code bigint")
    kids = spark.createDataFrame([(3, 9000)], "id bigint, kid bigint")
    before = (rows(store.read("sites")), rows(store.read("kids")))
    files = data_files(store.root)

    def crash(txn):
        txn.upsert("sites", sites, ["name"])
        assert len(data_files(store.root)) > len(files)  # written, but no record names it
        assert (rows(store.read("sites")), rows(store.read("kids"))) == before
        raise RuntimeError("lost between the two writes")

    with pytest.raises(RuntimeError, match="lost"):
        store.run(crash)
    assert (rows(store.read("sites")), rows(store.read("kids"))) == before and data_files(store.root) == files

    old = store.snapshot()

    def both(txn):
        txn.upsert("sites", sites, ["name"])
        txn.replace_children("kids", kids)

    store.run(both)
    assert (rows(store.read("sites", old)), rows(store.read("kids", old))) == before  # a reader of the old commit
    assert store.read("kids").where("id = 3").count() == 1 and store.read("sites").where("name = 'x'").count() == 1


def test_writers_of_other_buckets_both_win_and_of_one_bucket_run_again(spark, store):
    def change(i, name):
        return spark.createDataFrame([(i, name, 0)], "id bigint, name string, code bigint")

    b = {r["id"]: r["b"] for r in spark.range(200).select("id", bucket_of("id", 16).alias("b")).collect()}
    other = next(i for i in b if b[i] != b[0])
    runs = []

    def overtaken(rival):
        def work(txn):
            runs.append(rival)
            txn.upsert("sites", change(0, f"mine{rival}"), ["name"])
            if runs.count(rival) == 1:  # another writer commits in between, once
                store.run(lambda t: t.upsert("sites", change(rival, f"rival{rival}"), ["name"]))
        return work

    store.run(overtaken(other))
    assert runs == [other]
    same = next(i for i in b if b[i] == b[0] and i)
    store.run(overtaken(same))
    assert runs == [other, same, same]
    got = {r["id"]: r["name"] for r in store.read("sites").collect()}
    assert (got[0], got[other], got[same]) == (f"mine{same}", f"rival{other}", f"rival{same}")
    with pytest.raises(CommitConflict):
        store.run(overtaken(next(i for i in b if b[i] == b[0] and i not in (0, same))), attempts=1)


def test_a_key_twice_is_an_error_and_leaves_nothing(spark, store):
    files = data_files(store.root)
    twice = spark.createDataFrame([(3, "x", 0), (3, "y", 0)], "id bigint, name string, code bigint")
    with pytest.raises(DataCheckError):
        store.run(lambda txn: txn.upsert("sites", twice, ["name"]))
    assert data_files(store.root) == files


def test_vacuum_deletes_what_no_kept_commit_names(spark, store):
    for i in range(6):
        store.run(lambda txn, i=i: txn.upsert("sites", spark.createDataFrame([(3, f"x{i}", 0)], "id bigint, name string, code bigint"), ["name"]))
    want, n = rows(store.read("sites")), len(data_files(store.root))
    store.vacuum(2)
    assert rows(store.read("sites")) == want and len(data_files(store.root)) < n
    assert len(store.log.numbers()) == 2


def test_one_number_goes_to_one_writer(spark, tmp):
    log = CommitLog(spark, f"{tmp}/log")
    won = []

    def write(i):
        if log.put({"by": i}, 0, {}):
            won.append(i)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and log.latest()[1]["by"] == won[0] and log.folder.names() == [CommitLog.name(1)]


def test_rename_refuses_a_name_that_is_taken(spark, tmp):
    folder = Folder(spark, f"{tmp}/f")
    folder.write("a", "1")
    folder.write("b", "2")
    assert not folder._rename(folder.at("a"), folder.at("b")) and folder.read("b") == "2"
    assert folder._rename(folder.at("a"), folder.at("c")) and folder.read("c") == "1"


def test_a_writer_later_than_compaction_finds_out(spark, tmp):
    log = CommitLog(spark, f"{tmp}/log", keep=2)
    assert log.put({"n": 1}, 0, {})
    late_number, late = log.latest()
    for _ in range(5):
        number, now = log.latest()
        assert log.put({"n": number + 1}, number, now)
    log.compact()
    assert not log.put({"n": "late"}, late_number, late)
    assert log.latest()[1]["n"] == 6 and len(log.numbers()) == 2


def test_publish_on_condition(spark, tmp):
    path = f"{tmp}/t"
    writers.publish(spark.range(1), path, "v=a", expected=None)
    writers.publish(spark.range(2), path, "v=b", expected="v=a")
    with pytest.raises(CommitConflict):
        writers.publish(spark.range(3), path, "v=c", expected="v=a")
    assert writers.read_published(spark, path).count() == 2
    writers.publish(spark.range(3), path, "v=c")
    assert writers.current_version(spark, path) == "v=c"
    for i in range(30):
        writers.publish(spark.range(1), path, f"v={i}")
    assert len(os.listdir(f"{path}/pointers")) <= 2 * 20


def test_keyed_stream_equals_batches_and_replays_once(spark, tmp):
    cols = "k int, name string, born int, landed int"
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 11)], "k int, name string, born int")
    drops = [[(2, "B", 20, 1), (5, "e", 12, 1)], [(5, "E", 21, 2), (3, "c", 30, 2)], [(3, "C", 31, 3), (None, "x", 0, 3)]]
    store = KeyedStore(spark, f"{tmp}/s")
    store.run(lambda txn: txn.create("t", target, "k", 4))
    batch = target
    for d in drops:
        df = spark.createDataFrame(d, cols)
        df.write.mode("append").parquet(f"{tmp}/landing")
        batch = upsert(batch, df.drop("landed"), "k", ["name"])
        incremental.run_keyed_stream(spark, f"{tmp}/landing", cols, store, "t", ["name"], "landed", f"{tmp}/ck")
    assert rows(store.read("t")) == rows(batch)
    last = max(store.snapshot()["streams"].values())
    body = incremental.upsert_buckets(store, "t", ["name"], "landed", f"{tmp}/ck")
    number = store.log.latest()[0]
    body(spark.createDataFrame(drops[2], cols), last)  # a replay of the last batch
    assert store.log.latest()[0] == number and rows(store.read("t")) == rows(batch)


def test_a_reload_rewrites_the_ranges_it_meets(spark, tmp):
    store = KeyedStore(spark, f"{tmp}/r")
    report = spark.range(2, 1002).select(F.col("id").alias("row"), F.concat(F.lit("t"), "id").alias("text"))
    store.run(lambda txn: txn.create_positions("report", report, "row", 100))
    before = data_files(store.root)
    old = store.snapshot()["tables"]["report"]["folders"]
    reload = spark.range(250, 421).select(F.col("id").alias("row"), F.lit("new").alias("text"))
    store.run(lambda txn: txn.replace_positions("report", reload))
    now = store.snapshot()["tables"]["report"]["folders"]
    assert {b for b in now if now[b] != old[b]} == {"2", "3", "4"} and before <= data_files(store.root)
    assert rows(store.read("report")) == rows(overlay_rows(report, reload, "row"))
    # past the end, then nothing
    store.run(lambda txn: txn.replace_positions("report", spark.range(1000, 1250).select(F.col("id").alias("row"), F.lit("end").alias("text"))))
    assert store.read("report").count() == 1248
    want = rows(store.read("report"))
    store.run(lambda txn: txn.replace_positions("report", reload.where("false")))
    assert rows(store.read("report")) == want
    with pytest.raises(ValueError, match="positions"):
        store.run(lambda txn: txn.replace_positions("report", reload.where("row <> 300")))
    assert rows(store.read("report", buckets=[0])) == rows(report.where("row < 100"))
