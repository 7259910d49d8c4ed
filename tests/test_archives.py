"""Archives streamed through Spark's reader, whatever their size and kind."""

import io
import os
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerflow.sources import archives


def body(seed, rows=1500):
    rng = random.Random(seed)
    return "".join(f'{i};"x{rng.random()}\ny é";{"NA" if i % 7 == 0 else "z"}\r\n' for i in range(rows)).encode()


@pytest.fixture()
def folder(tmp):
    os.makedirs(f"{tmp}/in")
    for name, mode in {"a.tar.gz": "w:gz", "b.tgz": "w:gz", "c.tar": "w", "d.tar.bz2": "w:bz2", "e.tar.xz": "w:xz"}.items():
        with tarfile.open(f"{tmp}/in/{name}", mode) as tar:
            for i, member in enumerate(("skip.csv", "want.csv", "more.csv")):
                info = tarfile.TarInfo(member)
                info.size = len(body(i))
                tar.addfile(info, io.BytesIO(body(i)))
    for name, kind in (("f.zip", zipfile.ZIP_DEFLATED), ("g.zip", zipfile.ZIP_STORED)):
        with zipfile.ZipFile(f"{tmp}/in/{name}", "w", kind) as z:
            for i, member in enumerate(("skip.csv", "want.csv", "more.csv")):
                z.writestr(member, body(i))
            z.comment = b"a comment\n"
    return f"{tmp}/in"


@pytest.mark.parametrize("rows, batch_bytes", [(50, 4000), (10_000, 8 << 20)])
def test_every_kind_of_archive_in_small_pieces(spark, folder, rows, batch_bytes):
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")  # what one value may hold
    try:
        with pytest.raises(Exception, match="(?i)exceeds|max length"):
            spark.read.format("binaryFile").load(folder).select("content").collect()
        lines = archives.read_archive_lines(spark, folder, ["want.csv", "more.csv"], batch_bytes=batch_bytes)
        got = {}
        for r in lines.collect():
            got.setdefault((r["archive"], r["member"]), []).append((r["line_no"], r["line"]))
        names = ["a.tar.gz", "b.tgz", "c.tar", "d.tar.bz2", "e.tar.xz", "f.zip", "g.zip"]
        assert sorted(got) == sorted((a, m) for a in names for m in ("want.csv", "more.csv"))
        for (_, member), rows_of in got.items():
            want = body(1 if member == "want.csv" else 2).decode().split("\r\n")[:-1]
            assert sorted(rows_of) == list(enumerate(want))
        cells = archives.parse_member_csv(lines, "want.csv", ["a", "b", "c"])
        assert cells.where("c IS NULL").count() == 7 * len(range(0, 1500, 7))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_a_zip_waits_on_disk_when_it_is_long(folder, monkeypatch):
    monkeypatch.setattr(archives, "HELD_BYTES", 100)
    with open(f"{folder}/f.zip", "rb") as fh:
        raw = fh.read()
    pieces = iter([raw[i:i + 37] for i in range(0, len(raw), 37)])
    found = {m: fh.read() for m, fh in archives.members_of(io.BufferedReader(archives.Stream(pieces)), {"want.csv"})}
    assert found == {"want.csv": body(1)}


def test_one_archive_is_one_task(spark, folder):
    lines = archives.read_archive_lines(spark, folder, ["want.csv"])
    tasks = lines.select("archive", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(tasks) == 7 == len({r["p"] for r in tasks})
