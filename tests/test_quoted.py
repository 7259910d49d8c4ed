"""One quoted CSV file read by many tasks, against Spark's reader that takes the file whole."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.sources import files, quoted


def make_file(path, seed, rows, header=True, end="\n", long_cell=0):
    rng = random.Random(seed)
    cells = ["plain", "", '""', '"two\nlines"', '"say ""hi"", x"', '"a\r\nb"', '"\n\n"', "Été 中", '"; , "', '"ends with quote """', '"""\n"""']
    out = ["h1,h2,h3"] if header else []
    if header == "broken":
        out = ['h1,"h\n2",h3']
    for i in range(rows):
        out.append(f"{i},{rng.choice(cells)},{rng.choice(cells)}")
        if rng.random() < 0.1:
            out.append("")  # an empty line between records
    if long_cell:
        out.insert(len(out) // 2, 'long,"' + "many\nlines, " * long_cell + '",x')
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(end.join(out) + (end if seed % 2 else ""))


SCHEMA = "k string, a string, b string"


def same(spark, path, split):
    want = files.read_snapshot_csv(spark, path, SCHEMA, split_bytes=None)
    got = files.read_snapshot_csv(spark, path, SCHEMA, split_bytes=split)
    key = [F.coalesce(c, F.lit("<null>")) for c in ("k", "a", "b")]
    assert sorted(tuple(r) for r in got.select(*key).collect()) == sorted(tuple(r) for r in want.select(*key).collect())
    return got


@pytest.mark.parametrize("seed, split, header, end", [(1, 50, True, "\n"), (2, 97, True, "\r\n"), (3, 300, "broken", "\n"), (4, 31, True, "\n")])
def test_split_reader_equals_the_whole_file_reader(spark, tmp, seed, split, header, end):
    make_file(f"{tmp}/in/a.csv", seed, 120, header, end)
    make_file(f"{tmp}/in/b.csv", seed + 1, 40, header, end)
    got = same(spark, f"{tmp}/in", split)
    assert quoted._lines(spark, f"{tmp}/in", split).select(F.spark_partition_id()).distinct().count() > 5
    assert got.count() == 160


def test_a_cell_longer_than_several_ranges(spark, tmp):
    make_file(f"{tmp}/in/a.csv", 7, 30, long_cell=60)
    inside, _ = quoted.open_ranges(quoted._lines(spark, f"{tmp}/in", 100))
    assert len({b for _, _, b in inside}) < len(inside)  # several ranges of one record
    same(spark, f"{tmp}/in", 100)


def test_few_tasks_take_many_ranges(spark, tmp, monkeypatch):
    make_file(f"{tmp}/in/a.csv", 3, 400, long_cell=20)
    make_file(f"{tmp}/in/b.csv", 4, 100)
    monkeypatch.setattr(quoted, "TASKS", 3, raising=False)
    lines = quoted._lines(spark, f"{tmp}/in", 40)
    tasks, ranges = lines.select(F.spark_partition_id()).distinct().count(), lines.select("file", "block").distinct().count()
    assert 1 < tasks <= max(3, 2 * spark.sparkContext.defaultParallelism) < ranges / 10
    got = same(spark, f"{tmp}/in", 40)
    assert got.count() == 501
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1  # not again for the ends of cut records


def test_files_up_to_the_size_are_left_to_the_plain_reader(spark, tmp, monkeypatch):
    make_file(f"{tmp}/in/a.csv", 1, 20)
    size = max(quoted.file_bytes(spark, f"{tmp}/in"))
    monkeypatch.setattr(files, "read_records", None)
    assert files.read_snapshot_csv(spark, f"{tmp}/in", SCHEMA, split_bytes=size).count() == 20
    with pytest.raises(TypeError):
        files.read_snapshot_csv(spark, f"{tmp}/in", SCHEMA, split_bytes=size - 1)


def test_types_headless_and_na_tokens(spark, tmp):
    os.makedirs(f"{tmp}/h")
    with open(f"{tmp}/h/a.csv", "w", encoding="utf-8") as fh:
        fh.write("".join(f'{i};"x\ny {i}";{"NA" if i % 3 else "z"}\n' for i in range(50)))
    split, whole = (sorted((tuple(r) for r in files.read_headless_csv(spark, f"{tmp}/h", ["a", "b", "c"], split_bytes=s).collect()), key=str) for s in (40, None))
    assert split == whole and len(split) == 50
    os.makedirs(f"{tmp}/t")
    with open(f"{tmp}/t/a.csv", "w", encoding="utf-8") as fh:
        fh.write("d,n,ok\n" + "".join(f'2024-01-{i % 28 + 1:02d},{i},{"true" if i % 2 else "false"}\n' for i in range(40)))
    schema = "d date, n int, ok boolean"
    split, whole = (sorted(tuple(r) for r in files.read_snapshot_csv(spark, f"{tmp}/t", schema, split_bytes=s).collect()) for s in (64, None))
    assert split == whole
    with open(f"{tmp}/t/b.csv", "w", encoding="utf-8") as fh:
        fh.write("d,n,ok\n2024-13-01,x,true\n" * 3)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.read_snapshot_csv(spark, f"{tmp}/t", schema, split_bytes=64).collect()


def test_quotes_that_do_not_pair(spark, tmp):
    os.makedirs(f"{tmp}/q")
    with open(f"{tmp}/q/a.csv", "w", encoding="utf-8") as fh:
        fh.write('a,b,c\n1,"open,x\n' + "2,3,4\n" * 30)
    with pytest.raises(ValueError, match="pair"):
        files.read_snapshot_csv(spark, f"{tmp}/q", SCHEMA, split_bytes=50)
