"""Records of quoted CSV files, one large file by many tasks.

A line break ends a record only outside quotes, so a task that starts in the middle of a file can't
tell by itself. Files are read as lines in byte ranges (Spark's text splits):

1. One aggregate counts, for each range, the lines with an odd number of quotes. From these parities
   in file order follows which ranges begin inside a quoted cell. The driver holds one small row for
   each range, as it does of Spark's own splits.
2. A pass over the lines cuts records by the running parity of each range (Arrow batches; only
   records of several lines are put together one by one). A range that begins inside a record leaves
   its first lines out.
3. Only if there are such ranges, their first lines are read and added to the record that the range
   before began. A cell longer than a range runs through several.

Quotes have to be as RFC 4180 has them (doubled inside cells, none in unquoted cells); a file whose
quotes don't pair is an error. Empty lines between records are skipped. A file whose first line ends
in ``\\r\\n`` has such ends throughout, also inside quotes, where they become ``\\n`` (as in Spark's
reader). Ranges are of a fixed size in a session of their own, so all passes see the same ones,
however many executors there are by then. The number of tasks doesn't follow that of small ranges:
a task takes several of them, one after the other."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.joins import fits_broadcast
from ledgerflow.session import checkpoint_root, ship_with_tasks

SPLIT_BYTES = 64 << 20
TASKS = 1000  # of a pass over a path, or two for each core if that is more; beyond, a task takes several ranges


def file_bytes(spark: SparkSession, path: str) -> list[int]:
    """Sizes of the data files of a path (a file, a folder or a pattern)."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    sizes = []
    for status in fs.globStatus(at) or []:
        if status.isFile():
            sizes.append(status.getLen())
            continue
        found = fs.listFiles(status.getPath(), True)
        while found.hasNext():
            f = found.next()
            if not f.getPath().getName().startswith(("_", ".")):
                sizes.append(f.getLen())
    return sizes


def _lines(spark: SparkSession, path: str, split_bytes: int) -> DataFrame:
    """``file, block, value``: the lines in ranges of ``split_bytes``, whatever the cluster's size."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.conf.set("spark.sql.files.maxPartitionNum", str(max(TASKS, 2 * spark.sparkContext.defaultParallelism)))
    lines = own.read.option("lineSep", "\n").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _odd(column: str = "value"):
    return (F.length(column) - F.length(F.replace(F.col(column), F.lit('"'), F.lit("")))) % 2


def open_ranges(lines: DataFrame) -> tuple[list[tuple[int, int, int]], set[int]]:
    """Ranges that begin inside a quoted cell (file, start, and the start of the range in which that
    cell's record begins), and the files whose lines end in ``\\r\\n``."""
    numbered = lines.select("file", "block", "value", F.monotonically_increasing_id().alias("n"))
    counted = numbered.groupBy("file", "block").agg(F.sum(_odd()).alias("odd"), F.min_by(F.col("value").endswith("\r"), "n").alias("cr")).collect()
    out, file, inside, begun, before = [], None, False, 0, 0
    long_ends = {r["file"] for r in counted if r["block"] == 0 and r["cr"]}
    for r in sorted(counted, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            if inside:
                raise ValueError("quotes of a file don't pair")
            file, before = r["file"], 0
        elif inside:
            begun = begun if through else before
            out.append((file, r["block"], begun))
        through = inside and r["odd"] == 0  # the cell runs through the whole range
        before = r["block"]
        inside ^= r["odd"] % 2 == 1
    if inside:
        raise ValueError("quotes of a file don't pair")
    return out, long_ends


def _content(value: pa.Array, long_end: bool) -> pa.Array:
    value = value.cast(pa.string())
    return pc.replace_substring_regex(value, "\\r$", "") if long_end else value


class Cutter:
    """Cuts the lines of ranges, in order, into records."""

    def __init__(self) -> None:
        self.at: tuple[int, int] | None = None
        self.held: list[str] = []     # lines of a record not yet ended
        self.leave = False            # the range began inside a record that is not its own
        self.first = False            # the next record is its file's first

    def begin(self, file: int, block: int, inside: bool) -> None:
        self.at, self.held, self.leave, self.first = (file, block), [], inside, block == 0

    def lines(self, value: pa.Array) -> tuple[pa.Array, list[str]]:
        """Records of one line, and records of several."""
        odd = np.asarray(pc.count_substring(value, '"').fill_null(0)) % 2
        inside = (np.cumsum(odd) + (1 if self.held or self.leave else 0)) % 2
        ends = np.flatnonzero(inside == 0)
        if not len(ends):
            if not self.leave:
                self.held += value.to_pylist()
            return value.slice(0, 0), []
        starts = np.append(0, ends[:-1] + 1)
        alone = starts == ends
        alone[0] &= not (self.held or self.leave)
        several = []
        for k in np.flatnonzero(~alone):
            text = value.slice(starts[k], ends[k] - starts[k] + 1).to_pylist()
            if k == 0 and self.leave:
                continue
            several.append("\n".join(self.held + text if k == 0 else text))
        self.leave, self.held = False, value.slice(int(ends[-1]) + 1).to_pylist()
        return value.take(pa.array(ends[alone])), several


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Stretches of the batch that lie in one range."""
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    edge = np.flatnonzero(np.append(True, (file[1:] != file[:-1]) | (block[1:] != block[:-1]))) if len(file) else []
    yield from zip(edge, np.append(edge[1:], len(file)).astype(int), strict=True) if len(file) else ()


NAMES = ["file", "block", "unfinished", "first", "record"]


def cut_records(batches: Iterator[pa.RecordBatch], long_ends: set[int]) -> Iterator[pa.RecordBatch]:
    """Lines -> records; ``unfinished`` ones go on in the next range."""
    cutter = Cutter()

    def rows(records: list[str] | pa.Array, unfinished: bool = False) -> Iterator[pa.RecordBatch]:
        records = pa.array(records, pa.string()) if isinstance(records, list) else records
        records = records.filter(pc.not_equal(records, ""))
        n = len(records)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([cutter.at[0]] * n, pa.int64()), pa.array([cutter.at[1]] * n, pa.int64()),
                                              pa.array([unfinished] * n), pa.array([cutter.first] + [False] * (n - 1)), records], names=NAMES)
            cutter.first = False

    def last() -> Iterator[pa.RecordBatch]:
        if cutter.held:
            yield from rows(["\n".join(cutter.held)], True)

    for batch in batches:
        for i, j in _ranges(batch):
            at = (batch.column("file")[i].as_py(), batch.column("block")[i].as_py())
            if at != cutter.at:
                yield from last()
                cutter.begin(*at, batch.column("inside")[i].as_py())
            value = _content(batch.column("value").slice(i, j - i), at[0] in long_ends)
            if cutter.first:  # one at a time until the file's first record is out
                k = 0
                while cutter.first and k < len(value):
                    one, more = cutter.lines(value.slice(k, 1))
                    yield from rows(one)
                    yield from rows(more)
                    k += 1
                value = value.slice(k)
            one, more = cutter.lines(value)
            yield from rows(one)
            yield from rows(more)
    yield from last()


def first_lines(batches: Iterator[pa.RecordBatch], long_ends: set[int]) -> Iterator[pa.RecordBatch]:
    """Of ranges that begin inside a cell: the lines up to the record's end (all, if it isn't there)."""
    at, ended, held = None, False, []

    def out() -> Iterator[pa.RecordBatch]:
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*at, "\n".join(held))], names=["file", "block", "begun", "text"])

    for batch in batches:
        for i, j in _ranges(batch):
            own = tuple(batch.column(c)[i].as_py() for c in ("file", "block", "begun"))
            if own != at:
                yield from out()
                at, ended, held = own, False, []
            if not ended:
                value = _content(batch.column("value").slice(i, j - i), own[0] in long_ends)
                odd = np.flatnonzero(np.asarray(pc.count_substring(value, '"').fill_null(0)) % 2)
                ended = len(odd) > 0
                held += value.slice(0, int(odd[0]) + 1 if ended else len(value)).to_pylist()
    yield from out()


def read_records(spark: SparkSession, path: str, header: bool, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``record``: the CSV records (text, line breaks inside quotes kept) of all files of a path,
    each file read in ranges of ``split_bytes``; with ``header``, without each file's first record."""
    lines = _lines(spark, path, split_bytes)
    inside, long_ends = open_ranges(lines)
    ranges = F.broadcast(spark.createDataFrame(inside, "f bigint, b bigint, begun bigint"))  # a part of the driver's list of splits
    same = (ranges["f"] == lines["file"]) & (ranges["b"] == lines["block"])
    # the lines are streamed past the ranges, so they stay in order
    marked = ranges.join(lines, same, "right_outer").select("file", "block", F.col("b").isNotNull().alias("inside"), "value")
    rows = marked.mapInArrow(lambda batches: cut_records(batches, long_ends), "file bigint, block bigint, unfinished boolean, first boolean, record string")
    if inside:
        heads = ranges.join(lines, same).select("file", "block", "begun", "value").mapInArrow(lambda batches: first_lines(batches, long_ends), "file bigint, block bigint, begun bigint, text string")
        parts = F.array_sort(F.collect_list(F.struct("block", "text")))
        rest = heads.groupBy(F.col("file").alias("rest_file"), F.col("begun").alias("rest_block")).agg(F.concat_ws("\n", F.transform(parts, lambda x: x["text"])).alias("rest"))
        checkpoint_root(spark)
        rest = rest.checkpoint()  # so that the lines are read once for the size and the join
        rest = F.broadcast(rest) if fits_broadcast(rest) else rest
        whole = F.when(F.col("rest").isNull(), F.col("record")).otherwise(F.concat_ws("\n", "record", "rest"))
        rows = rows.join(rest, F.col("unfinished") & (F.col("file") == F.col("rest_file")) & (F.col("block") == F.col("rest_block")), "left") \
                   .withColumn("record", whole)
    if header:
        rows = rows.where(~F.col("first"))
    return rows.select("record")


ship_with_tasks(__name__)
