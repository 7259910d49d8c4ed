"""Chosen members of zip / tar archives, read as a Spark job over many archives of any size.

A task streams one archive: Spark's reader hands its bytes over in small pieces (split at line feeds,
which are put back), so an archive is never one value, and nothing but Spark's file system needs to
reach it. Tar archives (plain or compressed) are unpacked as they come; a zip has its directory at
the end, so it waits in the task's unnamed temporary file first, as Spark's own sorts spill. Members
become records in batches of bounded size; parsing them (``from_csv``) happens back in the JVM."""

from __future__ import annotations

import io
import tarfile
import tempfile
import zipfile
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalar import na_to_null
from ledgerflow.session import ship_with_tasks

MEMBER_LINES_SCHEMA = "archive string, member string, line_no bigint, line string"
HELD_BYTES = 32 << 20  # of a zip held in memory; a larger one waits on the task's disk
BATCH_BYTES = 8 << 20  # of records handed over at a time
ZIP_MAGIC = b"PK"


class Pieces:
    """The archives of a task, one after another, as byte streams."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.batches, self.rows, self.at = batches, None, 0

    def _next(self) -> bool:
        """Moves on to rows that aren't used up; whether there are any."""
        while self.rows is None or self.at >= self.rows.num_rows:
            self.rows, self.at = next(self.batches, None), 0
            if self.rows is None:
                return False
        return True

    def archives(self) -> Iterator[tuple[str, Iterator[bytes]]]:
        while self._next():
            path, name = (self.rows.column(c)[self.at].as_py() for c in ("path", "archive"))
            pieces = self._of(path)
            yield name, pieces
            for _ in pieces:  # what its reader has left
                pass

    def _of(self, path: str) -> Iterator[bytes]:
        first = True
        while self._next() and self.rows.column("path")[self.at].as_py() == path:
            paths = self.rows.column("path").slice(self.at)
            same = next((i for i, p in enumerate(paths.to_pylist()) if p != path), len(paths))
            piece = b"\n".join(self.rows.column("piece").slice(self.at, same).to_pylist())
            self.at += same
            yield piece if first else b"\n" + piece
            first = False


class Stream(io.RawIOBase):
    """A readable file over pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.held:
            piece = next(self.pieces, None)
            if piece is None:
                return 0
            self.held = memoryview(piece)
        n = min(len(buffer), len(self.held))
        buffer[:n] = self.held[:n]
        self.held = self.held[n:]
        return n


class Content(io.RawIOBase):
    """A member of a tar that can't be sought in."""

    def __init__(self, fh):
        self.fh = fh

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.fh.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)


def members_of(stream: io.BufferedReader, wanted: set[str] | None) -> Iterator[tuple[str, io.BufferedIOBase]]:
    """Name and content of the wanted members (P15), each to be read before the next is asked for."""
    if stream.peek(2)[:2] == ZIP_MAGIC:
        with tempfile.SpooledTemporaryFile(max_size=HELD_BYTES) as held:
            while chunk := stream.read(1 << 20):
                held.write(chunk)
            held.seek(0)
            with zipfile.ZipFile(held) as z:
                for info in z.infolist():
                    if not info.is_dir() and (wanted is None or info.filename in wanted):
                        with z.open(info) as fh:
                            yield info.filename, fh
        return
    with tarfile.open(fileobj=stream, mode="r|*") as tar:
        for m in tar:
            if m.isfile() and (wanted is None or m.name in wanted):
                fh = tar.extractfile(m)
                if fh is not None:
                    yield m.name, io.BufferedReader(Content(fh), 1 << 20)


def records_of(lines: Iterable[str]) -> Iterator[str]:
    """CSV records of a member: a line break inside quotes belongs to the record."""
    held, quotes = [], 0
    for line in lines:
        held.append(line)
        quotes += line.count('"')
        if quotes % 2 == 0:
            yield "".join(held).rstrip("\r\n")
            held, quotes = [], 0
    if held:
        yield "".join(held).rstrip("\r\n")


def _expand(wanted: set[str] | None, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for archive, pieces in Pieces(batches).archives():
            for member, fh in members_of(io.BufferedReader(Stream(pieces), 1 << 20), wanted):
                held: list[str] = []
                size = done = 0

                def flush(held=held, archive=archive, member=member):
                    n = len(held)
                    return pa.RecordBatch.from_arrays([pa.array([archive] * n), pa.array([member] * n), pa.array(range(done, done + n), pa.int64()), pa.array(held, pa.string())],
                                                      names=["archive", "member", "line_no", "line"])

                for record in records_of(io.TextIOWrapper(fh, encoding="utf-8", newline="")):
                    held.append(record)
                    size += len(record) + 32
                    if size >= batch_bytes:
                        yield flush()
                        done, size = done + len(held), 0
                        held.clear()
                if held:
                    yield flush()
    return run


def read_archive_lines(spark: SparkSession, path: str, members: Sequence[str] | None = None, glob: str = "*",
                       batch_bytes: int = BATCH_BYTES, name: Column | None = None) -> DataFrame:
    """Records of the wanted members (P15) of every archive under ``path``. ``archive`` is the file's
    name, or ``name``, an expression of ``path``."""
    wanted = set(members) if members is not None else None
    own = spark.newSession()  # files are not split here
    own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 60))  # one file a task
    files = own.read.option("lineSep", "\n").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    pieces = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("piece"))
    pieces = pieces.select("path", (F.regexp_extract("path", "[^/]+$", 0) if name is None else name).alias("archive"), "piece")
    lines = pieces.mapInArrow(_expand(wanted, batch_bytes), MEMBER_LINES_SCHEMA)
    # back in the caller's session, whose settings hold for all that follows
    return spark.createDataFrame([], MEMBER_LINES_SCHEMA).unionAll(lines)


def parse_member_csv(lines: DataFrame, member: str, names: Sequence[str], sep: str = ";", na_tokens: bool = True) -> DataFrame:
    """S5/F13 applied to one member's records: ``from_csv`` with an all-string schema and the same
    quoting, in the JVM. Records holding only whitespace are skipped; the archive/line columns stay."""
    ddl = ", ".join(f"`{n}` string" for n in names)
    options = {"sep": sep, "quote": '"', "escape": '"', "emptyValue": "", "multiLine": "true", "mode": "FAILFAST"}
    parsed = (lines.where((F.col("member") == member) & (F.trim(F.col("line")) != ""))
                   .select("archive", "line_no", F.from_csv(F.col("line"), ddl, options).alias("_r")))
    cells = [(na_to_null(F.col("_r")[n]) if na_tokens else F.col("_r")[n]).alias(n) for n in names]
    return parsed.select("archive", "line_no", *cells)


ship_with_tasks(__name__)
