"""Keyed tables in buckets (K1, J5, J6, I2): a batch rewrites the buckets that its keys touch.

A store holds several tables. Each is split by the hash of its key into a fixed number of buckets;
the rows of a bucket are Parquet files in folders of their own. One commit record names, for every
table, the folders of every bucket. A transaction reads the buckets its rows belong to, writes their
new contents to a folder of its own and puts one record that names the new folder for those buckets
and the old folders for all others: the bytes it writes follow the buckets it touches, and a reader
sees all tables as of one commit, never a new parent with old children.

Two writers of different buckets both succeed (the later one names the other's folders); of two that
change one bucket, the second finds a conflict and is run again from the new state. Rows without a
key never conflict: they are added beside the buckets. Choose the number of buckets so that one is
some hundred MB; a record is a line of text for each bucket.

A table can be split by ranges of a position instead (K7, I3: a report whose rows are numbered): a
reload of some positions then rewrites only the ranges that it meets, and the first and last of these
keep their other rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators.checks import assert_unique
from ledgerflow.operators.joins import BROADCAST_BYTES, overlay_rows, replace_children, upsert
from ledgerflow.sinks.commits import CommitConflict, CommitLog, Folder

BUCKET = "_bucket"
NO_KEY = -1      # where rows without a key are
LOOSE_FOLDERS = 16  # folders of rows without a key that a commit leaves before they are put together


def bucket_of(key: str, buckets: int) -> Column:
    return F.when(F.col(key).isNull(), F.lit(NO_KEY)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets))).cast("bigint")


def range_of(position: str, rows: int) -> Column:
    return F.when(F.col(position).isNull(), F.lit(NO_KEY)).otherwise(F.floor(F.col(position) / rows)).cast("bigint")


def _part(table: dict) -> Column:
    return range_of(table["key"], table["rows"]) if "rows" in table else bucket_of(table["key"], table["buckets"])


class KeyedStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.log = CommitLog(spark, f"{root}/commits")

    def snapshot(self) -> dict:
        """What all tables consist of now; give it to ``read`` to read several as of one commit."""
        return self.log.latest()[1]

    def tables(self, snapshot: dict | None = None) -> list[str]:
        return sorted((self.snapshot() if snapshot is None else snapshot).get("tables", {}))

    def read(self, name: str, snapshot: dict | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or some of its buckets."""
        table = (self.snapshot() if snapshot is None else snapshot)["tables"][name]
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        wanted = None if buckets is None else {str(b) for b in buckets}
        paths = [f"{self.root}/{name}/{folder}/{BUCKET}={b}" for b, folders in table["folders"].items()
                 if wanted is None or b in wanted for folder in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def run(self, work: Callable[[Transaction], None], attempts: int = 5) -> int:
        """Does ``work`` in a transaction and commits it; on a conflict all of it is done again from
        the state that holds then. Returns the commit's number (the old one if nothing changed)."""
        for left in reversed(range(attempts)):
            txn = Transaction(self)
            try:
                work(txn)
                return txn.commit()
            except CommitConflict:
                txn.discard()
                if not left:
                    raise
            except BaseException:
                txn.discard()
                raise
        raise AssertionError("attempts must be positive")

    def vacuum(self, keep: int = 3) -> list[int]:
        """Forgets all commits but the last ``keep`` and deletes the buckets only they name. Folders
        that no record names are left: they may be of a transaction under way."""
        numbers = self.log.numbers()
        old, kept = numbers[:-max(2, keep)], numbers[-max(2, keep):]

        def named(which):
            records = [r for n in which if (r := self.log.record(n)) is not None]
            return {(t, f, b) for r in records for t, table in r["tables"].items() for b, folders in table["folders"].items() for f in folders}

        for name, folder, b in sorted(named(old) - named(kept)):
            Folder(self.spark, f"{self.root}/{name}/{folder}").delete(f"{BUCKET}={b}")
        return self.log.compact(keep)


class Transaction:
    """Changes of a store's tables that become visible together."""

    def __init__(self, store: KeyedStore):
        self.store, self.spark, self.id = store, store.spark, uuid.uuid4().hex
        self.number, self.base = store.log.latest()
        self.made: dict[str, dict] = {}                          # tables this transaction makes
        self.changes: dict[str, dict[str, list[str]]] = {}       # table -> bucket -> its folders now
        self.added: dict[str, list[str]] = {}                    # table -> folders with rows without a key
        self.positions: dict[str, int] = {}                      # stream -> its last batch
        self.folders: list[tuple[str, str]] = []

    # -- what it does ----------------------------------------------------------------------

    def create(self, name: str, df: DataFrame, key: str, buckets: int) -> None:
        """A new table, or a new one in place of an old one; keys may repeat (children)."""
        self._create(name, df, {"key": key, "buckets": buckets})

    def create_positions(self, name: str, df: DataFrame, position: str, rows: int) -> None:
        """A new table by ranges of so many positions (0 and up)."""
        self._create(name, df, {"key": position, "rows": rows})

    def _create(self, name: str, df: DataFrame, how: dict) -> None:
        if BUCKET in df.columns:
            raise ValueError(f"a column may not be named {BUCKET}")
        self.made[name] = how | {"schema": df.schema.json(), "folders": {}}
        written, folder = self._write(name, df, how)
        self.changes[name] = {b: [folder] for b in written}
        self.added[name] = []

    def upsert(self, name: str, source: DataFrame, update_columns: Sequence[str], check_source: bool = True,
               small_source_bytes: int | None = BROADCAST_BYTES) -> None:
        """J6 on the buckets that the source's keys touch."""
        def merge(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
            if check_source:
                assert_unique(rows, key, "source key")
            return upsert(target, rows, key, update_columns, check_source=False, small_source_bytes=small_source_bytes)

        self._rewrite(name, source, merge)

    def replace_children(self, name: str, children: DataFrame) -> None:
        """J5 on the buckets that the children's parents touch."""
        self._rewrite(name, children, replace_children)

    def replace_positions(self, name: str, rows: DataFrame) -> None:
        """K7 on the ranges that a reload meets: its rows, numbered without gaps, replace exactly those
        of the same positions."""
        self._rewrite(name, rows, overlay_rows)

    def seen(self, stream: str, batch: int) -> bool:
        """Whether a stream's batch has been committed before."""
        return self.base.get("streams", {}).get(stream, -1) >= batch

    def at_batch(self, stream: str, batch: int) -> None:
        """Notes, in the same commit, that the stream's batch is in it."""
        self.positions[stream] = batch

    # -- how -------------------------------------------------------------------------------

    def _table(self, name: str) -> dict:
        """A table as this transaction sees it."""
        table = self.made.get(name) or self.base["tables"][name]
        folders = dict(table["folders"]) | self.changes.get(name, {})
        loose = folders.get(str(NO_KEY), []) + self.added.get(name, [])
        return table | {"folders": {b: f for b, f in (folders | {str(NO_KEY): loose}).items() if f}}

    def _rewrite(self, name: str, source: DataFrame, merge: Callable[[DataFrame, DataFrame, str], DataFrame]) -> None:
        table = self._table(name)
        key = table["key"]
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        rows = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # at most one small number for each bucket
            touched = sorted(r[0] for r in rows.where(F.col(key).isNotNull()).select(_part(table)).distinct().collect())
            target = self.store.read(name, {"tables": {name: table}}, touched)
            written, folder = self._write(name, merge(target, rows, key), table)
        finally:
            rows.unpersist()
        change = self.changes.setdefault(name, {})
        for b in touched:
            change[str(b)] = [folder] if str(b) in written else []
        if str(NO_KEY) in written:
            self.added.setdefault(name, []).append(folder)

    def _write(self, name: str, df: DataFrame, table: dict) -> tuple[set[str], str]:
        """Writes rows by bucket to a new folder; the buckets that have some, and the folder."""
        folder = f"{self.id}-{len(self.folders)}"
        path = f"{self.store.root}/{name}/{folder}"
        self.folders.append((name, folder))
        # few files for small buckets, several for a large one, e.g. that of a hot parent
        df.withColumn(BUCKET, _part(table)).hint("rebalance", BUCKET) \
          .write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy(BUCKET).parquet(path)
        return {x.split("=", 1)[1] for x in Folder(self.spark, path).names() if x.startswith(f"{BUCKET}=")}, folder

    def _on(self, state: dict) -> dict:
        """The record with this transaction's changes on top of ``state``; a conflict if a bucket it
        changed, a table it made or a stream it read isn't there as it found it."""
        tables = {n: t | {"folders": dict(t["folders"])} for n, t in state.get("tables", {}).items()}
        before = self.base.get("tables", {})
        for name, table in self.made.items():
            if tables.get(name) != before.get(name):
                raise CommitConflict(f"table {name} was changed")
            tables[name] = table | {"folders": {}}
        for name in self.changes.keys() | self.added.keys():
            now, then = tables.get(name), before.get(name, {})
            if now is None:
                raise CommitConflict(f"table {name} is gone")
            for b, folders in self.changes.get(name, {}).items():
                if name not in self.made and now["folders"].get(b) != then.get("folders", {}).get(b):
                    raise CommitConflict(f"bucket {b} of {name} was changed")
                now["folders"][b] = folders
            loose = now["folders"].get(str(NO_KEY), []) + self.added.get(name, [])
            now["folders"] = {b: f for b, f in (now["folders"] | {str(NO_KEY): loose}).items() if f}
        streams = dict(state.get("streams", {}))
        for stream, batch in self.positions.items():
            if streams.get(stream) != self.base.get("streams", {}).get(stream):
                raise CommitConflict(f"stream {stream} went on elsewhere")
            streams[stream] = batch
        return {"tables": tables, "streams": streams}

    def _gather_loose(self) -> None:
        """Puts the rows without a key of a table into one folder when they are in too many."""
        for name in list(self.added):
            table = self._table(name)
            loose = table["folders"].get(str(NO_KEY), [])
            if len(loose) > LOOSE_FOLDERS:
                rows = self.store.read(name, {"tables": {name: table}}, [NO_KEY])
                _, folder = self._write(name, rows, table)
                self.changes.setdefault(name, {})[str(NO_KEY)] = [folder]
                self.added[name] = []

    def commit(self) -> int:
        if not (self.made or self.changes or self.added or self.positions):
            return self.number
        self._gather_loose()
        number, state = self.number, self.base
        while not self.store.log.put(self._on(state), number, state):
            number, state = self.store.log.latest()
        return number + 1

    def discard(self) -> None:
        """Deletes what the transaction wrote; nothing names it."""
        for name, folder in self.folders:
            Folder(self.spark, f"{self.store.root}/{name}").delete(folder)
