"""Line dedup (operator 3): line hashes are range-partitioned with a secondary sort by document and
position; each range streams the first occurrence of a line and returns keep bitmaps, not text.

1. Each batch of texts (a map task's part) finds its lines' keys and reduces them: one row for each
   distinct key, with the lowest doc_id that has it and the list of its places in the batch. A line
   that a third of all documents hold is one row for a batch, so no range gets an unbounded key.
2. Rows are dealt to ranges of the hash (fixed equal ranges: hashes are uniform) and sorted by hash,
   document and position. A range reads its rows once: a hash's first row names the document that
   keeps the line, and the hash counts when a second document has it.
3. What goes back is one compressed bitmap for each document, batch and range (1: the line stays),
   joined to the documents. Texts cross the network once, for that join.

Keys are 128 bits of two independent 64-bit hashes. Defined results: the digests ignore other columns, whatever their
names, and filters return all of them; a null or empty text is one
empty line; a null doc_id comes after all others and rows without one count as one document; rows
that repeat a doc_id are one document for the rule, and each such row is returned with its own
lines decided; an empty table gives no rows."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import _text as tx
from ledgerflow.llm._frames import doc_texts, fresh, shuffle_partitions

MIN_CODE_POINTS = 10  # shorter keys never count as repeated
LAST = (1 << 63) - 1  # the place of a null doc_id in the order of documents

LINE_SCHEMA = "h1 bigint, h2 bigint, doc bigint, pos int, many boolean, places binary"
MASK_SCHEMA = "doc bigint, text_hash bigint, mask binary"


def line_keys(data: np.ndarray, offsets: np.ndarray):
    """Lines of the batch: first index of each text, the two hashes of every key, code points."""
    ls, le, first = tx.lines(data, offsets)
    solid = ~tx.white()[data]
    at = np.flatnonzero(solid)
    lo, hi = np.searchsorted(at, ls), np.searchsorted(at, le)
    full = hi > lo
    safe = np.append(at, 0)
    s = np.where(full, safe[lo], ls)
    e = np.where(full, safe[hi - 1] + 1, ls)
    upper = (data >= 65) & (data <= 90)
    low = np.where(upper, data + 32, data).astype(np.uint8)
    h1, h2 = tx.piece_hash(low, s, e), tx.piece_hash(low, s, e, seed=1)
    points = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])
    return first, h1, h2, points[e] - points[s]


def reduce_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1. ``places``: little-endian (text number in the batch, line) pairs behind the batch's
    own list of (doc, text hash, lines), so that step 2 can name the documents."""
    for batch in batches:
        data, offsets = tx.utf8(batch.column("text"))
        ids = np.array([LAST if i is None else i for i in batch.column("doc_id").to_pylist()], np.int64)
        th = batch.column("text_hash").to_numpy()
        first, h1, h2, size = line_keys(data, offsets)
        text, n_lines = tx.text_index(first), np.diff(first)
        use = np.flatnonzero(size >= MIN_CODE_POINTS)
        if not len(use):
            continue
        doc, pos = ids[text[use]], (use - first[text[use]]).astype(np.int64)
        order = np.lexsort((pos, doc, h2[use], h1[use]))
        use, doc, pos = use[order], doc[order], pos[order]
        a, b, t = h1[use], h2[use], text[use]
        new = np.ones(len(use), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(use))
        cells = np.column_stack([doc, th[t], n_lines[t], pos]).astype("<i8")
        yield pa.RecordBatch.from_arrays([
            pa.array(a[start].view(np.int64)), pa.array(b[start].view(np.int64)), pa.array(doc[start]),
            pa.array(pos[start].astype(np.int32)), pa.array(doc[end - 1] != doc[start]),
            pa.array([cells[i:j].tobytes() for i, j in zip(start, end, strict=True)], pa.binary())],
            names=["h1", "h2", "doc", "pos", "many", "places"])


def masks(drops: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One compressed bitmap (1: stays) for each document among the dropped places."""
    if not drops:
        return
    cells = np.concatenate(drops)
    order = np.lexsort((cells[:, 3], cells[:, 2], cells[:, 1], cells[:, 0]))
    cells = cells[order]
    new = np.ones(len(cells), bool)
    new[1:] = (cells[1:, :3] != cells[:-1, :3]).any(1)
    start = np.flatnonzero(new)
    out = []
    for i, j in zip(start, np.append(start[1:], len(cells)), strict=True):
        keep = np.ones(int(cells[i, 2]), bool)
        keep[cells[i:j, 3]] = False
        out.append(zlib.compress(struct.pack("<q", len(keep)) + np.packbits(keep).tobytes(), 1))
    yield pa.RecordBatch.from_arrays([pa.array(cells[start, 0]), pa.array(cells[start, 1]), pa.array(out, pa.binary())],
                                     names=["doc", "text_hash", "mask"])


def keep_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2, on rows sorted by (h1, h2, doc, pos): a hash's first document keeps its lines. Only
    the hash at a batch's edge is carried on: its first document and, until a second document is
    seen, nothing else is pending, since lines of the first document always stay."""
    key, owner, pending, held = None, 0, [], 0
    for batch in batches:
        h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
        doc = batch.column("doc").to_numpy()
        if not len(h1):
            continue
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = key != (h1[0], h2[0])
        owners = np.append(owner, doc[new])[np.cumsum(new)]
        # sorted by document, so a row past the owner's proves a second document
        more = (doc != owners) | batch.column("many").to_numpy(zero_copy_only=False)
        places = batch.column("places")
        for i in np.flatnonzero(more):
            cells = np.frombuffer(places[i].as_py(), "<i8").reshape(-1, 4)
            cells = cells[cells[:, 0] != owners[i]]
            pending.append(cells)
            held += len(cells)
        key, owner = (h1[-1], h2[-1]), owners[-1]
        if held > 500_000:
            yield from masks(pending)
            pending, held = [], 0
    yield from masks(pending)


def line_masks(docs: DataFrame) -> DataFrame:
    """``doc, text_hash, masks``: for every document that loses lines its bitmaps (one for each
    range that found some); the lines that stay are those whose bit is 1 in all of them."""
    n = shuffle_partitions(docs.sparkSession)
    texts = doc_texts(docs).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = texts.mapInArrow(reduce_lines, LINE_SCHEMA)
    # the hash's upper 31 bits, scaled to the number of ranges
    part = F.floor(F.shiftrightunsigned("h1", 33) * F.lit(n) / F.lit(1 << 31)).cast("int")
    ranges = rows.repartitionById(n, part).sortWithinPartitions("h1", "h2", "doc", "pos")
    found = ranges.mapInArrow(keep_first, MASK_SCHEMA)
    return found.groupBy("doc", "text_hash").agg(F.collect_set("mask").alias("masks"))


def kept_lines(text: str, found: list[bytes] | None) -> tuple[list[str], int]:
    """The lines that stay and the number of all lines."""
    lines = text.split("\n")
    if not found:
        return lines, len(lines)
    keep = np.ones(len(lines), bool)
    for m in found:
        raw = zlib.decompress(m)
        keep &= np.unpackbits(np.frombuffer(raw, np.uint8, offset=8), count=len(lines)).astype(bool)
    return [x for x, k in zip(lines, keep, strict=True) if k], len(lines)


def with_masks(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents (all columns) with their bitmaps, and the name of that column."""
    name, d, h = fresh(docs, "line_masks"), fresh(docs, "mask_doc"), fresh(docs, "mask_text")
    found = line_masks(docs).toDF(d, h, name).hint("shuffle_hash")
    on = (F.coalesce(docs["doc_id"].cast("bigint"), F.lit(LAST)) == found[d]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == found[h])
    return docs.join(found, on, "left").drop(d, h), name


def line_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""
    joined, name = with_masks(docs)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, dropped, sha = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("masks").to_pylist(), strict=True):
                kept, total = kept_lines(text or "", found)
                n.append(total)
                dropped.append(total - len(kept))
                sha.append(hashlib.sha256("\n".join(kept).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(sha, pa.string())],
                                             names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    slim = joined.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(name).alias("masks"))
    return slim.mapInArrow(digest, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents (all their columns) without the lines that repeat; a text without any such
    line, a null one too, is unchanged."""
    joined, name = with_masks(docs)

    @F.pandas_udf("string")
    def cut(text, found):
        return text.combine(found, lambda t, m: t if m is None or len(m) == 0 else "\n".join(kept_lines(t or "", list(m))[0]))

    cleaned = F.when(F.col(name).isNull(), F.col("text")).otherwise(cut(F.col("text").cast("string"), F.col(name)))
    return joined.withColumn("text", cleaned).drop(name).select(*[f"`{c}`" for c in docs.columns])


ORACLE = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM split),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
rep AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.doc_id, k.line, k.i, rep.owner IS NOT NULL AND rep.owner <> k.doc_id AS gone FROM k LEFT JOIN rep ON k.key = rep.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
