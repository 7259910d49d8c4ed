"""Suffix-array dedup (operator 2): bytes covered by a string of ``width`` bytes that also starts in
a document with a smaller doc_id.

Shards are made so that equal strings meet: by their least k-gram (``_windows``). Equal stretches
are merged before sorting into one tuple with the smallest document that holds it; a k-gram with one
distinct stretch needs no sorting. The other stretches of a shard are one text, whose suffixes an
external induced sort puts in order with their common prefixes (``_induced``): suffixes that agree on
``width`` bytes are neighbours, and the smallest document among them decides for all.

Strings are judged on the input and matches never cross documents.

Defined results: the digests ignore other columns, whatever their
names, and filters return all of them; a null or empty text is empty; a null doc_id comes after all others, rows without
one being one document; rows that repeat a doc_id are one document for the rule, and each is
returned; an empty table gives no rows; texts shorter than ``width`` are returned whole."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerflow.llm._induced import suffix_order
from ledgerflow.llm._windows import Windows, documents_with_spans, merge_spans

WIDTH = 50
ANCHOR = 24


def first_documents(width: int):
    """For each window of the stretches the smallest document in which it starts."""
    def judge(doc: np.ndarray, _, first: np.ndarray, raw: np.ndarray) -> np.ndarray:
        size = np.diff(first)
        # stretches end with a symbol that no byte has
        text = np.zeros(len(raw) + len(size), np.int32)
        owner = np.repeat(np.arange(len(size)), size)
        text[np.arange(len(raw)) + owner] = raw.astype(np.int32) + 1
        pos, lcp = suffix_order(text, width)
        group = np.cumsum(lcp < width)
        stretch = np.repeat(np.arange(len(size)), size + 1)
        who = doc[stretch[pos]]
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        least = np.minimum.reduceat(who, start)
        at = np.empty(len(text), np.int64)
        at[pos] = np.repeat(least, np.diff(np.append(start, len(pos))))
        n = size - (width - 1)
        mine = np.repeat(np.arange(len(size)), n)
        return at[np.arange(len(mine)) + mine * width]  # of each stretch its first n places

    return judge


def removed_spans(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, text, text_hash, cells``: the documents with the spans of bytes (start, length) to
    remove."""
    return documents_with_spans(docs, Windows(width, anchor, False, True), first_documents(width))


def suffix_digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw, cells in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("cells").to_pylist(), strict=True):
                raw = raw or b""
                kept, n_spans = raw, 0
                if cells:
                    spans = np.frombuffer(cells, np.uint32).reshape(-1, 2)
                    a, b = merge_spans(spans[:, 0], spans[:, 1])
                    kept = b"".join(raw[i:j] for i, j in zip(np.append(0, b).tolist(), np.append(a, len(raw)).tolist(), strict=True))
                    n_spans = len(a)
                rows.append((len(raw), len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest()))
            n, removed, spans, sha = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                                              pa.array(sha, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return removed_spans(docs, width).mapInArrow(digest, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS MATERIALIZED (SELECT rid, doc_id, p, md5(substr(x, 2 * p + 1, 100)) AS h FROM (SELECT rid, doc_id, x, unnest(range(length(x) // 2 - 49)) AS p FROM d WHERE length(x) >= 100)),
own AS (SELECT h, min(doc_id) AS least FROM s GROUP BY h HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT s.rid, s.p FROM s JOIN own ON s.h = own.h AND s.doc_id > own.least),
e AS (SELECT rid, p, lag(p) OVER (PARTITION BY rid ORDER BY p) AS before FROM hit),
r AS (SELECT rid, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY p) AS run FROM e),
spans AS (SELECT rid, run, min(p) AS a, max(p) + 50 AS b FROM r GROUP BY rid, run),
pieces AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS from_b, max(b) OVER (PARTITION BY rid) AS last_b FROM spans),
k AS (SELECT z.rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
             string_agg(substr(x, 2 * from_b + 1, 2 * (a - from_b)), '' ORDER BY a) || substr(any_value(x), 2 * any_value(last_b) + 1) AS kept FROM pieces z JOIN d ON z.rid = d.rid GROUP BY z.rid)
SELECT d.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN k ON d.rid = k.rid
"""
