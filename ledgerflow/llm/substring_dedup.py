"""Substring dedup (operator 8) by De Bruijn compaction over words.

The windows of ``width`` words are the edges of a De Bruijn graph (an edge joins the sequence of its
first words to that of its last). Edges are dealt by their least k-gram; a run of neighbouring edges
with the same one is a path. Equal paths are compacted into one with all its source coordinates;
where several different paths meet at one k-gram (the graph branches) they are compared edge by
edge. Repeated paths go back along their source coordinates through a join with the documents, where
neighbouring ones are glued to long spans. See ``_windows`` for the steps.

An edge is repeated when its word sequence starts at another place, in the same document or any
other. Words are compared by 64-bit hashes of their bytes, as they are.

Defined results: the digests ignore other columns, whatever their
names, and filters return all of them; a null or empty text has no words (the digest of the empty string); a null doc_id is passed
through; rows that repeat are places of their own, so each makes the other repeated; an empty table
gives no rows; texts shorter than a window are returned whole."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerflow.llm import _text as tx
from ledgerflow.llm._windows import Windows, documents_with_spans, groups, merge_spans

WIDTH = 35
ANCHOR = 16


def edge_counts(width: int):
    """How often each edge of the branching paths occurs, over all places of all of them."""
    def judge(_, places: np.ndarray, first: np.ndarray, words: np.ndarray) -> np.ndarray:
        prefix = tx.prefix_hash(words)
        n = np.diff(first) - (width - 1)
        owner = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(owner)) + owner * (width - 1)
        edge = tx.span_hash(prefix, at, at + width)
        order = np.argsort(edge)
        start = groups([edge[order]])
        count = np.add.reduceat(places[owner[order]], start)
        out = np.empty(len(edge), np.int64)
        out[order] = np.repeat(count, np.diff(np.append(start, len(edge))))
        return out

    return judge


def removed_spans(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, text, text_hash, cells``: the documents with the spans of words (start, length)
    that repeated windows cover."""
    return documents_with_spans(docs, Windows(width, anchor, True, False), edge_counts(width))


def substring_digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, sha = [], [], []
            for text, cells in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("cells").to_pylist(), strict=True):
                words = (text or b"").split()
                n_words.append(len(words))
                if cells:
                    spans = np.frombuffer(cells, np.uint32).reshape(-1, 2)
                    kept, at = [], 0
                    for a, b in zip(*merge_spans(spans[:, 0], spans[:, 1]), strict=True):
                        kept += words[at:a]
                        at = b
                    words = kept + words[at:]
                n_removed.append(n_words[-1] - len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return removed_spans(docs, width).mapInArrow(digest, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS MATERIALIZED (SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM d),
win AS (SELECT rid, i, string_agg(word, ' ') OVER u AS win, count(*) OVER u AS n FROM w
        WINDOW u AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
again AS (SELECT md5(win) AS h FROM win WHERE n = 35 GROUP BY 1 HAVING count(*) > 1),
hit AS (SELECT rid, i FROM win WHERE n = 35 AND md5(win) IN (SELECT h FROM again)),
c AS (SELECT w.rid, w.i, w.word, max(CASE WHEN hit.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY w.rid ORDER BY w.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
      FROM w LEFT JOIN hit ON w.rid = hit.rid AND w.i = hit.i),
k AS (SELECT rid, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY rid)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.rid = k.rid
"""
