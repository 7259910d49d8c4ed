"""Repeated windows of a fixed width, over the texts of all documents, by anchors.

A window's anchor is the least hash among its k-grams. Neighbouring windows mostly share its place:
such a run is a *path*, one row's worth of data for many windows, and equal windows always lie in paths
with one anchor. So:

1. ``scatter`` turns blocks of documents into paths (anchor, content hash, place) and deals them to
   ranges of the anchor, one packed value for each block and range.
2. ``resolve`` reads one range. An anchor that occurs once is done. What is decided by equal whole
   paths is decided; of anchors with several different paths (they branch) each distinct path is
   asked for once, from one document.
3. ``contexts`` lets the documents answer those requests; ``settle`` compares the branching paths
   of a range window by window.
4. ``spans_by_document`` gathers what was found for each document.

Ranges are as many as the session's shuffle partitions, or more so that a task holds a bounded part
(``ranges_for``); texts are never grouped by content, and a passage that very many documents hold is spread over the ranges of its anchors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import _text as tx
from ledgerflow.llm._frames import doc_texts, ranges_for
from ledgerflow.llm._graph import cut
from ledgerflow.llm._pack import pack, pack_sorted, unpack

LAST = (1 << 63) - 1     # the place of a null doc_id in the order of documents
REST_BITS = 40           # of an anchor's bits below those that choose the range
CONTENT_BITS = 48        # of a path's content hash
BLOCK_PATHS = 1_000_000  # paths (or BLOCK_DOCS documents) of a block
BLOCK_DOCS = 60_000
BASE_MIX = 0x5851F42D4C957F2D
SHARD_SYMBOLS = 2 << 20  # symbols judged at a time, or more where those of one anchor are more

FOUND = "kind int, part int, payload binary"
SPAN, REQUEST, BRANCH = 1, 2, 3


@dataclass(frozen=True)
class Windows:
    width: int       # symbols of a window
    anchor: int      # symbols of an anchor
    of_words: bool   # symbols are words, else bytes
    by_document: bool  # a window repeats when another document has it; else any other place


def symbols(spec: Windows, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The batch's symbols (bytes, or words' hashes) and each text's first."""
    if not spec.of_words:
        return data, offsets
    s, e, first = tx.words(data, offsets)
    return tx.piece_hash(data, s, e), first


def paths(spec: Windows, syms: np.ndarray, first: np.ndarray):
    """Start (in the batch), number of windows, anchor and content hash of every path."""
    width, k = spec.width, spec.anchor
    none = np.zeros(0, np.int64)
    if len(syms) < width:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = tx.prefix_hash(syms)
    shift = tx.powers(len(prefix), tx.BASE_INV)
    grams = tx.mix((prefix[k:] - prefix[:-k]) * shift[:len(prefix) - k] + np.uint64(k))
    least = tx.sliding_min(grams, width - k + 1)
    text = tx.text_index(first)
    ok = np.flatnonzero(text[:len(least)] == text[width - 1:width - 1 + len(least)])
    anchor = least[ok]
    # a path ends where the least k-gram changes, or where the one at hand leaves the window
    new = np.ones(len(ok), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (ok[1:] != ok[:-1] + 1) | (grams[ok[:-1]] == anchor[:-1])
    start = np.flatnonzero(new)
    n = np.diff(np.append(start, len(ok)))
    at = ok[start]
    content = tx.span_hash(prefix, at, at + n + width - 1, shift) >> np.uint64(64 - CONTENT_BITS)
    return at, n, tx.mix(anchor[start] ^ np.uint64(BASE_MIX)), content  # least values are not uniform


def keys_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array([LAST if i is None else i for i in batch.column("doc_id").to_pylist()], np.int64)
    return ids, batch.column("text_hash").to_numpy()


def scatter(spec: Windows, ranges: int):
    """Step 1: rows (range, packed paths of one block). Each value has the documents it names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n_docs = n_paths = 0

        def flush() -> pa.RecordBatch:
            anchor, content, doc, start, n, ids, th = (np.concatenate(x) for x in zip(*held, strict=True))
            part = ((anchor >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int64)
            order = np.argsort(anchor)
            edge = np.searchsorted(part[order], np.arange(ranges + 1))
            parts, payloads = [], []
            for r in range(ranges):
                o = order[edge[r]:edge[r + 1]]
                if not len(o):
                    continue
                named, own = np.unique(doc[o], return_inverse=True)
                parts.append(r)
                rest = anchor[o] & np.uint64((1 << REST_BITS) - 1)
                by_rest = np.argsort(rest)
                o, own, rest = o[by_rest], own[by_rest], rest[by_rest]
                payloads.append(pack(pack_sorted(rest), content[o], own.astype(np.uint16), start[o].astype(np.uint32),
                                     n[o].astype(np.uint16), ids[named], th[named]))
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(payloads, pa.binary())], names=["part", "payload"])

        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_DOCS):
                piece = batch.slice(lo, BLOCK_DOCS)
                if n_docs and (n_paths > BLOCK_PATHS or n_docs + piece.num_rows > BLOCK_DOCS):
                    yield flush()
                    held, n_docs, n_paths = [], 0, 0
                syms, first = symbols(spec, *tx.utf8(piece.column("text")))
                at, n, anchor, content = paths(spec, syms, first)
                text = tx.text_index(first)[at] if len(at) else np.zeros(0, np.int64)
                held.append((anchor, content, text + n_docs, at - first[text], n, *keys_of(piece)))
                n_docs, n_paths = n_docs + piece.num_rows, n_paths + len(at)
        if n_docs:
            yield flush()

    return run


def spread(doc: np.ndarray, th: np.ndarray, parts: int) -> np.ndarray:
    """The part of a document's key, for gathering."""
    return (tx.mix(doc.view(np.uint64) * np.uint64(3) + th.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def by_document(kind: int, parts: int, doc: np.ndarray, th: np.ndarray, *values: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Rows for step 4 (or for requests): values packed for each part of the documents' keys."""
    part = spread(doc, th, parts)
    order = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[order], np.arange(parts + 1))
    for r in np.flatnonzero(np.diff(edge)):
        o = order[edge[r]:edge[r + 1]]
        yield kind, int(r), pack(doc[o], th[o], *(v[o] for v in values))


def as_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, part, payload = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(payload, pa.binary())],
                                      names=["kind", "part", "payload"])


def groups(sorted_keys: list[np.ndarray]) -> np.ndarray:
    """Starts of runs of equal keys."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = False
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def resolve(spec: Windows, parts: int):
    """Step 2, one range in one call. SPAN rows: places of whole paths found repeated. BRANCH: the
    paths of anchors that branch, with their places. REQUEST: one place of each distinct one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[] for _ in range(6)]
        here = None
        for batch in batches:
            here = batch.column("part")[0].as_py() if batch.num_rows else here
            for raw in batch.column("payload"):
                rest, content, own, start, n, ids, th = unpack(raw.as_py())
                for c, x in zip(cols, (np.cumsum(rest), content, ids[own], th[own], start, n), strict=True):
                    c.append(x)
        if here is None:
            return
        rest, content, doc, th, start, n = (np.concatenate(c) for c in cols)
        del cols
        order = np.argsort(rest)
        g = groups([rest[order]])
        size = np.diff(np.append(g, len(order)))
        again = np.repeat(size > 1, size)
        if spec.by_document and len(g):
            d = doc[order]
            again &= np.repeat(np.minimum.reduceat(d, g) != np.maximum.reduceat(d, g), size)
        o = order[again]
        o = o[np.lexsort((start[o], th[o], doc[o], content[o], rest[o]))]
        rest, content, doc, th, start, n = rest[o], content[o], doc[o], th[o], start[o], n[o]
        if not len(o):
            return
        anchors, kinds = groups([rest]), groups([rest, content])
        n_kinds = np.diff(np.append(np.searchsorted(kinds, anchors), len(kinds)))
        branching = np.repeat(n_kinds > 1, np.diff(np.append(anchors, len(rest))))
        size = np.diff(np.append(kinds, len(rest)))
        if spec.by_document:
            # the only path of its anchor: every later document's windows start in an earlier one
            hit = ~branching & (doc != np.repeat(doc[kinds], size))
        else:
            hit = np.repeat(size > 1, size)
        rows = list(by_document(SPAN, parts, doc[hit], th[hit], start[hit], (n[hit] + spec.width - 1).astype(np.uint32)))
        if branching.any():
            kind_no = np.repeat(np.arange(len(kinds)), size)[branching]
            _, kind_no = np.unique(kind_no, return_inverse=True)
            doc, th, start, n = doc[branching], th[branching], start[branching], n[branching]
            meet = np.cumsum(np.append(0, rest[branching][1:] != rest[branching][:-1])).astype(np.uint32)
            rows.append((BRANCH, here, pack(meet, kind_no.astype(np.uint32), doc, th, start, n)))
            rep = groups([kind_no])
            rows += by_document(REQUEST, parts, doc[rep], th[rep], np.full(len(rep), here, np.uint32), kind_no[rep].astype(np.uint32),
                                start[rep], (n[rep] + spec.width - 1).astype(np.uint32))
        yield as_batch(rows)

    return run


def gather(values: int):
    """Rows of one part -> one row for each document: its key and its packed values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[] for _ in range(2 + values)]
        for batch in batches:
            for raw in batch.column("payload"):
                for c, x in zip(cols, unpack(raw.as_py()), strict=True):
                    c.append(x)
        if not cols[0]:
            return
        flat = [np.concatenate(c) for c in cols]
        order = np.lexsort((flat[1], flat[0]))
        flat = [x[order] for x in flat]
        edge = np.append(groups(flat[:2]), len(order))
        packed = [np.ascontiguousarray(np.column_stack([x[i:j].astype(np.uint32) for x in flat[2:]])).tobytes() for i, j in zip(edge[:-1], edge[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(flat[0][edge[:-1]]), pa.array(flat[1][edge[:-1]]), pa.array(packed, pa.binary())],
                                         names=["key_doc", "key_text", "cells"])

    return run


def gathered(found: DataFrame, kind: int, values: int, parts: int) -> DataFrame:
    """Step 4: ``key_doc, key_text, cells`` (rows of ``values`` uint32)."""
    rows = found.where(F.col("kind") == kind).select("part", "payload").repartitionById(parts, F.col("part"))
    return rows.mapInArrow(gather(values), "key_doc bigint, key_text bigint, cells binary")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, key (never null), text_hash``."""
    return doc_texts(docs).withColumn("key", F.coalesce("doc_id", F.lit(LAST))).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))


def with_cells(texts: DataFrame, cells: DataFrame, how: str) -> DataFrame:
    # the small side is built, the texts are streamed past it
    on = (texts["key"] == cells["key_doc"]) & (texts["text_hash"] == cells["key_text"])
    return texts.join(cells.hint("shuffle_hash"), on, how).select("doc_id", "text", "text_hash", "cells")


def contexts(spec: Windows):
    """Step 3a: documents with requests -> rows (range, packed symbols of the asked paths)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tx.utf8(batch.column("text"))
            syms, first = symbols(spec, data, offsets)
            cells = [np.frombuffer(c, np.uint32).reshape(-1, 4) for c in batch.column("cells").to_pylist()]
            base = np.repeat(first[:-1], [len(c) for c in cells])
            ask = np.concatenate(cells) if cells else np.zeros((0, 4), np.uint32)
            order = np.argsort(ask[:, 0], kind="stable")
            ask, base = ask[order], base[order]
            edge = np.append(groups([ask[:, 0]]), len(ask)) if len(ask) else np.zeros(1, np.int64)
            rows = []
            for i, j in zip(edge[:-1], edge[1:], strict=True):
                size = ask[i:j, 3].astype(np.int64)
                at = np.repeat(base[i:j] + ask[i:j, 2] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
                rows.append((REQUEST, int(ask[i, 0]), pack(ask[i:j, 1].copy(), ask[i:j, 3].copy(), syms[at])))
            yield as_batch(rows)

    return run


def merge_spans(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans (touching spans are one run)."""
    order = np.argsort(start, kind="stable")
    a, b = start[order].astype(np.int64), (start[order].astype(np.int64) + size[order])
    reach = np.maximum.accumulate(b)
    new = np.append(True, a[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return a[at], reach[np.append(at[1:], len(a)) - 1]


Judge = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], Callable[[np.ndarray], np.ndarray]]


def settle(spec: Windows, parts: int, judge):
    """Step 3b, one range in one call: ``judge(kind_first_doc, places, lengths, symbols)`` gives for
    each window of each distinct branching path a value; ``hits`` says which places it removes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        branch, got = None, []
        for batch in batches:
            for kind, raw in zip(batch.column("kind").to_pylist(), batch.column("payload"), strict=True):
                if kind == BRANCH:
                    branch = unpack(raw.as_py())
                else:
                    got.append(unpack(raw.as_py()))
        if branch is None:
            return
        meet, kind_no, doc, th, start, n = branch
        rep = groups([kind_no])
        places = np.diff(np.append(rep, len(kind_no)))
        # one text for each distinct path, in the order of their numbers (a repeated row answers twice)
        number = np.concatenate([g[0] for g in got])
        size = np.concatenate([g[1] for g in got]).astype(np.int64)
        text = np.concatenate([g[2] for g in got])
        at = np.append(0, np.cumsum(size))[:-1]
        _, pick = np.unique(number, return_index=True)
        size, at = size[pick], at[pick]
        first = np.append(0, np.cumsum(size))
        text = text[np.repeat(at - first[:-1], size) + np.arange(first[-1])]
        # paths that meet at one anchor are judged together, and as many anchors as fill a shard
        bound, value = np.append(groups([meet[rep]]), len(rep)), []
        shard = np.append(groups([first[bound[1:]] // SHARD_SYMBOLS]), len(bound) - 1)
        for i, j in zip(bound[shard[:-1]], bound[shard[1:]], strict=True):
            value.append(judge(doc[rep][i:j], places[i:j], first[i:j + 1] - first[i], text[first[i]:first[j]]))
        value = np.concatenate(value)
        # windows of every place: those of its path, against the path's values
        n = n.astype(np.int64)
        windows_first = np.append(0, np.cumsum(size - (spec.width - 1)))
        rows: list[tuple[int, int, bytes]] = []
        out: list[tuple] = []
        step = 200_000
        for lo in range(0, len(n), step):
            own = slice(lo, lo + step)
            total = n[own]
            owner = np.repeat(np.arange(len(total)), total)
            inside = np.arange(total.sum()) - np.repeat(np.append(0, np.cumsum(total)[:-1]), total)
            v = value[windows_first[kind_no[own]][owner] + inside]
            hit = (v < doc[own][owner]) if spec.by_document else (v > 1)
            owner, inside = owner[hit], inside[hit]
            if not len(owner):
                continue
            run_at = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1] + 1)))
            length = np.diff(np.append(run_at, len(owner)))
            who = owner[run_at]
            out.append((doc[own][who], th[own][who], (start[own][who].astype(np.int64) + inside[run_at]).astype(np.uint32), (length + spec.width - 1).astype(np.uint32)))
        if out:
            rows += by_document(SPAN, parts, *(np.concatenate(x) for x in zip(*out, strict=True)))
        yield as_batch(rows)

    return run


def documents_with_spans(docs: DataFrame, spec: Windows, judge) -> DataFrame:
    """``doc_id, text, text_hash, cells``: documents with the spans (start, length in symbols, as
    uint32 pairs; null: none) covered by repeated windows. The texts are shuffled once, by document:
    both joins use the same exchange."""
    texts = keyed(docs)
    parts = ranges_for(texts)
    dealt = texts.select("doc_id", "text", "text_hash").mapInArrow(scatter(spec, parts), "part int, payload binary")
    found = cut(dealt.repartitionById(parts, F.col("part")).mapInArrow(resolve(spec, parts), FOUND))
    asked = with_cells(texts, gathered(found, REQUEST, 4, parts), "inner")
    answers = asked.mapInArrow(contexts(spec), FOUND)
    branches = found.where(F.col("kind") == BRANCH).unionAll(answers).repartitionById(parts, F.col("part"))
    settled = branches.mapInArrow(settle(spec, parts, judge), FOUND)
    spans = gathered(found.where(F.col("kind") == SPAN).unionAll(settled), SPAN, 2, parts)
    return with_cells(texts, spans, "left")
