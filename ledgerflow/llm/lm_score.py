"""LM scoring (operator 6): prediction by partial matching over bytes, pretrained on the corpus.

* Trie: counts of every byte after its last five bytes, over all training documents. Every context
  is kept, and nothing of three bytes or more is collected or broadcast. Documents are dealt to
  blocks by their hash; a block deals its distinct codes by the nearest three bytes, so one range
  has all that contexts of three to five bytes need, and gives each block the code lengths of the
  block's codes back. Counts of two bytes and shorter (at most 2^24) are broadcast.
* Coding: escape estimation by method C (an escape counts as often as the context has distinct
  followers) with symbol exclusion: after an escape the followers of the longer context are out of
  the shorter one's counts; below order 0 the bytes left are equally likely. A document's score is
  the sum over its bytes; each distinct code of a range is looked up once.
* Word base: a block of documents (a map task's stretch) sorts its words' hashes and deals them to
  ranges of the hash, with the documents that hold them; a range sums the training counts over all
  blocks and returns each block's partial sums. A word in every document is one entry in a block.

Words are identified by 64-bit hashes. Defined results: the digests ignore other columns, whatever their
names, and filters return all of them; a null text is empty (its only token is
the end; score 0); a null doc_id is a training row, passed through; rows that repeat are counted
each; an empty table gives no rows; with nothing to train on, all bytes are equally likely."""

from __future__ import annotations

import binascii
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import _text as tx
from ledgerflow.llm._frames import doc_texts, ranges_for
from ledgerflow.llm._graph import cut
from ledgerflow.llm._pack import pack, pack_sorted, unpack

FOLDS, HELD_OUT = 7, 2   # rows whose crc32(doc_id as text) mod 7 is 2 teach nothing
DEPTH = 5                # bytes of the longest context
BLOCK_BYTES = 8 << 20    # text of a block of the byte model, about
BLOCK_WORDS = 3_000_000  # words (or BLOCK_DOCS documents) of a block
BLOCK_DOCS = 60_000
ROW = 256
LAST = (1 << 63) - 1


def held_out(ids: list[int | None]) -> np.ndarray:
    return np.array([i is not None and binascii.crc32(str(i).encode()) % FOLDS == HELD_OUT for i in ids], bool)


def lowered(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tx.utf8(batch.column("text"))
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8), offsets


# --- word base -----------------------------------------------------------------------------------

def scatter_words(buckets: int):
    """Blocks of documents -> a row for each (block, hash range): the distinct hashes, their number
    of places and of training places, and the places' documents. One more row for each block
    (``kind`` 0) lists its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        hashes, owner, ids, th, train, words = [], [], [], [], [], []

        def flush() -> pa.RecordBatch:
            h, d = np.concatenate(hashes), np.concatenate(owner)
            order = np.argsort(h)
            h, d, is_train = h[order], d[order], np.concatenate(train)
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            start = np.flatnonzero(new)
            distinct, places = h[start], np.diff(np.append(start, len(h)))
            taught = np.add.reduceat(is_train[d].astype(np.int64), start) if len(h) else np.zeros(0, np.int64)
            bucket = ((distinct >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cut_at = np.searchsorted(bucket, np.arange(buckets + 1))
            place_at = np.append(start, len(h))
            rows = {"kind": [], "bucket": [], "block": [], "a": [], "x": [], "y": [], "z": []}

            def add(kind, bucket, a, x, y, z):
                for c, v in zip(rows, (kind, bucket, part * 1_000_000 + seq, a, x, y, z), strict=True):
                    rows[c].append(v)

            add(0, (part + seq) % buckets, int(is_train.sum()), np.concatenate(ids).tobytes(), np.concatenate(th).tobytes(),
                np.concatenate(words).astype(np.int64).tobytes())
            for b in range(buckets):
                i, j = cut_at[b], cut_at[b + 1]
                if i < j:
                    cells = np.column_stack([places[i:j], taught[i:j]]).astype(np.uint32)
                    add(1, b, 0, distinct[i:j].tobytes(), cells.tobytes(), d[place_at[i]:place_at[j]].astype(np.uint16).tobytes())
            return pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("a", pa.int64()),
                ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary())]))

        n_docs = n_words = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_DOCS):
                piece = batch.slice(lo, BLOCK_DOCS)
                if n_docs and (n_words > BLOCK_WORDS or n_docs + piece.num_rows > BLOCK_DOCS):
                    yield flush()
                    seq += 1
                    n_docs = n_words = 0
                    for x in (hashes, owner, ids, th, train, words):
                        x.clear()
                data, offsets = lowered(piece)
                s, e, first = tx.words(data, offsets)
                hashes.append(tx.piece_hash(data, s, e))
                owner.append((tx.text_index(first) + n_docs).astype(np.uint16))
                own = piece.column("doc_id").to_pylist()
                ids.append(np.array([LAST if i is None else i for i in own], np.int64))
                train.append(~held_out(own))
                th.append(piece.column("text_hash").to_numpy())
                words.append(np.diff(first))
                n_docs, n_words = n_docs + piece.num_rows, n_words + len(s)
        if n_docs:
            yield flush()

    return run


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash range: training counts over all blocks, then for each block its documents' sums of
    log10(c + 1) and numbers of known words (``kind`` 1); the range's distinct trained words and
    trained places (``kind`` 2). Block lists pass through."""
    out = {"kind": [], "block": [], "a": [], "b": [], "x": [], "y": [], "z": []}

    def add(*v):
        for c, x in zip(out, v, strict=True):
            out[c].append(x)

    blocks = []
    for batch in batches:
        for r in batch.to_pylist():
            if r["kind"] == 0:
                add(0, r["block"], r["a"], 0, r["x"], r["y"], r["z"])
            else:
                cells = np.frombuffer(r["y"], np.uint32).reshape(-1, 2)
                blocks.append((r["block"], np.frombuffer(r["x"], np.uint64), cells, np.frombuffer(r["z"], np.uint16)))
    if blocks:
        h = np.concatenate([b[1] for b in blocks])
        taught = np.concatenate([b[2][:, 1] for b in blocks]).astype(np.int64)
        order = np.argsort(h)
        new = np.ones(len(h), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        total = np.add.reduceat(taught[order], np.flatnonzero(new))
        add(2, 0, int((total > 0).sum()), int(total.sum()), b"", b"", b"")
        c = np.empty(len(h), np.int64)
        c[order] = total[np.cumsum(new) - 1]
        at = 0
        for block, hashes, cells, docs in blocks:
            own = c[at:at + len(hashes)]
            at += len(hashes)
            found, back = np.unique(docs, return_inverse=True)
            sums = np.bincount(back, np.repeat(np.log10(own + 1.0), cells[:, 0]), len(found))
            known = np.bincount(back, np.repeat(own > 0, cells[:, 0]), len(found)).astype(np.uint32)
            add(1, block, 0, 0, found.tobytes(), sums.tobytes(), known.tobytes())
    yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
        ("kind", pa.int32()), ("block", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary())]))


def sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (block, kind): the block's list of documents, then its partial sums."""
    def done():
        ids, th, words, sums, known = now
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(th), pa.array(words), pa.array(sums), pa.array(known)],
                                          names=["key", "text_hash", "n_words", "log_sum", "n_known"])

    now, block = None, None
    for batch in batches:
        for r in batch.to_pylist():
            if r["kind"] == 0:
                if now is not None:
                    yield done()
                ids, th, words = (np.frombuffer(r[c], np.int64) for c in "xyz")
                now, block = (ids, th, words, np.zeros(len(ids)), np.zeros(len(ids), np.int64)), r["block"]
            else:
                assert r["block"] == block
                docs = np.frombuffer(r["x"], np.uint16)
                now[3][docs] += np.frombuffer(r["y"], np.float64)
                now[4][docs] += np.frombuffer(r["z"], np.uint32)
    if now is not None:
        yield done()


def word_base(texts: DataFrame) -> tuple[DataFrame, int, int, int]:
    """``key, text_hash, n_words, log_sum, n_known`` of every distinct row, then the number of
    training documents, of distinct trained words and of trained words."""
    n = ranges_for(texts)
    dealt = texts.mapInArrow(scatter_words(n), "kind int, bucket int, block bigint, a bigint, x binary, y binary, z binary")
    dealt = dealt.repartitionById(n, F.col("bucket"))
    ranges = cut(dealt.mapInArrow(count_words, "kind int, block bigint, a bigint, b bigint, x binary, y binary, z binary"))
    facts = {r["kind"]: r for r in ranges.where("kind <> 1").groupBy("kind").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()}
    trained = facts[0]["a"] if 0 in facts else 0
    distinct, places = (facts[2]["a"], facts[2]["b"]) if 2 in facts else (0, 0)
    blocks = ranges.where("kind < 2").repartition(n, "block").sortWithinPartitions("block", "kind")
    sums = blocks.mapInArrow(sum_blocks, "key bigint, text_hash bigint, n_words bigint, log_sum double, n_known bigint")
    sums = sums.groupBy("key", "text_hash").agg(*[F.min(c).alias(c) for c in ("n_words", "log_sum", "n_known")])
    return sums, trained, distinct, places


# --- the byte model ------------------------------------------------------------------------------

def grams_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte one code: the ``DEPTH`` bytes before it in its text (zeros before the text),
    the nearest lowest, and then the byte itself in the lowest eight bits."""
    n_texts = len(offsets) - 1
    wide = np.zeros(len(data) + DEPTH * n_texts, np.uint64)
    at = np.arange(len(data)) + DEPTH * (np.repeat(np.arange(n_texts), np.diff(offsets)) + 1)
    wide[at] = data
    code = wide[at]
    for k in range(1, DEPTH + 1):
        code |= wide[at - k] << np.uint64(8 * k)
    return code


def low(code: np.ndarray, n_bytes: int) -> np.ndarray:
    return code & np.uint64((1 << (8 * n_bytes)) - 1)


def summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, and the sums of their counts."""
    order = np.argsort(code)
    code, n = code[order], n[order]
    start = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    return code[start], np.add.reduceat(n, start) if len(code) else n


def range_of(code: np.ndarray, ranges: int) -> np.ndarray:
    """A code's range: that of the nearest three bytes of its context."""
    return (tx.mix(low(code >> np.uint64(8), 3)) % np.uint64(ranges)).astype(np.int64)


def texts_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tx.utf8(table["text"].combine_chunks())


def scatter_codes(ranges: int):
    """One block -> for each range the block's distinct codes and their counts in training texts (0
    for codes that only held-out texts have)."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        train = ~held_out(table["doc_id"].to_pylist())
        code, taught = zip(*[np.unique(grams_of(*texts_of(table.filter(pa.array(which)))), return_counts=True) for which in (train, ~train)], strict=True)
        code, n = summed(np.concatenate(code), np.concatenate([taught[0], np.zeros_like(taught[1])]))
        part = range_of(code, ranges)
        order = np.argsort(part, kind="stable")
        edge = np.searchsorted(part[order], np.arange(ranges + 1))
        code, n, parts = code[order], n[order].astype(np.uint32), np.flatnonzero(np.diff(edge))
        payloads = [pack(pack_sorted(code[edge[r]:edge[r + 1]]), n[edge[r]:edge[r + 1]]) for r in parts]
        return pa.table([pa.array(parts, pa.int32()), pa.array([key[0].as_py()] * len(parts), pa.int64()), pa.array(payloads, pa.binary())],
                        names=["part", "block", "payload"])

    return run


def score_codes(short):
    """One range: its whole trie, then for each block the code lengths of the block's codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, codes, counts = [], [], []
        for batch in batches:
            for r in batch.to_pylist():
                rows.append((r["part"], r["block"], r["payload"]))
                code, n = unpack(r["payload"])
                codes.append(np.cumsum(code, dtype=np.uint64))
                counts.append(n.astype(np.int64))
                if len(codes) > 64:
                    code, n = summed(np.concatenate(codes), np.concatenate(counts))
                    codes, counts = [code], [n]
        if not rows:
            return
        every, n = summed(np.concatenate(codes), np.concatenate(counts))
        # a partition can hold several ranges; no context is in two of them
        code, n, grams = every[n > 0], n[n > 0], {}
        for k in range(DEPTH, 2, -1):
            code, n = summed(low(code, k + 1), n) if k < DEPTH else (code, n)
            grams[k] = (code, n)
        lp = code_lengths(byte_model(grams, short.value), every).astype(np.float32)
        for lo in range(0, len(rows), 64):
            part, block, payload = zip(*rows[lo:lo + 64], strict=True)
            found = [pack(lp[np.searchsorted(every, np.cumsum(unpack(raw)[0], dtype=np.uint64))]) for raw in payload]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(block, pa.int64()), pa.array(found, pa.binary())],
                                             names=["part", "block", "payload"])

    return run


def sum_codes(ranges: int):
    """One block's documents and the code lengths of its codes -> each document's sum."""
    def run(found: pa.Table, table: pa.Table) -> pa.Table:
        data, offsets = texts_of(table)
        code, back = np.unique(grams_of(data, offsets), return_inverse=True)
        rows = sorted(found.select(["part", "payload"]).to_pylist(), key=lambda r: r["part"])
        lp = np.zeros(len(code))
        if rows:
            lp[np.argsort(range_of(code, ranges), kind="stable")] = np.concatenate([unpack(r["payload"])[0] for r in rows])
        total = np.concatenate([[0.0], np.cumsum(lp[back])])
        ids = table["doc_id"].combine_chunks()
        return pa.table([ids, table["text_hash"].combine_chunks(), pa.array(held_out(ids.to_pylist())), pa.array(total[offsets[1:]] - total[offsets[:-1]])],
                        names=["doc_id", "text_hash", "held_out", "score"])

    return run


def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the codes of two-byte contexts in a task's training texts."""
    counts = np.zeros(1 << 24, np.int64)
    for batch in batches:
        train = ~held_out(batch.column("doc_id").to_pylist())
        code = low(grams_of(*tx.utf8(batch.filter(pa.array(train)).column("text"))), 3)
        counts += np.bincount(code.astype(np.int64), minlength=len(counts))
    code = np.flatnonzero(counts)
    for lo in range(0, len(code), 1 << 16):
        own = code[lo:lo + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(counts[own])], names=["code", "n"])


def dense(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts (sorted) and their 256 followers' counts, from sorted (context, byte) codes."""
    ctx, row = np.unique(code >> np.uint64(8), return_inverse=True)
    table = np.zeros((len(ctx), ROW))
    table[row, low(code, 1).astype(np.int64)] = n
    return ctx, table


def short_contexts(code: np.ndarray, n: np.ndarray) -> dict:
    """For contexts of two bytes and shorter, code lengths of all 256 bytes: ``start`` when coding
    begins there, ``tail`` after an escape from there; rows of order 2, 1 and 0 one after another."""
    levels = [None, None, dense(code, n)]
    for k in (1, 0):
        ctx, owner = np.unique(low(levels[k + 1][0], k) if k else np.zeros_like(levels[k + 1][0]), return_inverse=True)
        t = np.zeros((len(ctx), ROW))
        np.add.at(t, owner, levels[k + 1][1])
        levels[k] = (ctx, t)
    if not len(levels[0][0]):
        levels[0] = (np.zeros(1, np.uint64), np.zeros((1, ROW)))
    starts, tails = [], []
    with np.errstate(divide="ignore", invalid="ignore"):
        for k, (ctx, c) in enumerate(levels):
            seen = c > 0
            if k == 0:
                tail = np.full((len(ctx), ROW), -math.log10(max(1, ROW - int(seen.sum()))), np.float32)
            else:
                parent = np.searchsorted(levels[k - 1][0], low(ctx, k - 1) if k > 1 else np.zeros_like(ctx))
                tail = np.empty((len(ctx), ROW), np.float32)
                for i in range(0, len(ctx), 2048):
                    p, own = parent[i:i + 2048], seen[i:i + 2048]
                    cp = np.where(own, 0, levels[k - 1][1][p])  # exclusion
                    new = cp > 0
                    total, kinds = cp.sum(1, keepdims=True), new.sum(1, keepdims=True)
                    escape = np.where(kinds > 0, np.log10(kinds / (total + kinds)), 0.0)
                    tail[i:i + 2048] = np.where(new, np.log10(cp / (total + kinds)), escape + tails[k - 1][p])
            total, kinds = c.sum(1, keepdims=True), seen.sum(1, keepdims=True)
            escape = np.where(kinds > 0, np.log10(kinds / (total + kinds)), 0.0)
            starts.append(np.where(seen, np.log10(c / (total + kinds)), escape + tail).astype(np.float32))
            tails.append(tail)
    one = np.zeros(ROW, np.int64)
    one[levels[1][0].astype(np.int64)] = len(levels[2][0]) + np.arange(len(levels[1][0]))
    one[np.setdiff1d(np.arange(ROW), levels[1][0].astype(np.int64))] = len(levels[2][0]) + len(levels[1][0])
    row = np.tile(one, ROW)  # of any two bytes: order 2, else 1, else 0
    row[levels[2][0].astype(np.int64)] = np.arange(len(levels[2][0]))
    return {"row": row.astype(np.int32), "start": np.concatenate(starts[::-1]), "tail": tails[2], "count": levels[2][1].astype(np.float32)}


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in sorted ``keys``; -1 for none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def byte_model(grams: dict[int, tuple[np.ndarray, np.ndarray]], short: dict | None = None) -> dict:
    """The trie as sorted arrays (``short``: of contexts up to two bytes, when already made). For each depth from three bytes up: the followers (``gram``,
    ``n``), the contexts (``ctx``), their ``total`` and ``kinds``; and, for what comes after an escape
    from them, the shorter context's ``rest_total`` and ``rest_kinds`` without their followers."""
    empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    model = {"short": short_contexts(*grams.get(2, empty)) if short is None else short}
    count2 = model["short"]["count"]
    total, kinds, parents = count2.sum(1, dtype=np.float64), (count2 > 0).sum(1), None
    for k in range(3, DEPTH + 1):
        code, n = grams.get(k, empty)
        ctx = code >> np.uint64(8)
        start = np.flatnonzero(np.append(True, ctx[1:] != ctx[:-1])) if len(ctx) else np.zeros(0, np.int64)
        ctx = ctx[start]
        if k == 3:
            up = model["short"]["row"][low(ctx, 2).astype(np.int64)]
            lower = count2[np.repeat(up, np.diff(np.append(start, len(code)))), low(code, 1).astype(np.int64)].astype(np.float64)
        else:
            up = find(parents["ctx"], low(ctx, k - 1))
            lower = parents["n"][find(parents["gram"], low(code, k))].astype(np.float64)
        own = {"gram": code, "n": n, "ctx": ctx, "total": np.add.reduceat(n, start) if len(n) else n, "kinds": np.diff(np.append(start, len(code)))}
        own["rest_total"] = total[up] - (np.add.reduceat(lower, start) if len(n) else 0)
        own["rest_kinds"] = kinds[up] - own["kinds"]
        model[k] = parents = own
        total, kinds = own["total"].astype(np.float64), own["kinds"]
    return model


def code_lengths(model: dict, code: np.ndarray) -> np.ndarray:
    """log10 probabilities of (context, byte) codes; sorted codes are found fastest."""
    out = np.zeros(len(code))
    todo = np.arange(len(code))         # codes not yet settled
    above = np.full(len(code), -1)      # the longer context escaped from, if any
    with np.errstate(divide="ignore", invalid="ignore"):
        for k in range(DEPTH, 2, -1):
            m, own = model[k], code[todo]
            ctx = find(m["ctx"], low(own >> np.uint64(8), k))
            has = ctx >= 0
            gram = np.full(len(todo), -1)
            gram[has] = find(m["gram"], low(own[has], k + 1))
            if k < DEPTH:
                up = model[k + 1]
                fresh = above[todo] < 0
                total = np.where(fresh, m["total"][ctx] if len(m["ctx"]) else 0, up["rest_total"][above[todo]] if len(up["ctx"]) else 0)
                kinds = np.where(fresh, m["kinds"][ctx] if len(m["ctx"]) else 0, up["rest_kinds"][above[todo]] if len(up["ctx"]) else 0)
            else:
                total, kinds = (m["total"][ctx], m["kinds"][ctx]) if len(m["ctx"]) else (np.zeros(len(todo)), np.zeros(len(todo)))
            hit = gram >= 0
            out[todo[hit]] += np.log10(m["n"][gram[hit]] / (total[hit] + kinds[hit]))
            miss = has & ~hit & (kinds > 0)
            out[todo[miss]] += np.log10(kinds[miss] / (total[miss] + kinds[miss]))
            above[todo] = ctx
            todo = todo[~hit]
        short, own = model["short"], code[todo]
        row, byte = short["row"][low(own >> np.uint64(8), 2).astype(np.int64)], low(own, 1).astype(np.int64)
        up = above[todo]
        fresh = up < 0
        out[todo[fresh]] += short["start"][row[fresh], byte[fresh]]
        t, row, byte, up = todo[~fresh], row[~fresh], byte[~fresh], up[~fresh]
        if len(t):  # a kept context of three bytes has its two-byte context
            n = short["count"][row, byte]
            total, kinds = model[3]["rest_total"][up], model[3]["rest_kinds"][up]
            escape = np.where(kinds > 0, np.log10(kinds / (total + kinds)), 0.0)
            out[t] += np.where(n > 0, np.log10(n / (total + kinds)), escape + short["tail"][row, byte])
    return out


def short_model(texts: DataFrame) -> dict:
    """Contexts of two bytes and shorter, from all training documents."""
    rows = texts.select("doc_id", "text").mapInArrow(count_trigrams, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    return short_contexts(*summed(rows["code"].to_numpy().astype(np.uint64), rows["n"].to_numpy()))


def byte_scores(texts: DataFrame) -> DataFrame:
    """``doc_id, text_hash, held_out, score`` of every document. A block is known by its documents'
    hashes and its codes by their order, so it is the same block each time it is made."""
    n = ranges_for(texts)
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    n_blocks = -(-size // BLOCK_BYTES) or 1
    short = texts.sparkSession.sparkContext.broadcast(short_model(texts))
    blocks = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(n_blocks))).repartition(n, "block")
    dealt = blocks.groupBy("block").applyInArrow(scatter_codes(n), "part int, block bigint, payload binary").repartitionById(n, F.col("part"))
    found = dealt.mapInArrow(score_codes(short), "part int, block bigint, payload binary").repartition(n, "block")
    return found.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(
        sum_codes(n), "doc_id bigint, text_hash bigint, held_out boolean, score double")


def lm_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    texts = doc_texts(docs).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    base, trained, distinct, places = word_base(texts)
    scored = byte_scores(texts)
    named = base.withColumnRenamed("text_hash", "base_hash")
    both = scored.join(named, (F.coalesce(scored["doc_id"], F.lit(LAST)) == named["key"]) & (scored["text_hash"] == named["base_hash"]))
    n_train = places + trained                       # each training document ends once
    n_kinds = distinct + (1 if trained else 0)
    per_token = math.log10(n_train + n_kinds + 1)
    tokens = F.col("n_words") + 1
    return both.select("doc_id", "held_out", tokens.alias("n_tokens"), (F.col("n_known") + (1 if trained else 0)).alias("n_known"),
                       F.lit(n_train).cast("bigint").alias("train_tokens"),
                       (F.col("log_sum") + math.log10(trained + 1) - tokens * per_token).alias("base_score"), "score")
