"""SimHash near-dedup (operator 9): a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in at most three bits
share at least five of them. Each distinct fingerprint is posted under the bytes at three positions,
for eight choices of positions such that any five shared positions contain one of the choices; so
no link is missed. Within a posting list the shared positional bytes of a pair are tallied, pairs
with the guaranteed minimum stay and their bit distance is verified. A list gives the links of a
spanning forest and not all its pairs. A list of more than ``LIST_SIZE`` fingerprints is cut into
chunks, and each pair of chunks is a cell of its own, in any task, so that no list is ever whole in
one place and none is capped.

Copies with one fingerprint are one node. Components are found by joins (``_graph``).

Defined results: the digests ignore other columns, whatever their
names, and filters return all of them; a null text is empty and has fingerprint zero, which links like any other; a null
doc_id is passed through and never the component's id (a component of such rows only has none);
rows that repeat are returned each; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm._frames import doc_texts, fresh, shuffle_partitions
from ledgerflow.llm._graph import components, cut

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BYTES = 8
LIST_SIZE = 1000
# Any five of the eight positions have three in one of the two halves.
CHOICES = [(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3), (4, 5, 6), (4, 5, 7), (4, 6, 7), (5, 6, 7)]


def fingerprint(raw: bytes, k: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text's lower-cased word shingles, as a signed integer."""
    from xxhash import xxh64_intdigest
    words = raw.lower().split()  # ASCII only, and splits at [\x20\x09-\x0D]
    if not words:
        return 0
    text = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = (ends - size + 1)[:max(1, len(words) - k + 1)].tolist()
    ends = ends[min(k, len(words)) - 1:].tolist()
    h = np.fromiter((xxh64_intdigest(text[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def text_hash(text: str | Column) -> Column:
    """A null text is an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, fp BIGINT`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            fp = pa.array([fingerprint(t or b"", k) for t in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), fp], names=["doc_id", "text_hash", "fp"])

    return doc_texts(docs).withColumn("text_hash", text_hash("text")).mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """For each pair: enough shared positional bytes, then few enough differing bits."""
    x = a[:, None] ^ b[None, :]
    shared = (x.view(np.uint8).reshape(*x.shape, BYTES) == 0).sum(2, dtype=np.uint8)
    out = shared >= BYTES - max_bits
    out[out] = np.bitwise_count(x[out]) <= max_bits
    return out


def forest(fps: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """Links of a spanning forest of the fingerprints' link graph."""
    links, left = [], fps
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            now, front = front[:64], front[64:]
            hit = linked(now, left, max_bits)
            any_hit = hit.any(0)
            if any_hit.any():
                found = left[any_hit]
                links.append(np.column_stack([now[hit[:, any_hit].argmax(0)], found]))
                front, left = np.concatenate([front, found]), left[~any_hit]
    return links


def cell_links(max_bits: int):
    """Over rows sorted by cell: the forest links of each cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(links):
            flat = np.concatenate(links).view(np.int64) if links else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["a", "b"])

        rest_key, rest, links = None, np.zeros(0, np.uint64), []
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("choice", "key", "c", "d")]
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if not len(fp):
                continue
            new = np.zeros(len(fp), bool)
            for x in cols:
                new[1:] |= x[1:] != x[:-1]
            start = np.append(np.flatnonzero(np.append(True, new[1:])), len(fp))
            for i, j in zip(start[:-1], start[1:], strict=True):
                key = tuple(int(x[i]) for x in cols)
                if key != rest_key:
                    if len(rest) > 1:
                        links += forest(rest, max_bits)
                    rest_key, rest = key, fp[i:j]
                else:
                    rest = np.concatenate([rest, fp[i:j]])
            if len(links) > 20_000:
                yield emit(links)
                links = []
        if len(rest) > 1:
            links += forest(rest, max_bits)
        yield emit(links)

    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, list_size: int = LIST_SIZE) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fps(fp)`` that join all that are linked."""
    if max_bits > 3:
        raise ValueError("the eight choices of positions guarantee links of at most 3 bits")
    n = shuffle_partitions(fps.sparkSession)
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255)) for i in range(BYTES)]
    keys = [F.struct(F.lit(k).alias("choice"), (byte[x] * 65536 + byte[y] * 256 + byte[z]).cast("int").alias("key"))
            for k, (x, y, z) in enumerate(CHOICES)]
    posts = cut(fps.select("fp", F.inline(F.array(*keys))))
    sizes = posts.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = cut(sizes.select(F.col("choice").alias("in_choice"), F.col("key").alias("in_key"), F.ceil(F.col("n") / F.lit(list_size)).cast("int").alias("chunks")))
    listed = posts.join(sizes, (posts["choice"] == sizes["in_choice"]) & (posts["key"] == sizes["in_key"]))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    cells = listed.withColumn("own", own).select(
        "choice", "key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    cells = cells.select("choice", "key", F.least("own", "other").alias("c"), F.greatest("own", "other").alias("d"), "fp")
    dealt = cells.repartition(n, "choice", "key", "c", "d").sortWithinPartitions("choice", "key", "c", "d")
    return dealt.mapInArrow(cell_links(max_bits), "a bigint, b bigint")


def simhash_components(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, text_hash, fp, component_id, first`` of every document; ``first`` says which of the
    component's rows comes first: the smallest doc_id (none last), then the least text hash."""
    marked = cut(fingerprints(docs, k))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min(place).alias("first")))
    labels = components(near_links(nodes.select("fp"), max_bits))
    member = cut(nodes.join(labels, nodes["fp"] == labels["node"], "left").select("fp", "least", "first", F.coalesce("label", "fp").alias("label")))
    root = cut(member.groupBy(F.col("label").alias("root")).agg(F.min("least").alias("component_id"), F.min("first").alias("head")))
    named = cut(member.join(root, member["label"] == root["root"]).select(F.col("fp").alias("node"), "component_id", "head"))
    found = marked.join(named, marked["fp"] == named["node"])
    return found.select("doc_id", "text_hash", "fp", "component_id", place.eqNullSafe(F.col("head")).alias("first"))


def simhash_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (16 lowercase hex digits), ``component_id``."""
    found = simhash_components(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents (all their columns) that stay: one row of each component, that with the smallest
    doc_id (rows without one come last), of several such the one whose text has the least hash, and
    of equal texts the one whose columns' hash is least. Rows are told by doc_id and text, so a row
    isn't lost because another one with its doc_id is a copy."""
    found = simhash_components(docs, k, max_bits)
    d, h, n, p = (fresh(docs, x) for x in ("mark_doc", "mark_text", "mark_rows", "mark_pick"))
    rows = found.groupBy(F.col("doc_id").alias(d), F.col("text_hash").alias(h)).agg(F.when(F.max("first"), F.count(F.lit(1))).otherwise(F.lit(0)).alias(n))
    marks = cut(rows.where(F.col(n) != 1))  # 0: goes; more: that many equal rows, of which one stays

    def marked(which: DataFrame, how: str) -> DataFrame:
        on = docs["doc_id"].cast("bigint").eqNullSafe(which[d]) & (text_hash(docs["text"].cast("string")) == which[h])
        return docs.join(which, on, how)

    kept = marked(marks, "left_anti")
    repeated = marks.where(F.col(n) > 1)
    if repeated.isEmpty():
        return kept
    # combined before the shuffle, however many equal rows there are
    own = F.struct(F.xxhash64(*[F.to_json(F.struct(docs[f"`{c}`"])) for c in docs.columns]).alias("order"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    one = marked(repeated, "inner").groupBy(d, h).agg(F.min_by(own["row"], own["order"]).alias(p)).select(f"{p}.*")
    return kept.unionByName(one)
