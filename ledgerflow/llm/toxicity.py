"""Toxicity (operator 11): a linear classifier over character n-grams whose features are scaled by
naive Bayes log-count ratios, trained on labelled text.

* A text is read as code points, letters in lower case; every run of ASCII characters that are not
  letters is one boundary, and a boundary stands at both ends. Its features are which n-grams of 3
  to 6 code points occur in it (hashed to 2^20 buckets), wherever in the whole text.
* A bucket's ratio is the logarithm of how much likelier a toxic text is to have it than another
  one (add-half counts). A ratio within ``MIN_Z`` of its own standard errors of zero counts as zero:
  rare n-grams, of which a long text has thousands, then say nothing. The weights are a logistic
  regression on the scaled features.
* Training rows are a bounded sample (``per_class`` of each class, whole texts). Tasks find their
  n-grams once and add up the counts; the driver gets counts by bucket (at most 2^20 rows) and, of
  each row, the buckets whose ratio isn't zero. Out-of-fold scores of two halves, ratios included,
  give the calibration, with the share of toxic rows among all training labels as prior.
* Scoring is one pass over whole texts in Arrow batches, without a shuffle; the broadcast model is
  2^20 floats.

Defined results: a null text is empty and gets the score that no feature gives; a null doc_id is
passed through and is not held out; rows that repeat are scored each; labels that are null or
neither 0 nor 1 teach nothing, conflicting labels of one doc_id teach both; other columns of either
table, whatever their names, are ignored; an empty table gives no rows; without labelled rows every
score is 0.5, with one class that class's smoothed share. Scores have no ties to break."""

from __future__ import annotations

import binascii
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import _linear as linear
from ledgerflow.llm import _text as tx
from ledgerflow.llm._frames import doc_texts, shuffle_partitions
from ledgerflow.llm._graph import cut
from ledgerflow.llm._labels import labelled_sample
from ledgerflow.llm._pack import pack, pack_sorted, unpack

FOLDS, HELD_OUT = 4, 2    # rows whose crc32(doc_id as text) mod 4 is 2 teach nothing
THRESHOLD = 0.3
PER_CLASS = 2500          # bound of the training sample: labelled rows of each class
SIZES = (3, 4, 5, 6)      # code points of an n-gram
BITS = 20
DIMS = 1 << BITS
MIN_Z = 3.5               # standard errors that a log-count ratio must differ from zero
SMOOTH = 0.5
TRAIN = {"steps": 100, "rate": 0.05, "l2": 1e-2}

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"


def fold_of(doc_id: Column | None = None) -> Column:
    doc_id = F.col("doc_id") if doc_id is None else doc_id
    return F.crc32(doc_id.cast("bigint").cast("string")) % FOLDS


def folding() -> np.ndarray:
    """Code point (below 2^16) to its lower case, ASCII characters that aren't letters to a space."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        low = chr(i).lower()
        if len(low) == 1 and ord(low) < 1 << 16:
            table[i] = ord(low)
    table[[i for i in range(128) if not chr(i).isalpha()]] = 32
    return table


FOLDING: list[np.ndarray] = []  # made once in a worker


def code_points(column) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of all texts, each between two boundaries, and the text of each."""
    if not FOLDING:
        FOLDING.append(folding())
    points, sizes = tx.points(*tx.utf8(column))
    points = np.where(points < 1 << 16, FOLDING[0][np.minimum(points, (1 << 16) - 1)], points)
    n = len(sizes)
    text = np.repeat(np.arange(n), sizes + 2)
    out = np.full(len(text), 32, np.uint32)
    ends = np.cumsum(sizes + 2)
    inner = np.ones(len(text), bool)
    inner[ends - 1] = inner[ends - sizes - 2] = False
    out[inner] = points
    space = out == 32
    single = np.ones(len(out), bool)
    single[1:] = ~(space[1:] & space[:-1] & (text[1:] == text[:-1]))
    return out[single].astype(np.uint64), text[single]


def ngrams(column, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs in that order; of the ``wanted`` buckets only, if given."""
    points, text = code_points(column)
    cells = []
    h = np.zeros(len(points), np.uint64)
    for k in range(max(SIZES)):
        h = h[:len(points) - k] if k <= len(points) else h[:0]
        h = h * np.uint64(0x9E3779B97F4A7C15) + points[k:]
        if k + 1 in SIZES and len(h):
            mixed = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(k)
            bucket = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64)
            use = text[:len(h)] == text[k:]
            if wanted is not None:
                use &= wanted[bucket]
            cells.append((text[:len(h)][use] << BITS) | bucket[use])
    cells = np.unique(np.concatenate(cells)) if cells else np.zeros(0, np.int64)
    return cells >> BITS, cells & (DIMS - 1)


def row_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part`` (class + 2 * half) and the row's sorted buckets, packed."""
    for batch in batches:
        text, bucket = ngrams(batch.column("text"))
        at = np.searchsorted(text, np.arange(batch.num_rows + 1))
        packed = [pack(pack_sorted(bucket[a:b].astype(np.int32))) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(packed, pa.binary())], names=["part", "buckets"])


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's number of rows with each bucket, by part."""
    total = np.zeros((4, DIMS), np.int64)
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("buckets").to_pylist(), strict=True):
            total[part, np.cumsum(unpack(raw)[0])] += 1
    some = np.flatnonzero(total.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(total[i, some]) for i in range(4)]],
                                     names=["bucket", "n0", "n1", "n2", "n3"])


def ratios(count: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log-count ratios of buckets from (2, buckets) row counts of the two classes and their rows."""
    p = (count + SMOOTH) / (rows[:, None] + 2 * SMOOTH)
    r = np.log(p[1]) - np.log(p[0])
    error = np.sqrt(((1 - p) / (np.maximum(rows, 1)[:, None] * p)).sum(0))
    return np.where(np.abs(r) > MIN_Z * error, r, 0.0).astype(np.float32)


class Linear:
    """Ratios and weights from the rows ``which`` of the sample."""

    def __init__(self, ratio: np.ndarray, found: list[np.ndarray], y: np.ndarray, which: np.ndarray):
        self.ratio, self.found = ratio, found
        used = np.flatnonzero(ratio)
        place = np.zeros(DIMS, np.int64)
        place[used] = np.arange(len(used))
        row, col, val = self.stacked(which)
        w, self.bias = linear.train(row, place[col], val, y[which], max(1, len(used)), **TRAIN)
        self.weights = np.zeros(DIMS, np.float32)
        self.weights[used] = w[:len(used)] * ratio[used]

    def stacked(self, which):
        row = np.repeat(np.arange(len(which)), [len(self.found[i]) for i in which])
        col = np.concatenate([self.found[i] for i in which]) if len(which) else np.zeros(0, np.int64)
        use = self.ratio[col] != 0
        return row[use], col[use], self.ratio[col[use]]

    def score(self, which) -> np.ndarray:
        row, col, _ = self.stacked(which)
        return np.bincount(row, self.weights[col], len(which)) + self.bias


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    """``w`` (weight times ratio of every bucket), ``b`` and the two calibration coefficients."""
    spark = docs.sparkSession
    mine = (F.col("doc_id").isNotNull()) & (fold_of() != HELD_OUT)
    shares = labels.where(mine & F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0]
    prior = min(0.99, max(0.01, 0.5 if shares is None else float(shares)))
    half = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(2))
    sample = labelled_sample(docs, labels, per_class, mine, "toxic").select("text", (F.col("y") + 2 * half).cast("int").alias("part"))
    # the sample comes as one sorted part
    rows = cut(sample.repartition(shuffle_partitions(spark)).mapInArrow(row_features, "part int, buckets binary"))
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(4)]
    counted = rows.mapInArrow(add_up, "bucket bigint, n0 bigint, n1 bigint, n2 bigint, n3 bigint").groupBy("bucket").agg(*sums).toArrow()
    size = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = np.array([size.get(i, 0) for i in range(4)], float).reshape(2, 2)  # half, class
    if not n.sum(0).all():
        odds = 0.0 if not n.sum() else np.log((n.sum(0)[1] + 1) / (n.sum(0)[0] + 1))
        return {"w": np.zeros(DIMS, np.float32), "b": 0.0, "cal": np.array([0.0, odds])}
    count = np.zeros((2, 2, DIMS))
    for i in range(4):
        count[i // 2, i % 2, counted.column("bucket").to_numpy()] = counted.column(f"n{i}").to_numpy()
    both = ratios(count.sum(0), n.sum(0))
    by_half = [ratios(count[1 - k], n[1 - k]) for k in (0, 1)]  # learnt from the other half
    wanted = spark.sparkContext.broadcast((both != 0) | (by_half[0] != 0) | (by_half[1] != 0))

    def wanted_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.cumsum(unpack(raw)[0]) for raw in batch.column("buckets").to_pylist()]
            found = [f[wanted.value[f]].astype("<i4").tobytes() for f in found]
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(found, pa.binary())], names=["part", "buckets"])

    kept = rows.mapInArrow(wanted_only, "part int, buckets binary").toArrow()
    part = kept.column("part").to_numpy()
    found = [np.frombuffer(x.as_py(), "<i4").astype(np.int64) for x in kept.column("buckets")]
    y, every = (part % 2).astype(float), np.arange(len(part))
    out = np.zeros(len(part))
    for k in (0, 1):
        others = np.flatnonzero(part // 2 != k)
        held = np.flatnonzero(part // 2 == k)
        out[held] = Linear(by_half[k], found, y, others).score(held)
    model = Linear(both, found, y, every)
    return {"w": model.weights, "b": model.bias, "cal": linear.calibrate(out[:, None], y, prior)}


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document (see the module's docstring)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        wanted = m["w"] != 0
        for batch in batches:
            text, bucket = ngrams(batch.column("text"), wanted)
            z = np.bincount(text, m["w"][bucket], batch.num_rows) + m["b"]
            p = linear.sigmoid(m["cal"][0] * z + m["cal"][1])
            held = [i is not None and binascii.crc32(str(i).encode()) % FOLDS == HELD_OUT for i in batch.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(held, pa.bool_()), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return doc_texts(docs).mapInArrow(score, SCHEMA)
