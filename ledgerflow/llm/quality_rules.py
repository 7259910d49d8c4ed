"""Quality rules (operator 4): fixed base rules, then a hashed word and character n-gram logistic
regression, probability-calibrated, against a fixed threshold.

* The model is fitted on a bounded sample of labelled rows (``per_class`` of each class, whole
  texts): features are hashed words, word pairs and trigrams of code points, each as a share of its text.
  Out-of-fold scores of two halves give the Platt calibration; the final weights use all of them.
* Scoring reads every whole text in Arrow batches of about 4 MB; one batch is one pass of array
  operations, with no shuffle. The broadcast model has a fixed size (3 x 2^16 floats).

Defined results: the digests ignore other columns, whatever their
names, and filters return all of them; a null text is empty (no words, base_failed, not kept); a null doc_id is passed
through; rows that repeat are each judged by themselves; an empty table gives no rows; without
labelled rows (or with one class) the model's verdict is that class, or keep when there is none."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerflow.llm import _linear as linear
from ledgerflow.llm import _text as tx
from ledgerflow.llm._frames import doc_texts, fresh
from ledgerflow.llm._labels import labelled_sample

DIMS = 1 << 16            # hash buckets of each of the three feature families
PER_CLASS = 700           # bound of the training sample: labelled rows of each class
MIN_WORDS = 10            # base rules: fewer words fail,
MAX_REPEAT_PERCENT = 20   # and more than so many percent of words in repeated 5-word windows
WINDOW = 5
MIN_PROBABILITY = 0.1     # fixed threshold on the calibrated probability of quality 1: clear junk goes, however few labels taught it
SYMBOLS = b"#*$%&|<>"
SCALE = 20.0              # shares of a text are small numbers; one factor for all features
SHRINK = 20               # added to a text's number of features: short texts say less

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, quality_probability double")


def salted(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that are only equal within one text."""
    return tx.mix(h + (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur twice or more."""
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    return twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys


def windows_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` consecutive symbols (also across texts: the caller masks those)."""
    n = max(0, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(tx.BASE) + h[k:k + n]
    return tx.mix(out)


def covered(hit: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window of ``width`` that starts at a hit."""
    at = np.flatnonzero(hit)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


class Batch:
    """What one batch of texts yields: base counts and hashed features."""

    def __init__(self, column):
        self.data, self.offsets = tx.utf8(column)
        self.starts, self.ends, self.first = tx.words(self.data, self.offsets)
        self.hash = tx.piece_hash(self.data, self.starts, self.ends)
        self.text = tx.text_index(self.first)
        ls, le, self.line_first = tx.lines(self.data, self.offsets)
        self.line_text = tx.text_index(self.line_first)
        has_word = np.searchsorted(self.starts, le) > np.searchsorted(self.starts, ls)
        self.line_keys = salted(tx.piece_hash(self.data, ls, le), self.line_text)[has_word]
        self.line_text = self.line_text[has_word]

    def base(self) -> dict[str, np.ndarray]:
        d, n_texts = self.data, len(self.offsets) - 1
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        n_words = np.diff(self.first)
        in_word = ~tx.white()[d] & ((d & 0xC0) != 0x80)
        _, firsts = np.unique(self.line_keys, return_index=True)
        again = np.ones(len(self.line_keys), np.int64)
        again[firsts] = 0
        win = windows_hash(self.hash, WINDOW)
        valid = self.text[:len(win)] == self.text[WINDOW - 1:WINDOW - 1 + len(win)]
        hit = np.zeros(len(win), bool)
        hit[valid] = repeated(salted(win[valid], self.text[:len(win)][valid]))
        n_repeat = tx.per_text(covered(hit, WINDOW, len(self.hash)), self.first)
        return {
            "n_words": n_words, "word_chars": tx.per_text(in_word, self.offsets),
            "n_symbols": tx.per_text(symbol[d], self.offsets),
            "n_dup_lines": np.bincount(self.line_text, again, n_texts).astype(np.int64),
            "n_repeat_words": n_repeat,
            "base_failed": (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words),
        }

    def families(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Each family's buckets, their text and the text's number of such features."""
        mask = np.uint64(DIMS - 1)
        n_texts = len(self.offsets) - 1
        yield (self.hash & mask).astype(np.int64), self.text, np.bincount(self.text, minlength=n_texts)
        pair = (self.text[1:] == self.text[:-1]) if len(self.text) else np.zeros(0, bool)
        both = tx.mix(self.hash[:-1] * np.uint64(3) + self.hash[1:])[pair] if len(pair) else np.zeros(0, np.uint64)
        at = self.text[:-1][pair] if len(pair) else np.zeros(0, np.int64)
        yield (both & mask).astype(np.int64) + DIMS, at, np.bincount(at, minlength=n_texts)
        code, sizes = tx.points(self.data, self.offsets)
        if len(code) < 3:
            return
        owner, code = np.repeat(np.arange(n_texts, dtype=np.int32), sizes), code.astype(np.uint64)
        gram = (code[:-2] << np.uint64(42)) | (code[1:-1] << np.uint64(21)) | code[2:]
        same = owner[2:] == owner[:-2]
        bucket = (tx.mix(gram[same]) & mask).astype(np.int64) + 2 * DIMS
        at = owner[:-2][same]
        yield bucket, at, np.bincount(at, minlength=n_texts)

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        n_texts = len(self.offsets) - 1
        out = np.full(n_texts, bias)
        for bucket, text, count in self.families():
            out += SCALE * np.bincount(text, weights[bucket], n_texts) / (count + SHRINK)
        return out


def sparse_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``y`` and the text's hashed features as two buffers (bucket int32, share float32)."""
    for batch in batches:
        b, rows = Batch(batch.column("text")), batch.num_rows
        parts: list[list[np.ndarray]] = [[] for _ in range(rows)]
        for bucket, text, count in b.families():
            cell, n = np.unique(text.astype(np.int64) * (3 * DIMS) + bucket, return_counts=True)
            owner, bucket = cell // (3 * DIMS), cell % (3 * DIMS)
            cut = np.searchsorted(owner, np.arange(rows + 1))
            share = SCALE * n / (count[owner] + SHRINK)
            for i in range(rows):
                parts[i].append((bucket[cut[i]:cut[i + 1]].astype(np.int32), share[cut[i]:cut[i + 1]].astype(np.float32)))
        cols = [np.concatenate([x[0] for x in p]).tobytes() if p else b"" for p in parts]
        vals = [np.concatenate([x[1] for x in p]).tobytes() if p else b"" for p in parts]
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(cols, pa.binary()), pa.array(vals, pa.binary())],
                                         names=["y", "cols", "vals"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    """The model: weights of the three families, bias, and the two calibration coefficients."""
    sample = labelled_sample(docs, labels, per_class).select("text", "y")
    rows = sample.mapInArrow(sparse_features, "y int, cols binary, vals binary").toArrow()
    y = np.array(rows.column("y").to_pylist(), float)
    if not len(y) or y.min() == y.max():
        odds = 0.0 if not len(y) else np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        return {"w": np.zeros(3 * DIMS, np.float32), "b": 0.0, "cal": np.array([0.0, odds])}
    cols = [np.frombuffer(x.as_py(), np.int32) for x in rows.column("cols")]
    vals = [np.frombuffer(x.as_py(), np.float32) for x in rows.column("vals")]

    def stacked(which):
        row = np.repeat(np.arange(len(which)), [len(cols[i]) for i in which])
        return row, np.concatenate([cols[i] for i in which]), np.concatenate([vals[i] for i in which])

    def scores(which, w, b):
        row, col, val = stacked(which)
        return np.bincount(row, w[col] * val, minlength=len(which)) + b

    fold = np.arange(len(y)) % 2  # rows come in the order of a hash
    out = np.zeros(len(y))
    for k in (0, 1):
        fit_on, held = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        w, b = linear.train(*stacked(fit_on), y[fit_on], 3 * DIMS)
        out[held] = scores(held, w, b)
    w, b = linear.train(*stacked(np.arange(len(y))), y, 3 * DIMS)
    return {"w": w.astype(np.float32), "b": b, "cal": linear.calibrate(out[:, None], y)}


def quality_rules(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
                  min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, the calibrated probability and
    ``kept`` (see the module's docstring)."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(docs, labels, per_class))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            b = Batch(batch.column("text"))
            base = b.base()
            p = linear.sigmoid(m["cal"][0] * b.logits(m["w"], m["b"]) + m["cal"][1])
            kept = ~base["base_failed"] & (p >= min_probability)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(base[c]) for c in list(base)], pa.array(kept), pa.array(p)],
                names=["doc_id", *base, "kept", "quality_probability"])

    return doc_texts(docs).mapInArrow(score, SCHEMA)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents (all their columns) that the rules keep: one pass over the rows themselves,
    so rows that repeat a doc_id, or have none, need no join back."""
    spark, names = docs.sparkSession, docs.columns
    model = spark.sparkContext.broadcast(fit(docs, labels, options.get("per_class", PER_CLASS)))
    least = options.get("min_probability", MIN_PROBABILITY)
    doc_texts(docs)  # bounds the batches
    judged = fresh(docs, "judged_text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            b = Batch(batch.column(batch.num_columns - 1))
            p = linear.sigmoid(m["cal"][0] * b.logits(m["w"], m["b"]) + m["cal"][1])
            mask = pa.array(~b.base()["base_failed"] & (p >= least))
            yield batch.select(range(batch.num_columns - 1)).filter(mask)

    wide = docs.select("*", docs["text"].cast("string").alias(judged))
    return wide.mapInArrow(keep, docs.schema).toDF(*names)
