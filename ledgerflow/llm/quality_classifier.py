"""Quality classifier (operator 5) by compression: zstandard dictionaries built from good and from
bad labelled text; what each saves on a text, as a normalised size difference, is calibrated.

A text is cut into blocks of ``BLOCK`` bytes (all of them), each compressed by itself with either
dictionary, so that the dictionaries and not the text's own beginning explain it. With g and b the
two total sizes, the calibrated inputs are (b - g) / (b + g) and (b + g) / bytes; nothing but the
text is an input. Dictionaries and calibration are fitted on separate halves of a bounded sample
(``per_class`` rows of each class); the broadcast model is two dictionaries of ``DICT_BYTES``.

Defined results: the digests ignore other columns, whatever their
names, and filters return all of them; a null text is empty and gets the score that no evidence gives; a null doc_id is
passed through and is not held out; rows that repeat are scored each; an empty table gives no
rows; without labelled rows every score is 0.5, with one class it is that class's smoothed share."""

from __future__ import annotations

import binascii
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import _linear as linear
from ledgerflow.llm._frames import doc_texts
from ledgerflow.llm._labels import labelled_sample

FOLDS, HELD_OUT = 3, 1   # rows whose crc32(doc_id as text) mod 3 is 1 teach nothing
PER_CLASS = 900          # bound of the training sample: labelled rows of each class
BLOCK = 2048             # bytes compressed at a time
DICT_BYTES = 112 << 10   # size of a dictionary
LEVEL = 3

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"


def fold_of(doc_id: str | Column = "doc_id", folds: int = FOLDS) -> Column:
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % folds


def blocks_of(raw: bytes) -> list[bytes]:
    return [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]


def build_dictionary(texts: list[bytes]):
    """A zstandard dictionary trained on the blocks of the texts, or their raw content when there
    is too little to train on."""
    import zstandard as zstd
    blocks = [b for t in texts for b in blocks_of(t) if b]
    try:
        return zstd.train_dictionary(DICT_BYTES, blocks).as_bytes()
    except zstd.ZstdError:
        return b"".join(blocks)[:DICT_BYTES]


class Compressors:
    """The two prepared compressors of a worker."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as zstd
        self.pair = []
        for content in (good, bad):
            d = zstd.ZstdCompressionDict(content)
            d.precompute_compress(level=LEVEL)
            self.pair.append(zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False,
                                                 write_dict_id=False))

    def features(self, raw: bytes) -> tuple[float, float]:
        if not raw:
            return 0.0, 0.0
        cut = blocks_of(raw)
        good, bad = (sum(len(c.compress(x)) for x in cut) for c in self.pair)
        return 10.0 * (bad - good) / (bad + good), (bad + good) / (2.0 * len(raw))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    """Dictionaries of one half of the sample, calibration on the other."""
    rows = labelled_sample(docs, labels, per_class, fold_of() != HELD_OUT).select("text", "y").toArrow()
    # the sample has as many rows of either class; all training labels say how likely each is
    shares = labels.where((fold_of() != HELD_OUT) & F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    prior = min(0.99, max(0.01, 0.5 if shares is None else float(shares)))
    y = np.array(rows.column("y").to_pylist(), float)
    raw = [(t or "").encode() for t in rows.column("text").to_pylist()]
    if not len(y) or y.min() == y.max():
        return {"good": b"", "bad": b"", "cal": np.append(np.zeros(2), linear.calibrate(np.zeros((len(y), 0)), y)[-1] if len(y) else 0.0)}
    # the lists come in the order of a hash: every other row of each class
    half = np.zeros(len(y), bool)
    for k in (0, 1):
        half[np.flatnonzero(y == k)[::2]] = True
    good, bad = (build_dictionary([raw[i] for i in np.flatnonzero(half & (y == k))]) for k in (1, 0))
    held = np.flatnonzero(~half) if len(set(y[~half])) == 2 else np.arange(len(y))
    x = np.array([Compressors(good, bad).features(raw[i]) for i in held]) if good or bad else np.zeros((len(held), 2))
    return {"good": good, "bad": bad, "cal": linear.calibrate(x, y[held], prior)}


def quality_classifier(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        if "compressors" not in m:
            m["compressors"] = Compressors(m["good"], m["bad"])
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            x = np.array([m["compressors"].features(t or b"") for t in raw]).reshape(-1, 2)
            p = linear.sigmoid(x @ m["cal"][:2] + m["cal"][2])
            held = [i is not None and binascii.crc32(str(i).encode()) % FOLDS == HELD_OUT for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(held, pa.bool_()), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return doc_texts(docs).mapInArrow(score, SCHEMA)
