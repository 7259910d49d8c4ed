"""Byte kernels over Arrow batches of texts (numpy, run inside tasks).

A batch's texts are one UTF-8 buffer with offsets; words, lines and hashes are found for the whole
batch at once. Word = ``[^\\x20\\x09-\\x0D]+``. Words and lines are hashed to 64 bits by the sum of a
mixed value of each byte and its place (``piece_hash``); windows of a few dozen symbols slide under a
polynomial modulo 2^64 with an odd base (``span_hash``, not for long spans: such a polynomial has
known equal values from 1024 symbols on). Equal strings hash equally in every task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E6C63D0676A9A99  # odd, so it has an inverse modulo 2^64
BASE_INV = pow(BASE, -1, 1 << 64)


def white() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    o = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]], o - o[0]


def runs_of(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of kept bytes that don't cross ``offsets``."""
    n = len(keep)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = keep.copy(), keep.copy()
    first[1:] &= ~keep[:-1]
    last[:-1] &= ~keep[1:]
    a, b = offsets[:-1], offsets[1:]
    full = b > a
    first[a[full]] = keep[a[full]]
    last[b[full] - 1] = keep[b[full] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text (plus one) the index of its first word."""
    s, e = runs_of(~white()[data], offsets)
    return s, e, np.searchsorted(s, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the ``\\n``-split lines of each text (an empty text has one empty line),
    and for each text (plus one) the index of its first line."""
    at = np.flatnonzero(data == 10)
    doc = np.searchsorted(offsets, at, side="right") - 1
    n_lines = np.bincount(doc, minlength=len(offsets) - 1) + 1 if len(offsets) > 1 else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(n_lines)]).astype(np.int64)
    starts, ends = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    own = np.zeros(first[-1], bool)
    own[first[:-1]] = True
    starts[own] = offsets[:-1]
    starts[~own] = at + 1
    own = np.zeros(first[-1], bool)
    own[first[1:] - 1] = True
    ends[own] = offsets[1:]
    ends[~own] = at
    return starts, ends, first


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: int = BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = sum over i <= k < j of (symbols[k] + 1) * BASE^k, modulo 2^64."""
    terms = (symbols.astype(np.uint64) + np.uint64(1)) * powers(len(symbols))
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(terms, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, shift: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of spans, from ``prefix_hash``; equal spans have equal hashes."""
    shift = powers(len(prefix), BASE_INV) if shift is None else shift
    return mix((prefix[ends] - prefix[starts]) * shift[starts] + (ends - starts).astype(np.uint64))


def piece_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of disjoint spans in their order: each byte adds a mixed value of itself and of
    its place in the span. Hashes of two seeds are independent."""
    size = ends - starts
    first = np.append(0, np.cumsum(size))
    place = np.arange(first[-1]) - np.repeat(first[:-1], size)
    byte = data[place + np.repeat(starts, size)]
    salt = np.uint64(seed * 0xA0761D6478BD642F & (1 << 64) - 1)
    terms = mix(((place.astype(np.uint64) + np.uint64(1)) << np.uint64(8) | byte) + salt)
    total = np.zeros(first[-1] + 1, np.uint64)
    np.cumsum(terms, out=total[1:])
    return mix(total[first[1:]] - total[first[:-1]] + size.astype(np.uint64) * np.uint64(BASE))


def points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and how many each has (bytes that are not UTF-8 are replaced)."""
    raw = data.tobytes()
    try:
        return np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32), per_text((data & 0xC0) != 0x80, offsets)
    except UnicodeDecodeError:
        texts = [raw[a:b].decode(errors="replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.array([len(t) for t in texts], np.int64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (log-many passes)."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (width - have)], out[width - have:]) if have < width else out


def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` over each text's slice ``first[i]:first[i+1]``."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def text_index(first: np.ndarray) -> np.ndarray:
    """For each element the index of the text it belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
