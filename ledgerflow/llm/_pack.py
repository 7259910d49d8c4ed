"""Arrays as compressed bytes: columns of a block that cross the network as one value."""

from __future__ import annotations

import struct

import numpy as np
import zstandard as zstd


def pack(*arrays: np.ndarray) -> bytes:
    """Each array's byte planes one after another (equal high bytes compress to nothing)."""
    parts = [struct.pack("<B", len(arrays))]
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes()
        small = zstd.ZstdCompressor(level=1).compress(raw)
        parts.append(struct.pack("<2sqq", a.dtype.str[1:].encode(), len(a), len(small)) + small)
    return b"".join(parts)


def unpack(raw: bytes) -> list[np.ndarray]:
    out, at = [], 1
    for _ in range(raw[0]):
        kind, n, size = struct.unpack_from("<2sqq", raw, at)
        at += struct.calcsize("<2sqq")
        dtype = np.dtype("<" + kind.decode())
        planes = np.frombuffer(zstd.ZstdDecompressor().decompress(raw[at:at + size], max_output_size=max(1, n * dtype.itemsize)), np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).reshape(-1) if n else np.zeros(0, dtype))
        at += size
    return out


def pack_sorted(a: np.ndarray) -> np.ndarray:
    """Differences of a sorted array, for ``pack``; ``np.cumsum`` undoes it."""
    return np.diff(a, prepend=a.dtype.type(0))
