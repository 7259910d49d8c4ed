"""External induced suffix sorting, with common prefixes (numpy; runs inside a task).

``suffix_order(text, cap)`` sorts all suffixes of an integer text by induction, as suffix-array
construction by induced sorting does, and carries the common prefixes of neighbours along, cut at
``cap``. Every bucket (a first symbol) is a queue of suffix tuples: position and common prefix with
the tuple before it. Buckets are read in order and each read tuple puts its predecessor into the
queue of the preceding symbol, so the queues together are a priority queue whose keys only grow.

* A queue's tuples beyond a memory budget are written to an unnamed temporary file of the task, as
  Spark's own sorts do: nothing but the task reads it, it vanishes with the task, and a task that is
  tried again makes it anew.
* The first induction sorts the substrings between left-most S positions; equal ones get one name,
  and the order of the reduced text of names is found recursively (``names_order``), at most until
  ``cap`` symbols are compared, since what agrees that far need not be told apart.
* The second induction yields all suffixes. The common prefix of two pushed tuples is one more than
  the least of those between their sources, which a table of range minima over the bucket gives."""

from __future__ import annotations

import tempfile

import numpy as np

from ledgerflow.llm import _text as tx

MEMORY = 192 << 20  # bytes of queued tuples kept in memory by one sort


class Queues:
    """One queue of (position, common prefix) chunks for each symbol."""

    def __init__(self, n: int, memory: int = MEMORY):
        self.chunks: list[list] = [[] for _ in range(n)]
        self.memory, self.held, self.file = memory, 0, None

    def push(self, symbol: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.held += pos.nbytes + lcp.nbytes
        if self.held > self.memory:
            self.spill()
        self.chunks[symbol].append((pos, lcp))

    def spill(self) -> None:
        """Writes all chunks in memory to the file and keeps their places."""
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for queue in self.chunks:
            for i, c in enumerate(queue):
                if isinstance(c[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(c[0].tobytes())
                    self.file.write(c[1].tobytes())
                    queue[i] = (at, len(c[0]))
        self.held = 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """The whole queue of a symbol, in order; it is empty afterwards."""
        pos, lcp = [np.zeros(0, np.int32)], [np.zeros(0, np.uint8)]
        for a, b in self.chunks[symbol]:
            if isinstance(a, np.ndarray):
                self.held -= a.nbytes + b.nbytes
            else:
                self.file.seek(a)
                raw, n = self.file.read(5 * b), b
                a, b = np.frombuffer(raw, np.int32, n), np.frombuffer(raw, np.uint8, n, 4 * n)
            pos.append(a)
            lcp.append(b)
        self.chunks[symbol] = []
        return np.concatenate(pos), np.concatenate(lcp)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class RangeMin:
    """Least value of any stretch of an array of small numbers."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(values) > 1 << len(self.levels):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Over lo..hi, both included, lo <= hi."""
        size = hi - lo + 1
        level = np.frexp(size)[1] - 1
        out = np.empty(len(lo), np.uint8)
        for k in np.unique(level):
            m = level == k
            out[m] = np.minimum(self.levels[k][lo[m]], self.levels[k][hi[m] + 1 - (1 << int(k))])
        return out


def stype(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one after them; the last symbol is the least of all."""
    up = np.zeros(len(text), np.int8)
    up[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1])
    up[-1] = 1
    # an equal neighbour has the type of the next differing one
    at = np.where(up != 0, np.arange(len(text)), len(text))
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    return up[nxt] > 0


def run_length(text: np.ndarray) -> np.ndarray:
    """For each position how many equal symbols begin there."""
    end = np.where(np.append(text[1:] != text[:-1], True), np.arange(len(text)), len(text))
    return np.minimum.accumulate(end[::-1])[::-1] - np.arange(len(text)) + 1


def push_all(queues: Queues, text, pos, lcp, wanted, cap) -> None:
    """Puts the predecessors of a bucket's tuples (``wanted``: which, by index) into their queues."""
    if not len(wanted):
        return
    prev = pos[wanted] - 1
    symbol = text[prev]
    order = np.argsort(symbol, kind="stable")
    src, symbol = wanted[order], symbol[order]
    first = np.append(True, symbol[1:] != symbol[:-1])
    carried = np.ones(len(src), np.uint8)  # a new source bucket: the symbols after the first differ
    later = np.flatnonzero(~first) if cap else ()
    if len(later):
        carried[later] = np.minimum(RangeMin(lcp).of(src[later - 1] + 1, src[later]).astype(np.int64) + 1, cap)
    edge = np.append(np.flatnonzero(first), len(src))
    prev = prev[order].astype(np.int32)
    for i, j in zip(edge[:-1], edge[1:], strict=True):
        queues.push(int(symbol[i]), prev[i:j], carried[i:j])


def bucket(pos, lcp, text, symbol, types, want: bool, cap):
    """A bucket's tuples of one type: those queued, then round by round their predecessors with the
    same symbol. Between rounds the runs of the symbol differ in length by one."""
    if len(lcp):
        lcp = lcp.copy()
        lcp[0] = 0
    all_pos, all_lcp, n_round = [pos], [lcp], 1
    while len(pos):
        prev = pos - 1
        ok = np.flatnonzero(prev >= 0)
        ok = ok[(text[prev[ok]] == symbol) & (types[prev[ok]] == want)]
        if not len(ok):
            break
        carried = np.zeros(len(ok), np.uint8)
        carried[0] = min(n_round, cap)
        if len(ok) > 1 and cap:
            carried[1:] = np.minimum(RangeMin(lcp).of(ok[:-1] + 1, ok[1:]).astype(np.int64) + 1, cap)
        pos, lcp = prev[ok], carried
        all_pos.append(pos)
        all_lcp.append(lcp)
        n_round += 1
    return np.concatenate(all_pos), np.concatenate(all_lcp)


def induce(text: np.ndarray, types: np.ndarray, runs: np.ndarray, lms: np.ndarray, lms_lcp: np.ndarray, cap: int, memory: int):
    """All suffixes and their common prefixes with the one before, from the order of the left-most S
    positions ``lms`` (``lms_lcp``: common prefixes, 0 where the first symbol changes). With a ``cap``
    of 0 the order alone is made."""
    n_symbols = int(text.max()) + 1
    edge = np.searchsorted(text[lms], np.arange(n_symbols + 1))
    queues, l_parts = Queues(n_symbols, memory), Queues(n_symbols, memory)
    try:
        for c in range(n_symbols):
            seed, seed_lcp = lms[edge[c]:edge[c + 1]], lms_lcp[edge[c]:edge[c + 1]]
            pos, lcp = queues.pop(c)
            if not len(pos) and not len(seed):
                continue
            pos, lcp = bucket(pos, lcp, text, c, types, False, cap)
            if len(pos):
                l_parts.push(c, pos.astype(np.int32), lcp)
            if len(seed):
                joint = seed_lcp.copy()
                joint[0] = min(int(runs[pos[-1]]), int(runs[seed[0]]), cap) if len(pos) else 0
                pos, lcp = np.concatenate([pos, seed]), np.concatenate([lcp, joint])
            prev = pos - 1
            wanted = np.flatnonzero((prev >= 0) & (text[prev] > c))
            push_all(queues, text, pos, lcp, wanted[~types[prev[wanted]]], cap)
        done = []
        for c in range(n_symbols - 1, -1, -1):
            large, large_lcp = queues.pop(c)  # S suffixes, the largest first
            l_pos, l_lcp = l_parts.pop(c)
            last = c == 0 and not len(large)
            if last:
                large, large_lcp = np.array([len(text) - 1], np.int32), np.zeros(1, np.uint8)
            large, large_lcp = bucket(large, large_lcp, text, c, types, True, cap)
            # L suffixes backwards: each one's common prefix is with the larger neighbour
            down = l_pos[::-1]
            down_lcp = np.empty(len(l_pos), np.uint8)
            if len(l_pos):
                down_lcp[0] = min(int(runs[large[-1]]), int(runs[l_pos[-1]]), cap) if len(large) else 0
                down_lcp[1:] = l_lcp[1:][::-1]
            pos, lcp = np.concatenate([large, down]), np.concatenate([large_lcp, down_lcp])
            if not len(pos):
                continue
            prev = pos - 1
            wanted = np.flatnonzero((prev >= 0) & (text[prev] < c))
            push_all(queues, text, pos, lcp, wanted[types[prev[wanted]]], cap)
            # ascending: the common prefix moves to the larger one of two neighbours
            up_lcp = np.zeros(len(pos), np.uint8)
            up_lcp[1:] = lcp[1:][::-1]
            done.append((pos[::-1], up_lcp))
        done.reverse()
        return np.concatenate([x[0] for x in done]), np.concatenate([x[1] for x in done])
    finally:
        queues.close()
        l_parts.close()


def names_order(names: np.ndarray, length: np.ndarray, cap: int) -> np.ndarray:
    """Order of the suffixes of the reduced text: names are doubled (a suffix's rank and the rank of
    the suffix after as many names) until all differ or ``cap`` symbols are compared."""
    rank, step, n = names.astype(np.int64), 1, len(names)
    covered = np.minimum(length, cap).astype(np.int64)
    while step < n:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (n + 1) + after
        distinct, rank = np.unique(key, return_inverse=True)
        more = np.zeros(n, np.int64)
        more[:-step] = covered[step:]
        covered = np.minimum(covered + more, cap)
        step *= 2
        if len(distinct) == n or covered[:-step].min(initial=cap) >= cap:
            break
    return np.argsort(rank, kind="stable")


def common_prefix(prefix: np.ndarray, shift: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int, n: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, by halving on hashes of their first symbols."""
    have = np.zeros(len(a), np.int64)
    step = 1 << (cap.bit_length() - 1)
    while step:
        size = have + step
        ok = np.flatnonzero((size <= cap) & (a + size <= n) & (b + size <= n))
        x, y, s = a[ok], b[ok], size[ok]
        same = (prefix[x + s] - prefix[x]) * shift[x] == (prefix[y + s] - prefix[y]) * shift[y]
        have[ok[same]] += step
        step >>= 1
    return have.astype(np.uint8)


def suffix_order(text: np.ndarray, cap: int, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all suffixes in order (those that agree on ``cap`` symbols in any order among
    themselves), and the common prefix of each with the one before it, cut at ``cap``."""
    if not 0 < cap < 255:
        raise ValueError("common prefixes are kept in a byte")
    text = np.append(text.astype(np.int32) + 1, 0).astype(np.int32)  # the last symbol is the least
    types, runs = stype(text), run_length(text)
    lms = np.flatnonzero(types[1:] & ~types[:-1]).astype(np.int32) + 1
    if len(lms) == 1:
        order = lms
        lcp = np.zeros(1, np.uint8)
    else:
        # first induction: any order within a symbol sorts the substrings between them
        seed = lms[np.argsort(text[lms], kind="stable")]
        some, _ = induce(text, types, runs, seed, np.zeros(len(seed), np.uint8), 0, memory)
        is_lms = np.zeros(len(text), bool)
        is_lms[lms] = True
        some = some[is_lms[some]]
        number = np.full(len(text), -1, np.int32)
        number[lms] = np.arange(len(lms))
        ends = np.append(lms[1:], lms[-1]) + 1
        prefix = tx.prefix_hash(text)
        shift = tx.powers(len(prefix), tx.BASE_INV)
        piece = tx.span_hash(prefix, lms, np.minimum(ends, len(text)), shift)
        own = number[some]
        name = np.empty(len(lms), np.int64)
        name[own] = np.cumsum(np.append(0, piece[own][1:] != piece[own][:-1]))
        by = names_order(name, np.diff(np.append(lms, len(text))), cap + 1) if name.max() + 1 < len(lms) else np.argsort(name)
        order = lms[by]
        lcp = np.zeros(len(order), np.uint8)
        lcp[1:] = common_prefix(prefix, shift, order[:-1].astype(np.int64), order[1:].astype(np.int64), cap, len(text))
        del prefix, shift, piece
    pos, lcp = induce(text, types, runs, order, lcp, cap, memory)
    return pos[1:], lcp[1:]  # without the suffix that is only the end
