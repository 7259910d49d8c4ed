"""Conversation structure repair (operator 13): Wagner-Fischer alignment of a conversation's turns to
the strings of its grammar, an optional system turn and then user-assistant pairs.

Edits: Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty user or assistant
turn, anywhere) 2; blank and duplicate turns must be deleted, and a truncated one that isn't deleted
adds 1. Of the cheapest edits those with the ASCII-least audit (the edits' initials in order) win.

* A target is one feasible length of the alternating string. Turns are aligned to every length whose
  lower bound reaches the incumbent, the nearest length first. Within an alignment, cells outside
  the Ukkonen band are left out: their least number of deletes and inserts before and after costs
  more than the incumbent has. Of each alignment the ASCII-least cheapest path is backtraced, and
  the audits are compared.
* Conversations are cut into blocks of ``BLOCK`` turns, so that bands stay narrow and the work grows
  with the turns and not with their square. A block is aligned from each of four states (nothing
  yet; a pair may begin or all end; an assistant turn must follow; a pair must follow the system
  turn), and what comes after costs by the state it leaves. Inserted turns belong to the turn behind
  them, so a block's audits are never prefixes of one another and the least audit of a block is the
  beginning of the least audit of all. Equal blocks are solved once in a worker's bounded cache.
* Damage is done by built-in functions. Turns are then dealt by conversation and sorted (one shuffle
  with the texts), and a task reads them as a stream: of the conversation at hand it holds some
  twenty bytes for each turn, as its audit, one value, does, while the texts wait in a file that
  spills to disk when they are long. The digest of a repaired conversation is one chain of all its
  text, so no more than one task can make it.

Defined results: null conv_id, turn, role and text are one space where they are text; rows without
conv_id are one conversation; an empty role counts as one space; an initial other than s, u or a
can't be kept, only reroled or deleted. Rows of the same turn come by role, then by text (UTF-8
bytes), so repeated rows stand side by side and the later ones are duplicates. Conversations without
rows after damage have zeros, an empty audit and the digest of nothing; an empty table gives no
rows; other columns, whatever their names, are ignored."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm._frames import BATCH_BYTES, bound_batches, ranges_for, shuffle_partitions

REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
BLOCK = 8
HELD_BYTES = 4 << 20       # texts of a conversation held in memory; more wait on disk
CACHE = 50_000             # solved blocks a worker remembers
WHITE = " \t\n\x0b\x0c\r"
FINE, BAD, OPEN = 0, 1, 2  # a turn's state: no fault, must be deleted, truncated
ROLES = {"u": "user", "a": "assistant"}
NEVER = 1 << 40

# What may follow: nothing has been given yet, a pair or the end, an assistant turn, a first pair.
START, PAIR, ANSWER, FIRST = range(4)
END = (0, 0, INSERT, 2 * INSERT)       # what it costs to end there
END_AUDIT = ("", "", "I", "II")

SCHEMA = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")


def alternating(first: str, length: int) -> str:
    other = "a" if first == "u" else "u"
    return "".join(first if i % 2 == 0 else other for i in range(length))


def targets(state: int, length: int) -> Iterator[tuple[str, int]]:
    """The strings of a length that may be given from a state, with the state they lead to."""
    if state == ANSWER:
        yield alternating("a", length), ANSWER if length % 2 == 0 else PAIR
    else:
        yield alternating("u", length), state if length == 0 else (PAIR if length % 2 == 0 else ANSWER)
    if state == START and length:
        yield "s" + alternating("u", length - 1), FIRST if length == 1 else (ANSWER if length % 2 == 0 else PAIR)


def least(turns: int, forced: int, length: int) -> int:
    """Lower bound for aligning so many turns, of which some must be deleted, to such a length."""
    free = turns - forced
    return DELETE * (forced + max(0, free - length)) + INSERT * max(0, length - free)


def align(block: tuple[tuple[str, int], ...], target: str, most: int) -> tuple[int, str] | None:
    """Least cost, if at most ``most``, and the ASCII-least such audit of aligning the block's turns
    to the target without an insert after the last turn."""
    n, m = len(block), len(target)
    forced = [0]
    for _, state in block:
        forced.append(forced[-1] + (state == BAD))
    rest: list[dict[int, int]] = [{} for _ in range(n + 1)]  # by turn: target place -> cost from there
    rest[n][m] = 0
    for i in range(n - 1, -1, -1):
        initial, state = block[i]
        here, below = rest[i], rest[i + 1]
        more = CUT_OFF if state == OPEN else 0
        for j in range(m, -1, -1):
            # the band: what is before this cell costs so much at least
            room = most - least(i, forced[i], j)
            if least(n - i, forced[n] - forced[i], m - j) > room:
                continue
            best = below.get(j, NEVER) + DELETE
            if j < m:
                if state != BAD:
                    step = 0 if initial == target[j] else (REROLE if target[j] != "s" else NEVER)
                    best = min(best, below.get(j + 1, NEVER) + step + more)
                if target[j] != "s":
                    best = min(best, here.get(j + 1, NEVER) + INSERT)
            if best <= room:
                here[j] = best
    if 0 not in rest[0]:
        return None
    audit, i, j = [], 0, 0
    while i < n:
        initial, state = block[i]
        left, more = rest[i][j], CUT_OFF if state == OPEN else 0
        if rest[i + 1].get(j, NEVER) + DELETE == left:  # in ASCII order: D, I, K, R
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and rest[i].get(j + 1, NEVER) + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if initial == target[j] and rest[i + 1].get(j + 1, NEVER) + more == left else "R")
            i, j = i + 1, j + 1
    return rest[0][0], "".join(audit)


def solve(block: tuple[tuple[str, int], ...], after: tuple[int, ...]) -> tuple[tuple[int, str, int], ...]:
    """For each state at the block's beginning: least cost up to the conversation's end, the block's
    ASCII-least audit of that cost and the state it leaves. ``after``: the cost by that state."""
    n, forced = len(block), sum(s == BAD for _, s in block)
    out = []
    for state in range(4):
        best: tuple[int, str, int] | None = None
        # the nearest lengths first: their incumbent narrows the bands of the others
        for length in sorted(range(0, 2 * n + 4), key=lambda x: (abs(x - (n - forced)), x)):
            for target, leaves in targets(state, length):
                most = (NEVER if best is None else best[0]) - after[leaves]
                if least(n, forced, length) > most:
                    continue
                found = align(block, target, most)
                if found is None:
                    continue
                new = (found[0] + after[leaves], found[1], leaves)
                if best is None or new[:2] < best[:2]:
                    best = new
        out.append(best)
    return tuple(out)


def repair(turns: list[tuple[str, int]], solver: Callable = solve) -> tuple[int, str]:
    """Cost and audit of a conversation of (role's initial, state) turns."""
    blocks = [tuple(turns[i:i + BLOCK]) for i in range(0, len(turns), BLOCK)]
    after, paid, ways = END, 0, []
    for block in reversed(blocks):
        way = solver(block, after)
        low = min(w[0] for w in way)
        ways.append(way)
        after, paid = tuple(w[0] - low for w in way), paid + low
    state, audit = START, []
    for way in reversed(ways):
        audit.append(way[state][1])
        state = way[state][2]
    return paid + after[START], "".join(audit) + END_AUDIT[state]


def given_roles(audit: str) -> Iterator[str]:
    """The target's initials, one for each edit that gives a turn."""
    n = len(audit) - audit.count("D")
    return iter(("s" if n % 2 else "") + alternating("u", n - n % 2))


class Conversation:
    """What a task holds of the conversation it reads."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.initials, self.faults = conv_id, [], bytearray()
        self.digests, self.sizes = bytearray(), []
        self.low = self.high = self.last_turn = None
        self.distinct = 0
        self.texts = tempfile.SpooledTemporaryFile(max_size=HELD_BYTES)  # noqa: SIM115

    def add(self, turn: int | None, role: str, text: str) -> None:
        role = role or " "
        if turn is not None and (self.low is None or turn != self.last_turn):
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
            self.distinct += 1
        solid = text.strip(WHITE)
        self.initials.append(role[0])
        self.faults.append(BAD if not solid else (FINE if solid[-1] in ".!?" else OPEN))
        head, body = role.encode(), text.encode()
        self.digests += hashlib.blake2b(len(head).to_bytes(4, "little") + head + body, digest_size=16).digest()
        self.sizes.append((len(head), len(body)))
        self.texts.write(head + b":" + body)

    def result(self, solver: Callable) -> tuple:
        states = np.frombuffer(bytes(self.faults), np.uint8).copy()
        n, blank = len(states), int((states == BAD).sum())
        keys = np.frombuffer(bytes(self.digests), np.uint64).reshape(n, 2)
        order = np.lexsort((np.arange(n), keys[:, 1], keys[:, 0]))
        again = np.zeros(n, bool)
        again[order[1:]] = (keys[order[1:]] == keys[order[:-1]]).all(1)
        again &= states != BAD
        states[again] = BAD
        pairs = zip(self.initials[:-1], self.initials[1:], strict=True)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
        cost, audit = repair(list(zip(self.initials, states.tolist(), strict=True)), solver)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv_id, gaps, blank, int(again.sum()), int((states == OPEN).sum()), illegal, cost, audit, self.repaired(audit))

    def repaired(self, audit: str) -> str:
        """Digest of the repaired conversation, its texts read once more in order."""
        sha, roles, first, rows = hashlib.sha256(), given_roles(audit), True, iter(self.sizes)
        self.texts.seek(0)
        for edit in audit:
            head = body = b""
            if edit != "I":
                size = next(rows)
                head = self.texts.read(size[0])
                body = self.texts.read(1 + size[1])[1:]
            if edit == "D":
                continue
            role = next(roles)
            name = head if edit == "K" else ROLES[role].encode()
            sha.update((b"" if first else b"\n") + name + b":" + body)
            first = False
        return sha.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: the rows after damage, and those it drops (without text),
    so that no conversation is lost."""
    def words(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), words("role").alias("role"), words("text").alias("text"),
        (F.crc32(F.concat(words("conv_id"), F.lit(":"), words("turn"))) % 20).alias("harm"))
    text = (F.when(F.col("harm").isin(0, 1), F.lit("")).when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    copies = F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.select("conv_id", "turn", F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                        (F.col("harm") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy"))


def read_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results from rows sorted by conversation and order."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    at: Conversation | None = None
    out: list[tuple] = []
    solved = lru_cache(CACHE)(solve)

    def flush():
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")]
        for conv_id, turn, role, text, gone in zip(*columns, strict=True):
            if at is None or at.conv_id != conv_id:
                if at is not None:
                    out.append(at.result(solved))
                at = Conversation(conv_id)
            if not gone:
                at.add(turn, role, text)
            if len(out) >= 2000:
                yield flush()
                out.clear()
    if at is not None:
        out.append(at.result(solved))
    if out:
        yield flush()


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row for every conversation (see the module's docstring)."""
    spark = conversations.sparkSession
    bound_batches(spark, BATCH_BYTES)
    n = max(shuffle_partitions(spark), ranges_for(conversations.select(F.col("text").cast("string").alias("text"))))
    rows = damaged(conversations).repartition(n, "conv_id")
    return rows.sortWithinPartitions("conv_id", "gone", "turn", "role", "text").mapInArrow(read_conversations, SCHEMA)
