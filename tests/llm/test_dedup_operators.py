"""Dedup operators (2, 3, 8, 9) against brute force."""

import hashlib
import os
import random
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from ledgerflow.llm import _text as tx
from ledgerflow.llm import line_dedup, quality_rules, simhash, substring_dedup, suffix_dedup
from ledgerflow.llm._induced import suffix_order

REPO = Path(__file__).resolve().parents[2]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\x0b\x0c\r"
INF = float("inf")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def order(i):
    return INF if i is None else i


@pytest.fixture(scope="module")
def rows(odd_rows):
    """Overlapping pieces of a few sentences, whole copies and periodic texts."""
    rnd = random.Random(7)
    words = [f"word{i}" for i in range(400)]
    base = [" ".join(rnd.choices(words, k=120)) for _ in range(6)]
    out = list(odd_rows)
    for i in range(40, 100):
        src = rnd.choice(base).split()
        a = rnd.randrange(60)
        piece = src[a:a + rnd.randrange(20, 60)]
        if rnd.random() < 0.5:
            piece.insert(rnd.randrange(len(piece)), "CHANGED")
        out.append((i, rnd.choice(["", "Some start \n"]) + " ".join(piece) + rnd.choice(["", "\nAll rights reserved.", "\n all RIGHTS reserved. "])))
    out += [(200, "ab " * 300), (201, "ab " * 200 + "end"), (202, "x" * 49), (203, "x" * 50), (204, "x" * 51)]
    return out


def got_rows(df, cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def brute_lines(rows):
    def key(line):
        return lower(line.strip(BLANK))

    owner, holders = {}, {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= 10:
                owner[k] = min(owner.get(k, INF), order(i))
                holders.setdefault(k, set()).add(i)
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(holders[key(x)]) > 1 and owner[key(x)] != order(i))]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


def test_line_dedup(make_docs, rows):
    want = Counter((i, n, d, sha(t.encode())) for i, n, d, t in brute_lines(rows))
    assert sum(k[2] > 0 for k in want) > 5
    assert got_rows(line_dedup.line_digest(make_docs(rows)), ("doc_id", "n_lines", "n_dropped", "kept_sha256")) == want


def test_dropping_lines_keeps_columns(make_docs, rows):
    docs = make_docs(rows).withColumnsRenamed({"lang": "line_masks", "source": "mask_doc"})
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"] or "") for r in out.collect()) == Counter((i, t) for i, _, _, t in brute_lines(rows))


def test_substring_dedup(make_docs, rows):
    width, words = 35, [(i, WORD.findall(t or "")) for i, t in rows]
    count = Counter(tuple(w[j:j + width]) for _, w in words for j in range(len(w) - width + 1))
    want = Counter()
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if count[tuple(w[j:j + width])] > 1:
                gone[j:j + width] = [True] * width
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        want[i, len(w), sum(gone), sha(" ".join(kept).encode())] += 1
    assert got_rows(substring_dedup.substring_digest(make_docs(rows)), ("doc_id", "n_words", "n_removed", "kept_sha256")) == want


def test_suffix_dedup(make_docs, rows):
    width, first, want = 50, {}, Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for j in range(len(b) - width + 1):
            first[b[j:j + width]] = min(first.get(b[j:j + width], INF), order(i))
    for i, b in raw:
        gone = bytearray(len(b))
        for j in range(len(b) - width + 1):
            if first[b[j:j + width]] < order(i):
                gone[j:j + width] = b"\1" * width
        spans = len(re.findall(b"\1+", bytes(gone)))
        want[i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))] += 1
    assert sum(k[2] > 0 for k in want) > 20
    assert got_rows(suffix_dedup.suffix_digest(make_docs(rows)), ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == want


@pytest.mark.parametrize("memory", [1, 1 << 20])
def test_suffix_order(memory):
    rnd = random.Random(3)
    for _ in range(120):
        n, kinds, cap = rnd.randint(1, 100), rnd.choice([1, 2, 3, 6]), rnd.choice([3, 10, 50])
        t = [rnd.randrange(kinds) for _ in range(n)]
        if n > 20:
            t[n // 2:n // 2 + n // 3] = t[:n // 3]
        pos, lcp = suffix_order(np.array(t), cap, memory)
        assert sorted(pos) == list(range(n))
        for a, b, have in zip(pos, pos[1:], lcp[1:], strict=False):
            assert t[a:a + cap] <= t[b:b + cap]
            same = next((k for k in range(cap) if t[a + k:a + k + 1] != t[b + k:b + k + 1] or a + k >= n), cap)
            assert have == same


def brute_fingerprint(text):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[j:j + 3]) for j in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(rows, bits=3):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                parent[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        least[find(a)] = min(least.get(find(a), INF), order(i))
    return [(i, f"{fps[a]:016x}", None if least[find(a)] == INF else least[find(a)]) for a, (i, _) in enumerate(rows)]


def near_rows(rows):
    rnd = random.Random(11)
    text = [f"term{rnd.randrange(5000)}" for _ in range(1500)]
    out = list(rows)
    for i in range(300, 360):
        t = list(text)
        for _ in range(rnd.randrange(4)):
            t[rnd.randrange(len(t))] = "edit"
        out.append((i, " ".join(t)))
    return out


def test_simhash(make_docs, rows):
    rows = near_rows(rows)
    want = brute_components(rows)
    assert len({x[2] for x in want}) < len(want) - 30
    got = got_rows(simhash.simhash_digest(make_docs(rows)), ("doc_id", "fingerprint", "component_id"))
    assert got == Counter(want)


def test_long_lists_are_split(spark):
    """Lists longer than the cell size are compared chunk by chunk, with the same links."""
    rnd = np.random.default_rng(5)
    center = rnd.integers(0, 1 << 62, 3)
    fps = sorted({int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in center for a, b in rnd.integers(0, 62, (60, 2))})
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint")

    def sets(size):
        from ledgerflow.llm._graph import components
        out = {}
        for r in components(simhash.near_links(df, 3, size)).collect():
            out.setdefault(r["label"], set()).add(r["node"])
        return sorted(map(sorted, out.values()))

    assert sets(7) == sets(1000) and sum(map(len, sets(7))) > 100


def test_one_of_each_stays(make_docs, rows):
    rows = near_rows(rows)
    docs = make_docs(rows).withColumnsRenamed({"lang": "gone_id", "source": "fp"})
    # one row of each component, told by the least doc_id and then the least hash of the text
    groups = {}
    for (i, t), (_, fp, c) in zip(rows, brute_components(rows), strict=True):
        h = xxhash.xxh64_intdigest((t or "").encode(), 42)
        groups.setdefault(c if c is not None else fp, []).append((order(i), h - (1 << 64) if h >> 63 else h, i, t))
    want = Counter((i, t or "") for _, _, i, t in map(lambda g: min(g, key=lambda x: x[:2]), groups.values()))
    out = simhash.keep_one_of_each(docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"] or "") for r in out.collect()) == want


@pytest.mark.parametrize("digest", [line_dedup.line_digest, substring_dedup.substring_digest, suffix_dedup.suffix_digest, simhash.simhash_digest,
                                    line_dedup.drop_repeated_lines, simhash.keep_one_of_each])
def test_no_rows(make_docs, digest):
    assert digest(make_docs([])).count() == 0
    assert digest(make_docs([(None, None), (1, "")])).count() in (1, 2)


def thue_morse(a, b, n):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_texts_that_polynomials_take_for_equal_stay_apart(spark, make_docs, n):
    one, other = thue_morse("a", "b", n), thue_morse("b", "a", n)
    docs = make_docs([(1, one), (2, other), (3, f"{one}\n{other}\n{one}")])
    dropped = {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_digest(docs).collect()}
    assert dropped == {1: 0, 2: 0, 3: 3}
    lines = quality_rules.Batch(pa.array([f"{one}\n{other}", f"{one}\n{one}"])).base()["n_dup_lines"]
    assert lines.tolist() == [0, 1]
    data, offsets = tx.utf8(pa.array([f"{one} {other} {one}"]))
    s, e, _ = tx.words(data, offsets)
    h = tx.piece_hash(data, s, e)
    assert h[0] == h[2] != h[1] and (tx.piece_hash(data, s, e, seed=1) != h).all()


def test_one_row_of_each_group_stays_and_no_row_of_another(spark, make_docs):
    text = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"thing{i * 7}" for i in range(40))
    third = " ".join(f"stuff{i * 3}" for i in range(40))
    rows = [(1, text), (5, text + "  "), (5, other), (6, third), (6, third), (None, third), (None, None), (None, None)]
    kept = [tuple(r) for r in simhash.keep_one_of_each(make_docs(rows)).select("doc_id", "text").collect()]
    assert sorted(kept, key=str) == sorted([(1, text), (5, other), (6, third), (None, None)], key=str)


def test_suffix_dedup_on_workers_without_the_package(tmp_path):
    """The package is on the driver's path only: workers start in another folder, without it."""
    script = tmp_path / "job.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2") \\
    .config("spark.checkpoint.dir", {str(tmp_path / "ckpt")!r}).getOrCreate()
from ledgerflow.llm.suffix_dedup import suffix_digest
shared = "a passage of more than fifty bytes that both of the two texts hold"
docs = spark.createDataFrame([(1, "x " + shared + " tail one"), (2, "yy " + shared + " ends"), (3, "zz " + shared + " tail one")], "doc_id long, text string")
print(sorted((r["doc_id"], r["n_removed"]) for r in suffix_digest(docs).collect()))
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "(1, 0)" in done.stdout
