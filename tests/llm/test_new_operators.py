"""Toxicity, centroid clusters and conversation repair against brute force and held-out labels."""

import binascii
import hashlib
import random
import re
from functools import lru_cache

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerflow.llm import centroids, toxicity, turn_repair

SF = "/root/testdata/sf0.01"


# -- toxicity ------------------------------------------------------------------------------------

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


@pytest.mark.parametrize("sf, recall, harm", [("sf0.01", 0.5, 0.08), ("sf0.1", 0.85, 0.02)])
def test_toxicity_on_held_out_labels(spark, sf, recall, harm):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels)
    rows = out.join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    assert out.count() == docs.count()
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= recall * len(toxic)
    assert sum(r["predicted"] for r in clean) <= harm * len(clean)


def test_toxicity_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 0), (5, 1, 1), (5, 1, 0), (6, 0, 0), (None, 1, 1), (7, 1, None), (8, 1, 7), (9, 0, 1), (10, 0, 0)], LABELS)
    clashing = docs.selectExpr("*", "1 AS score", "2 AS held_out", "3 AS toxic", "4 AS part", "5 AS y")
    out = toxicity.toxicity(clashing, labels).collect()
    assert len(out) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in out)
    for r in out:
        assert r["held_out"] == (r["doc_id"] is not None and binascii.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    empty = {r["score"] for r in out if r["doc_id"] in (2, 3)}
    assert len(empty) == 1  # a null text is an empty one
    assert toxicity.toxicity(docs.where("false"), labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(docs, labels.where("false")).collect()} == {0.5}
    one = {r["score"] for r in toxicity.toxicity(docs, labels.where("toxic = 1")).collect()}
    assert len(one) == 1 and one.pop() > 0.5


def test_ngrams_are_of_code_points_and_stay_in_their_text():
    import pyarrow as pa
    texts = ["Été  42 idiot!", None, "", "ét", "é"]
    text, bucket = toxicity.ngrams(pa.array(texts))
    by_text = [set(bucket[text == i].tolist()) for i in range(5)]

    def plain(t):
        s = " " + re.sub(r"[\x00-\x40\x5b-\x60\x7b-\x7f]+", " ", (t or "").lower()) + " "
        s = re.sub(" +", " ", s)
        return {s[i:i + n] for n in toxicity.SIZES for i in range(len(s) - n + 1)}

    assert [len(b) for b in by_text] == [len(plain(t)) for t in texts]
    again = toxicity.ngrams(pa.array(["ÉT"]))[1]
    assert set(again.tolist()) == by_text[3] and by_text[3] != by_text[4]


# -- centroid clusters ---------------------------------------------------------------------------

def plain_clusters(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cs = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        found = [near(v)[1] for _, v in kept]
        for j in range(len(cs)):
            mine = [v for (_, v), f in zip(kept, found, strict=True) if f == j]
            if mine:
                cs[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    last = [near(v) for _, v in kept]
    total = [sum(d for d, c in last if c == j) for j in range(len(cs))]
    return sorted(((i, c, d, total[c], sum(total), hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, last, strict=True)), key=str)


EMB = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("cluster", T.IntegerType())])


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_clusters_against_brute_force(spark):
    rng = np.random.default_rng(5)
    few = [[float(x) for x in rng.integers(-3, 4, 64) / 1024] for _ in range(12)]  # small integers: many ties
    rows = [(i, few[int(rng.integers(0, 12))] if i % 3 else [float(x) for x in rng.normal(0, 0.1, 64).astype(np.float32)]) for i in range(90)]
    rows += [(None, few[0]), (4, few[1]), (4, few[1]), (91, None), (92, few[0][:63]), (93, [None, *few[0][1:]]), (94, [float("nan"), *few[0][1:]]),
             (95, [float("inf"), *few[0][1:]]), (96, [])]
    df = spark.createDataFrame([(i, v, 9) for i, v in rows], EMB).repartition(5)
    assert as_rows(centroids.centroid_clusters(df)) == plain_clusters(rows)


def test_clusters_of_odd_tables(spark):
    df = spark.createDataFrame([(i, [float(i)] * 64, 0) for i in range(3)] + [(7, [3e38] * 64, 0), (8, [-3e38] * 64, 0)], EMB)
    assert centroids.centroid_clusters(df.where("false")).count() == 0
    out = {r["vec_id"]: r for r in centroids.centroid_clusters(df).collect()}
    assert set(out) == {0, 1, 2, 7, 8} and all(r["distance"] == 0 for r in out.values())
    far = centroids.centroid_clusters(df, k=1).collect()
    assert all(r["distance"] >= 0 for r in far)


def test_tournament_is_exact_for_large_components():
    rng = np.random.default_rng(1)
    x = rng.integers(-centroids.LARGEST, centroids.LARGEST + 1, (50, 64))
    c = np.concatenate([x[:3], x[:3], rng.integers(-centroids.LARGEST, centroids.LARGEST + 1, (2, 64))])
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, w, strict=True)), j) for j, w in enumerate(c)) for v in x]
    won = centroids.tournament(x, c)
    assert won.tolist() == [j for _, j in want]
    assert centroids.distances(x, c, won).tolist() == [d for d, _ in want]


# -- conversation repair -------------------------------------------------------------------------

def plain_repair(turns):
    """Least (cost, audit) over an automaton: no lengths, no bands, no blocks."""
    @lru_cache(None)
    def go(i, given):  # given: "", "s", "u" or "a", the last initial
        ways = [(0, "")] if i == len(turns) and given in ("", "a") else []
        nxt = {"": "u", "s": "u", "u": "a", "a": "u"}[given]
        if i < len(turns):
            initial, state = turns[i]
            c, a = go(i + 1, given)
            ways.append((c + 3, "D" + a))
            if state != turn_repair.BAD:
                more = 1 if state == turn_repair.OPEN else 0
                for role in {nxt} | ({"s"} if given == "" else set()):
                    if initial == role:
                        c, a = go(i + 1, role)
                        ways.append((c + more, "K" + a))
                    elif role != "s":
                        c, a = go(i + 1, role)
                        ways.append((c + 2 + more, "R" + a))
        # an insert, of which two in a row may be needed at most before the next turn or the end
        out = min(ways) if ways else (10 ** 9, "~")
        return min(out, inserted(i, nxt, 3))

    def inserted(i, role, left):
        if not left:
            return (10 ** 9, "~")
        nxt = "a" if role == "u" else "u"
        ways = []
        if i == len(turns):
            ways.append((0, "") if role == "a" else (10 ** 9, "~"))
        else:
            initial, state = turns[i]
            c, a = go(i + 1, role)
            ways.append((c + 3, "D" + a))
            if state != turn_repair.BAD:
                more = 1 if state == turn_repair.OPEN else 0
                c, a = go(i + 1, nxt)
                ways.append((c + more, "K" + a) if initial == nxt else (c + 2 + more, "R" + a))
        c, a = min(min(ways), inserted(i, nxt, left - 1))
        return (c + 2, "I" + a)

    return go(0, "")


def test_repair_of_every_short_conversation():
    kinds = [(r, s) for r in "sua" for s in (0, 1, 2)] + [("x", 0)]
    for n in range(4):
        for code in range(len(kinds) ** n):
            turns = [kinds[code // len(kinds) ** i % len(kinds)] for i in range(n)]
            assert turn_repair.repair(turns) == plain_repair(tuple(turns)), turns


@pytest.mark.parametrize("seed", range(4))
def test_repair_across_blocks(seed):
    rng = random.Random(seed)
    for _ in range(60):
        n = rng.randint(10, 70)
        turns = [(rng.choice("ssuuuaaax" if seed % 2 else "ua"), rng.choice((0, 0, 0, 1, 2))) for _ in range(n)]
        if seed == 2:  # deleted for longer than a block, then a system turn
            turns = [("u", 1)] * 20 + [("s", 0)] + turns
        assert turn_repair.repair(turns) == plain_repair(tuple(turns)), turns


def test_repair_cost_grows_with_the_turns():
    rng = random.Random(3)
    turns = [(rng.choice("sua"), rng.choice((0, 0, 0, 1, 2))) for _ in range(20_000)]
    cost, audit = turn_repair.repair(turns)
    price = {"D": 3, "I": 2, "R": 2, "K": 0}
    rows = [e for e in audit if e != "I"]
    assert len(rows) == len(turns)
    assert cost == sum(price[e] for e in audit) + sum(s == 2 and e != "D" for e, (_, s) in zip(rows, turns, strict=True))


CONV = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def plain_conversations(rows):
    out = []
    for conv in {r[0] for r in rows}:
        after = []
        for c, t, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            h = binascii.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            if h == 0:
                continue
            text = "" if h == 1 else (re.sub("[.!?]", "", text) if h == 2 else text)
            after += [(t, "user" if h == 4 else role or " ", text)] * (2 if h == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns, faults = set(), [], []
        for _, role, text in after:
            solid = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            turns.append((role[0], 1 if fault in ("blank", "duplicate") else 2 if fault else 0))
        cost, audit = plain_repair(tuple(turns))
        given, i, lines = [], 0, []
        for e in audit:
            row = None
            if e != "I":
                row, i = after[i], i + 1
            if e != "D":
                given.append((e, row))
        odd = len(given) % 2
        for j, (e, row) in enumerate(given):
            want = "system" if odd and j == 0 else ("user", "assistant")[(j - odd) % 2]
            lines.append(f"{row[1] if e == 'K' else want}:{row[2] if row else ''}")
        known = [t for t, _, _ in after if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:]))
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def test_conversations_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(turn_repair.repair_conversations(table)) == plain_conversations(rows)


def test_odd_conversations(spark):
    rng = random.Random(11)
    texts = ["Yes.", "Yes.", "no", "", "  \n", None, "Why? \t", "Long. " * 50, "ends open", "Été!", "!"]
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", "system", None, "", "User", "u"]), rng.choice(texts))
            for c in [None, 1, 2, 3, 4, 5, 6, 7] for t in range(rng.randint(1, 40)) for _ in range(rng.choice((1, 1, 2)))]
    rows += [(100 + i, 1, "user", "Hi.") for i in range(60)]  # some are dropped whole
    df = spark.createDataFrame(rows, CONV).selectExpr("*", "1 AS gone", "2 AS audit", "3 AS harm", "4 AS copy").repartition(7)
    got = as_rows(turn_repair.repair_conversations(df))
    assert got == plain_conversations(rows)
    assert any(r[7] == "" and r[8] == hashlib.sha256(b"").hexdigest() for r in got)
    assert turn_repair.repair_conversations(df.where("false")).count() == 0


def test_long_texts_wait_on_disk(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "HELD_BYTES", 1000)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}. " * 40) for t in range(120)]
    assert as_rows(turn_repair.repair_conversations(spark.createDataFrame(rows, CONV))) == plain_conversations(rows)


def test_cluster_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.execute(f"SELECT vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 FROM ({centroids.ORACLE})").fetchall(), key=str)
    assert as_rows(centroids.centroid_clusters(spark.read.parquet(f"{SF}/embeddings.parquet"))) == want


# -- clashing columns ----------------------------------------------------------------------------

CLASHES = ["key", "text_hash", "cells", "part", "payload", "h", "size", "s", "cell", "at", "score", "held_out", "y", "fp", "component_id", "kept", "n_words",
           "masks", "line_masks", "judged_text", "first", "place", "mark_doc", "block", "target", "taken", "item_id", "words", "DOC", "harm"]


@pytest.mark.parametrize("name", ["token_counts", "suffix", "lines", "rules", "classifier", "lm", "contamination", "substring", "simhash", "mix"])
def test_other_columns_change_nothing(spark, make_docs, odd_rows, name):
    import public_tokenizers

    from ledgerflow.llm import catalog, decontaminate, line_dedup, lm_score, mixing, quality_classifier, quality_rules, simhash, substring_dedup, suffix_dedup, token_counts
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (5, 1, 0), (5, 0, 0), (6, 1, 1), (9, 0, 1)], LABELS)
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (2, "one two three four five")], "item_id bigint, text string")
    run = {"token_counts": lambda d: token_counts.token_counts(d, public_tokenizers.path(catalog.TOKENIZER)), "suffix": suffix_dedup.suffix_digest,
           "lines": line_dedup.line_digest, "rules": lambda d: quality_rules.quality_rules(d, labels),
           "classifier": lambda d: quality_classifier.quality_classifier(d, labels), "lm": lm_score.lm_scores,
           "contamination": lambda d: decontaminate.contamination(d, items), "substring": substring_dedup.substring_digest,
           "simhash": simhash.simhash_digest, "mix": mixing.mix_sources}[name]
    docs = make_docs([r for r in odd_rows if r[0] != 6])
    more = docs.selectExpr("*", *[f"{i} AS `{c}`" for i, c in enumerate(CLASHES)])

    def rounded(df):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)

    plain, other = run(docs), run(more)
    assert plain.columns == other.columns and rounded(plain) == rounded(other)
