"""Operators 7 and 10 and the pipeline; queries against their SQL."""

import random
import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from ledgerflow.llm import catalog, decontaminate, mixing
from tools.check import rows_of

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = catalog.queries()[name](spark, SF)
    res = con.execute(catalog.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_contained_items(spark, make_docs, odd_rows):
    words = [f"q{i}" for i in range(40)]
    items = [(1, " ".join(words)), (2, "Only three words"), (3, None), (4, ""), (5, " ".join(words[:6])), (None, " ".join(words[20:36])), (1, " ".join(words))]
    edited = words[:20] + ["edit"] + words[21:]
    rows = [*odd_rows, (50, "before " + " ".join(words) + " after"), (51, " ".join(words).upper()), (52, "x\n" + "\n".join(edited)), (53, " ".join(words[:30])),
            (54, "only THREE words"), (55, "there are only three words here"), (50, "before " + " ".join(words) + " after"), (None, " ".join(words))]
    want = set()
    for i, t in rows:
        for item, text in items:
            s = shingles(text)
            if s and len(s & shingles(t)) / len(s) >= 0.8:
                want.add((i, item, len(s), len(s & shingles(t))))
    got = decontaminate.contained_items(make_docs(rows), bench(spark, items)).collect()
    assert Counter((r["doc_id"], r["item_id"], r["n_item_shingles"], r["n_shared"]) for r in got) == Counter(want)
    docs = make_docs(rows).withColumnsRenamed({"lang": "bad_doc", "source": "words"})
    kept = decontaminate.drop_contaminated(docs, bench(spark, items))
    assert kept.columns == docs.columns
    bad = {i for i, *_ in want}
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter((i, t) for i, t in rows if not (i in bad and not (i is None and t != " ".join(words))))


def test_containment_without_rows(spark, make_docs, odd_rows):
    none = bench(spark, [])
    assert decontaminate.contained_items(make_docs(odd_rows), none).count() == 0
    assert decontaminate.drop_contaminated(make_docs(odd_rows), none).count() == len(odd_rows)
    assert decontaminate.contained_items(make_docs([]), bench(spark, [(1, "a b c d e f")])).count() == 0


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        want = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / w for s in names}
        over = {s for s in names if want[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return want
        full |= over


def test_mix(make_docs):
    rows = [(i, "w " * (17 * i % 90), ("big", "big", "b", "é", None)[i % 5]) for i in range(300)]
    rows += [(400 + i, "tiny text", "a") for i in range(3)] + [(None, "no id here", "big"), (1, "w " * 17, "big"), (500, None, "empty")]
    got = [r.asDict() for r in mixing.mix_sources(make_docs(rows)).collect()]
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((i, len(WORD.findall(t or "")), s) for i, t, s in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want, took = targets(sizes), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["taken"] <= 3 * r["size"]
        took[r["source"]] += r["taken"]
    for s in sizes:
        assert took[s] == pytest.approx(want[s], rel=0.01, abs=20)
    again = mixing.mix_sources(make_docs(rows, parts=5)).collect()
    key = ("doc_id", "source", "size", "taken")
    assert Counter(tuple(r[c] for c in key) for r in got) == Counter(tuple(r[c] for c in key) for r in again)


def test_tiny_sources_beside_a_large_one(make_docs):
    rows = [(i, "w " * 50_000, ("big", "vast")[i % 2]) for i in range(80)]
    rows += [(1000 + 10 * k + i, "w " * (k + 1), f"tiny{k}") for k in range(12) for i in range(5)] + [(5000 + i, "w " * 700, "small") for i in range(9)]
    sizes, took = Counter(), Counter()
    for _, t, s in rows:
        sizes[s] += len(t) // 2
    for r in mixing.mix_sources(make_docs(rows)).collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        took[r["source"]] += r["taken"]
    for s, want in targets(sizes).items():
        assert took[s] == pytest.approx(want, rel=0.002, abs=1), s


def test_mix_of_no_words(make_docs):
    assert mixing.mix_sources(make_docs([])).count() == 0
    assert [r["taken"] for r in mixing.mix_sources(make_docs([(1, None, "a"), (2, " ", None)])).collect()] == [0, 0]


def test_pipeline_stages(spark, tmp):
    """Each stage on what the one before it kept: its decisions, and the columns of documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "mix"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp}/{name}")
        out = spark.read.parquet(f"{tmp}/{name}")
        if name == "mix":
            assert {r["doc_id"] for r in out.collect()} == set(before)
            break
        assert out.columns == names
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        assert set(after) <= set(before) and after
        if name == "line_dedup":
            assert set(after) == set(before) and any(after[i] != before[i] for i in after)
        else:
            assert len(after) < len(before) and all(after[i] == before[i] for i in after)
        if name == "benchmark_decontamination":
            items = [shingles(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            bad = {i for i, t in before.items() if any(s and len(s & shingles(t)) / len(s) >= 0.8 for s in items)}
            assert set(after) == set(before) - bad
        docs, before = out, after


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "size", "target", "taken"} <= set(rows.columns) and 0 < rows.count() < 200


def test_tiny_sources_beside_a_large_one_follow_the_same_schedule(make_docs):
    """Against the query's SQL; every source meets its target to a word."""
    import duckdb
    import pandas as pd
    rnd = random.Random(4)
    rows = [(i, " ".join(["w"] * rnd.randrange(1, 4000)), "b-large") for i in range(900)]
    rows += [(2000 + i, " ".join(["w"] * n), f"t{i}") for i, n in enumerate((1, 2, 3, 40, 700))]
    rows += [(3000 + i, "x " * 50, "c") for i in range(30)] + [(None, f"no id {i}", "c") for i in range(40)] + [(None, "no id 1", "c"), (None, None, "c"), (5, "", None), (6, "one two", None)]
    docs = make_docs(rows)
    got = sorted((tuple(r) for r in mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source").collect()), key=str)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": [r[1] for r in rows], "source": [r[2] for r in rows]}))
    want = sorted(con.execute(f"SELECT doc_id, size, source_size, target, taken, source FROM ({mixing.ORACLE})").fetchall(), key=str)
    assert got == want
    for source in {r[5] for r in got}:
        mine = [r for r in got if r[5] == source]
        assert abs(sum(r[4] for r in mine) - mine[0][3]) <= 0.5
        assert all(r[4] <= 3 * r[1] for r in mine)
