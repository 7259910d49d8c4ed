"""Per-document operators (1, 4, 5, 6): against the library, brute force or held-out accuracy."""

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from ledgerflow.llm import lm_score, quality_rules, token_counts
from ledgerflow.llm.quality_classifier import quality_classifier

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = ("kept", "masks", "y", "score", "n_words", "key", "block")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_token_counts_are_the_librarys(make_docs, odd_rows, tokenizer_path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path)
    got = rows_of(token_counts.token_counts(make_docs(odd_rows), tokenizer_path))
    want = Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in odd_rows)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


def test_plain_characters_split_alike(tokenizer_path):
    """Every character that is counted by parts splits as the library splits it, beside letters,
    digits, symbols and white space."""
    with open(tokenizer_path, encoding="utf-8") as f:
        enc = token_counts.Encoder(f.read(), {})
    pre = enc.tokenizer.pre_tokenizer
    for start in range(0, 0x3000, 64):
        chars = [chr(c) for c in range(start, start + 64) if enc.plain(chr(c))]
        for text in ["".join(f"a{c}a 1{c}1 !{c}! {c}  {c} x" for c in chars)]:
            assert len(enc.split(text)) == len(pre.pre_tokenize_str(text))


def test_token_counts_of_no_rows(make_docs, tokenizer_path):
    assert token_counts.token_counts(make_docs([]), tokenizer_path).count() == 0


def base_rules(text):
    text = text or ""
    words = WORD.findall(text)
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count, hit = Counter(wins), [False] * len(words)
    for i, w in enumerate(wins):
        if count[w] > 1:
            hit[i:i + 5] = [True] * 5
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n, rep = len(words), sum(hit)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, rep, n < 10 or 100 * rep > 20 * n)


def test_quality_rules_base(make_docs, odd_rows, labels, real):
    rows = [*odd_rows, (20, "a b c d e f\na b c d e f\nq\nq\n\nx # $ |")]
    got = rows_of(quality_rules.quality_rules(make_docs(rows), labels))
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[c] for c in cols) for r in got) == Counter((i, *base_rules(t)) for i, t in rows)
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_quality_rules_on_real_rows(real, labels):
    got = {r["doc_id"]: r for r in rows_of(quality_rules.quality_rules(real, labels))}
    for r in real.collect():
        assert base_rules(r["text"]) == tuple(got[r["doc_id"]][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
    seen = [(x["quality"], got[x["doc_id"]]["kept"]) for x in labels.collect() if not got[x["doc_id"]]["base_failed"]]
    assert np.mean([q == k for q, k in seen]) > 0.95
    kept = quality_rules.keep_good(real.withColumnsRenamed({"lang": "kept", "source": "judged_text"}), labels)
    assert kept.columns == ["doc_id", "text", "kept", "judged_text", "n_chars"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


@pytest.mark.parametrize("which", ["none", "one class"])
def test_classifiers_without_both_classes(make_docs, odd_rows, labels, real, which):
    few = labels.where("false") if which == "none" else labels.where("quality = 1")
    docs = make_docs(odd_rows).unionByName(real)
    assert quality_rules.quality_rules(docs, few).count() == docs.count()
    got = rows_of(quality_classifier(docs, few))
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    if which == "none":
        assert {r["score"] for r in got} == {0.5}
    assert quality_classifier(make_docs([]), labels).count() == 0
    assert quality_rules.quality_rules(make_docs([]), labels).count() == 0


def test_quality_classifier(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r["doc_id"]: r for r in rows_of(quality_classifier(docs, labels))}
    assert all(r["held_out"] == (crc32(str(i).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) for i, r in got.items())
    held = [(x["quality"], got[x["doc_id"]]) for x in labels.collect() if got[x["doc_id"]]["held_out"]]
    assert np.mean([q == r["predicted"] for q, r in held]) > 0.93
    # labels of held-out rows change nothing
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r["doc_id"]: r["score"] for r in rows_of(quality_classifier(docs, flipped))} == {i: r["score"] for i, r in got.items()}


def brute_base(rows):
    train, tokens = Counter(), []
    for i, t in rows:
        ws = [*WORD.findall(lower(t)), None]
        tokens.append(ws)
        if i is None or crc32(str(i).encode()) % 7 != 2:
            train.update(ws)
    n, v = sum(train.values()), len(train)
    return [(i, len(ws), sum(train[w] > 0 for w in ws), n, sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws)) for (i, _), ws in zip(rows, tokens, strict=True)]


def test_lm_base(make_docs, odd_rows):
    rows = [*odd_rows, *[(100 + i, f"Word{i % 3} word{i % 5} AND and {i}") for i in range(40)]]
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows_of(lm_score.lm_scores(make_docs(rows)))), key=str)
    want = sorted(brute_base(rows), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want])


def small_model(texts, share=1 << 16):
    offsets = np.cumsum([0, *map(len, texts)])
    code, n = np.unique(lm_score.grams_of(np.frombuffer(b"".join(texts), np.uint8), offsets), return_counts=True)
    grams = {}
    for k in range(5, 1, -1):
        code, n = lm_score.summed(lm_score.low(code, k + 1), n)
        ctx = code >> np.uint64(8)
        total = dict(zip(*lm_score.summed(ctx, n), strict=True))
        kept = np.array([k == 2 or total[c] * share >= len(b"".join(texts)) for c in ctx], bool)
        grams[k] = (code[kept], n[kept])
    return lm_score.byte_model(grams)


@pytest.mark.parametrize("share", [1 << 16, 8])
def test_lm_probabilities_sum_to_one(share):
    model = small_model([b"abracadabra abracad", b"the cat sat on the mat and the cat sat", b""], share)
    for ctx in (b"\0\0\0\0\0", b"racad", b"e cat", b"zzcat", b"zzzat", b"zzzzt", b"zzzzz", b"the z"):
        base = int.from_bytes(ctx, "big") << 8
        code = np.arange(base, base + 256, dtype=np.uint64)
        assert (10.0 ** lm_score.code_lengths(model, code)).sum() == pytest.approx(1, abs=1e-4)


def brute_ppm(train, text):
    """Escape C with exclusion, straight from the definition."""
    counts = {}
    for t in train:
        t = b"\0" * 5 + t
        for i in range(5, len(t)):
            for k in range(6):
                counts.setdefault(t[i - k:i], Counter())[t[i]] += 1
    total, t = 0.0, b"\0" * 5 + text
    for i in range(5, len(t)):
        out = set()
        for k in (5, 4, 3, 2, 1, 0):
            c = {s: n for s, n in counts.get(t[i - k:i], {}).items() if s not in out}
            if not c:
                continue
            size = sum(c.values()) + len(c)
            if t[i] in c:
                total += math.log10(c[t[i]] / size)
                break
            total += math.log10(len(c) / size)
            out |= set(c)
        else:
            total -= math.log10(256 - len(out))
    return total


def test_lm_scores_are_ppm(make_docs):
    rows = [(i, t) for i, t in enumerate(["abracadabra", "the cat sat on the mat", "the dog sat", "zebra", "", None, "abba abba", "été the", "cat", "mat the cat"])]
    train = [(t or "").encode() for i, t in rows if crc32(str(i).encode()) % 7 != 2]
    got = {r["doc_id"]: r["score"] for r in rows_of(lm_score.lm_scores(make_docs(rows)))}
    for i, t in rows:
        assert got[i] == pytest.approx(brute_ppm(train, (t or "").encode()), abs=1e-3)


def test_lm_rare_contexts_count(make_docs):
    """A context that two documents of many have is as good a context as any."""
    words = ["lorem", "ipsum", "dolor", "amet", "elit", "sed"]
    rows = [(i, " ".join(words[(i * j + j // 7) % 6] for j in range(600))) for i in range(60)]
    rare = ["jumbly vex dwarf", "quick zyzzyva fog", "pyx hock blitz", "nth cwm fjord bank", "glyph vext quiz"]
    rows += [(1000 + i, rare[i % 5]) for i in range(10)]
    train = [t.encode() for i, t in rows if crc32(str(i).encode()) % 7 != 2]
    assert sum(map(len, train)) > 2 << 16
    got = {r["doc_id"]: r["score"] for r in rows_of(lm_score.lm_scores(make_docs(rows)))}
    for i, t in rows[58:]:
        assert got[i] == pytest.approx(brute_ppm(train, t.encode()), abs=1e-3)


def test_lm_of_no_rows(make_docs):
    assert lm_score.lm_scores(make_docs([])).count() == 0
