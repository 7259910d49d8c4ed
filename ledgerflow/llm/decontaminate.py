"""Benchmark decontamination (operator 7), with DataFrame operations only: size-partitioned MinHash
containment search finds short test items inside long documents, verified by exact containment.

A text's shingles are its lower-cased five-word windows (fewer words: the whole sequence). Items are
partitioned by the power of two of their number n of distinct shingles. A partition's sketch size
is k = floor((1 - c) * largest n of the partition) + 1: the k least shingle hashes of each item (a
bottom-k MinHash signature). A document with a share of at least c of an item's shingles lacks at
most (1 - c) * n of them, so it has one of the k: the search misses nothing, however long the
document. Document hashes above the largest sketch hash are dropped before any row is made of
them. Candidate pairs are then verified on the shingles themselves.

The sketches (a fifth of the items' shingles or a little more) and the candidates are counted
before use: up to ``SMALL_ROWS`` rows are broadcast, beyond that they are shuffled.

Defined results: the digests ignore other columns, whatever their
names, and filters return all of them; a null or empty document or item has no shingles and matches nothing; documents
that repeat a doc_id with the same text give one result row for an item; a null doc_id or item_id
is kept as such; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm._frames import fresh
from ledgerflow.llm._graph import cut

WORDS = 5
MIN_CONTAINMENT = 0.8
SMALL_ROWS = 500_000  # at most so many rows of two or three numbers are broadcast
WHITE = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    t = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(WHITE))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"[\x20\x09-\x0D]+"))


def shingle_hashes(words: str, hashes: str, k: int) -> Column:
    """Hashes of all windows of ``k`` words, from the words' hashes."""
    n = F.size(hashes)
    many = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(F.col(hashes), i + x) for x in range(k)]))
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n < k, F.array(F.xxhash64(F.concat_ws(" ", words)))).otherwise(many)


def shingle_texts(words: str, k: int) -> Column:
    n = F.size(words)
    many = F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.concat_ws(" ", F.slice(F.col(words), i, k)))
    return F.when(n == 0, F.array().cast("array<string>")).when(n < k, F.array(F.concat_ws(" ", words))).otherwise(F.array_distinct(many))


def hashed(df: DataFrame, k: int) -> DataFrame:
    df = df.withColumn("words", words_of(F.col("text")))
    df = df.withColumn("word_hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return df.withColumn("hashes", shingle_hashes("words", "word_hashes", k))


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast behind a count; a larger frame is left to a shuffle."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def contained_items(docs: DataFrame, benchmark: DataFrame, k: int = WORDS, min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """``doc_id, item_id, n_item_shingles, n_shared, containment`` for every document and item with
    at least that share of the item's distinct shingles in the document. ``text_hash`` tells apart
    texts under one doc_id."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = hashed(items, k).select("item_id", F.array_sort(F.array_distinct("hashes")).alias("hashes"), shingle_texts("words", k).alias("shingles"))
    items = cut(items.withColumn("n", F.size("shingles")).where("n > 0").distinct()
                .withColumn("item", F.monotonically_increasing_id()))
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1  # of the item's size partition
    sketch_size = F.floor((1 - F.lit(min_containment)) * largest + 1e-9).cast("int") + 1
    sketch = cut(items.select("item", F.explode(F.slice("hashes", 1, sketch_size)).alias("h")))
    head = sketch.agg(F.count(F.lit(1)).alias("n"), F.max("h").alias("top")).first()

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    top = F.lit(head["top"]).cast("bigint")
    probes = hashed(texts, k).select("doc_id", "text_hash", F.explode(F.filter("hashes", lambda h: h <= top)).alias("h"))
    found = probes.join(small(sketch, head["n"]), "h").select("doc_id", "text_hash", "item").distinct()
    pairs = cut(found)
    n_pairs, n_shingles = pairs.count(), items.agg(F.sum("n")).first()[0] or 0

    # a document comes with the numbers of its items (at most all items); the items' shingles, which
    # don't grow with the documents, join afterwards
    asked = pairs.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("th")).agg(F.collect_list("item").alias("asked"))
    same = texts["doc_id"].eqNullSafe(asked["d"]) & (texts["text_hash"] == asked["th"])
    with_text = texts.join(small(asked, n_pairs), same).select("doc_id", "text_hash", "text", F.explode("asked").alias("item"))
    with_text = with_text.join(small(items.drop("hashes"), n_shingles), "item")
    shared = F.size(F.array_intersect(shingle_texts("words", k), F.col("shingles")))
    checked = with_text.withColumn("words", words_of(F.col("text"))).withColumn("n_shared", shared.cast("bigint"))
    # written before the filter: pushed below, it would split the text anew for every shingle
    out = cut(checked.select("doc_id", "text_hash", "item_id", F.col("n").cast("bigint").alias("n_item_shingles"), "n_shared",
                             (F.col("n_shared") / F.col("n")).alias("containment")))
    return out.where(F.col("containment") >= min_containment).dropDuplicates(["doc_id", "text_hash", "item_id", "n_item_shingles"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query's rows: pairs of document and item."""
    return contained_items(docs, benchmark).select("doc_id", "item_id", "n_item_shingles", "n_shared", "containment")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, k: int = WORDS, min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """The documents (all their columns) that hold no benchmark item."""
    d, h = fresh(docs, "bad_doc"), fresh(docs, "bad_text")
    bad = cut(contained_items(docs, benchmark, k, min_containment).select("doc_id", "text_hash").distinct().toDF(d, h))
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(small(bad, bad.count()), docs["doc_id"].cast("bigint").eqNullSafe(bad[d]) & (own == bad[h]), "left_anti")


ORACLE = r"""
WITH w AS (SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS words FROM documents
           UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') FROM benchmark),
wins AS (SELECT kind, id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0),
sh AS (SELECT DISTINCT kind, id, array_to_string(words[i:i + 4], ' ') AS shingle FROM wins),
n AS (SELECT id, count(*) AS n FROM sh WHERE kind = 'i' GROUP BY id),
m AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM sh d JOIN sh i ON d.shingle = i.shingle
      WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY d.id, i.id)
SELECT doc_id, item_id, n AS n_item_shingles, n_shared, n_shared / n AS containment FROM m JOIN n ON m.item_id = n.id WHERE n_shared / n >= 0.8
"""
