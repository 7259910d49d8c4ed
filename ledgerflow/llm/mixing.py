"""Mixing sources to target weights (operator 10), with DataFrame operations only.

* Targets: sources in the order of their names (code points, null last) weigh ``weights`` in turn
  and share all words; a target stops at ``max_epochs`` times its source's size and the excess is
  shared anew by weight (water filling, in closed form over the sources sorted by size per weight).
* Blocks: a source's documents, in the order of a seeded hash, are one stream of words, repeated for
  each epoch and cut into blocks of equal size, 2^10 or more (``with_blocks``): a source's blocks hold
  a fixed share of its target, whatever the target is. The last one is cut where the target is met.
* Schedule: the golden-ratio sequence, in 32-bit integers, gives slot j the point
  (j + 1) * 2654435769 mod 2^32. Points are mapped through the sources' cumulative numbers of blocks,
  so every stretch of the schedule holds the sources in nearly their shares. A slot's rank among its
  source's slots is the block it takes; ``SPARE`` more slots for each source make up for what the
  sequence's discrepancy may withhold. Slots and documents are joined on (source, block).

So every source meets its target to a word, in one schedule for all. No step needs a source whole:
ranks are prefix sums over chunks of the schedule and streams are prefix sums over 4096 hash cells of
a source, where rows without a doc_id or with the same one are told apart by their texts.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own
and the last; a null doc_id is passed through; rows that repeat are documents of their own; ties
in the hash are ordered by doc_id and size; other columns, whatever their names, are ignored; an
empty table gives no rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerflow.llm._graph import cut

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
GOLDEN = 2654435769    # 2^32 divided by the golden ratio
UNIT = 1 << 32
LEAST_SLOTS = 1 << 16  # blocks of all sources, at least,
SOURCE_SLOTS = 1 << 10 # and of each one
SPARE = 64             # the golden-ratio sequence's discrepancy is far below that
CHUNK = 4096           # slots ranked together
CELL_BITS = 20         # points are matched with sources in 2^12 cells of the unit interval
SMALL_SOURCES = 50_000 # so many rows of sources are broadcast; beyond, sources are shuffled


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words; null: 0."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """One row per source: number ``s``, size, weight, target, and the integers ``lo`` and ``hi``
    between which points belong to it."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row for each source: small enough to be ordered in one place
    by_name, by_fill = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("ratio", "s")
    src = src.withColumn("s", F.row_number().over(by_name).cast("bigint") - 1)
    src = src.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod("s", F.lit(len(weights))) + 1).cast("int")).cast("bigint"))
    src = src.withColumn("cap", F.col("source_size") * max_epochs).withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    every, before = W.partitionBy(), by_fill.rowsBetween(W.unboundedPreceding, -1)
    src = src.withColumns({
        "total": F.sum("source_size").over(every), "all_weight": F.sum("weight").over(every), "n_sources": F.count(F.lit(1)).over(every),
        "full_before": F.coalesce(F.sum("cap").over(before), F.lit(0)), "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0))})
    src = src.withColumn("level", (F.col("total") - F.col("full_before")).cast("double") / (F.col("all_weight") - F.col("weight_before")))
    src = src.withColumn("full", F.col("level") > F.col("ratio"))
    src = src.withColumn("level", F.min(F.when(~F.col("full"), F.struct("ratio", "s", "level"))).over(every)["level"])
    src = src.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")))
    return src.select("source", "s", "source_size", "target", "total", "n_sources")


def with_blocks(sources: DataFrame) -> DataFrame:
    """Adds each source's ``quota`` (words the mix takes of it), the size and number of its blocks,
    the integers ``lo`` and ``hi`` between which points belong to it, and all ``slots``."""
    per_source = F.greatest(F.lit(SOURCE_SLOTS), F.floor(F.lit(LEAST_SLOTS) / F.col("n_sources")))
    src = sources.withColumn("quota", F.floor(F.col("target") + 0.5).cast("bigint"))
    src = src.withColumn("block", F.greatest(F.lit(1), F.ceil(F.col("quota") / per_source)).cast("bigint"))
    src = src.withColumn("blocks", F.ceil(F.col("quota") / F.col("block")).cast("bigint"))
    src = src.withColumn("share", F.when(F.col("blocks") > 0, F.col("blocks") + SPARE).otherwise(0).cast("bigint"))
    upto = W.orderBy("s").rowsBetween(W.unboundedPreceding, W.currentRow)  # one row for each source
    src = src.withColumns({"upto": F.sum("share").over(upto), "slots": F.sum("share").over(W.partitionBy())})
    point = F.floor(F.col("upto").cast("double") / F.greatest("slots", F.lit(1)).cast("double") * float(UNIT)).cast("bigint")
    return src.withColumn("hi", point).withColumn("lo", F.coalesce(F.lag("hi").over(W.orderBy("s")), F.lit(0))).drop("share", "upto")


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """``s, block``: for every slot its source and its rank among the source's slots."""
    points = sources.sparkSession.range(slots).select(
        F.col("id").alias("j"), F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(UNIT)).alias("p"))
    points = points.withColumn("cell", F.shiftright("p", CELL_BITS))
    spans = sources.where("hi > lo").select("s", "lo", "hi", F.explode(F.sequence(
        F.shiftright("lo", CELL_BITS), F.shiftright(F.col("hi") - 1, CELL_BITS))).alias("in_cell"))
    dealt = points.join(spans, (points["cell"] == spans["in_cell"]) & (F.col("p") >= F.col("lo")) & (F.col("p") < F.col("hi")))
    dealt = cut(dealt.select("j", "s", F.floor(F.col("j") / CHUNK).alias("chunk")))
    before = W.partitionBy("s").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = dealt.groupBy("s", "chunk").agg(F.count(F.lit(1)).alias("n"))
    chunks = chunks.select(F.col("s").alias("cs"), F.col("chunk").alias("cc"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(W.partitionBy("s", "chunk").orderBy("j")) - 1
    ranked = dealt.withColumn("inside", inside)
    return ranked.join(chunks, (ranked["s"] == chunks["cs"]) & (ranked["chunk"] == chunks["cc"])).select("s", (F.col("earlier") + F.col("inside")).alias("block"))


def streams(docs: DataFrame, seed: str) -> DataFrame:
    """Each document's first word's place (``at``) in its source's shuffled stream."""
    h = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(":"), F.col("text_hash")))
    placed = cut(docs.withColumn("h", h).withColumn("cell", F.substring("h", 1, 3)))
    cells = placed.groupBy("s", "cell").agg(F.sum("size").alias("n"))
    before = W.partitionBy("s").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select(F.col("s").alias("cs"), F.col("cell").alias("cc"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    order = W.partitionBy("s", "cell").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = placed.withColumn("inside", F.sum("size").over(order) - F.col("size"))
    return inside.join(cells, (inside["s"] == cells["cs"]) & (inside["cell"] == cells["cc"])).withColumn("at", F.col("earlier") + F.col("inside")).drop("cs", "cc", "cell", "h", "text_hash", "earlier", "inside")


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source`` of every document."""
    sizes = cut(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                            word_count(F.col("text").cast("string")).alias("size"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")))
    sources = cut(with_blocks(source_targets(sizes, weights, max_epochs)))
    head = sources.select("slots", "n_sources").first()
    slots, n_sources = (head["slots"], head["n_sources"]) if head else (0, 0)
    facts = sources.select(F.col("source").alias("of_source"), "s", "source_size", "target", "block", "quota")
    facts = F.broadcast(facts) if n_sources <= SMALL_SOURCES else facts
    known = sizes.join(facts, sizes["source"].eqNullSafe(facts["of_source"]) if n_sources <= SMALL_SOURCES
                       else (F.coalesce(sizes["source"], F.lit("")) == F.coalesce(facts["of_source"], F.lit(""))) & sizes["source"].eqNullSafe(facts["of_source"])).drop("of_source")
    known = cut(known)
    keys = ["doc_id", "source", "size", "s", "source_size", "target"]
    plan = schedule(sources, slots).select(F.col("s").alias("slot_s"), F.col("block").alias("slot_block"))
    placed = cut(streams(known.where("size > 0"), seed))
    # a document's words in each epoch, by the blocks they lie in
    epochs = placed.select(*keys, "block", "quota", "at", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"))
    epochs = epochs.withColumn("x", F.col("at") + F.col("epoch") * F.col("source_size")).where("x < quota")
    epochs = epochs.withColumn("end", F.least(F.col("x") + F.col("size"), "quota"))
    pieces = epochs.select(*keys, "block", "at", "x", "end", F.explode(F.sequence(F.floor(F.col("x") / F.col("block")), F.floor((F.col("end") - 1) / F.col("block")))).alias("b"))
    took = pieces.join(plan, (pieces["s"] == plan["slot_s"]) & (pieces["b"] == plan["slot_block"]))
    overlap = F.least("end", (F.col("b") + 1) * F.col("block")) - F.greatest("x", F.col("b") * F.col("block"))
    took = took.withColumn("overlap", overlap).groupBy(F.col("s").alias("took_s"), F.col("at").alias("took_at")).agg(F.sum("overlap").alias("taken"))
    out = placed.join(took, (placed["s"] == took["took_s"]) & (placed["at"] == took["took_at"]), "left")
    cols = [*keys, F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")]
    out = out.select(*cols).unionAll(known.where("size = 0").select(*keys, F.lit(0).cast("bigint").alias("taken")))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")


ORACLE = r"""
WITH sizes AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(text, '')) AS text_hash FROM documents),
src0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
src1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s FROM src0),
src2 AS (SELECT *, CASE s % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM src1),
src3 AS (SELECT *, cap::DOUBLE / weight AS ratio, (SELECT sum(source_size) FROM src0)::BIGINT AS total,
                (SELECT sum(weight) FROM src2)::BIGINT AS all_weight, (SELECT count(*) FROM src0) AS n_sources FROM src2),
src4 AS (SELECT *, coalesce(sum(cap) OVER f, 0)::BIGINT AS full_before, coalesce(sum(weight) OVER f, 0)::BIGINT AS weight_before
         FROM src3 WINDOW f AS (ORDER BY ratio, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
src5 AS (SELECT *, (total - full_before)::DOUBLE / (all_weight - weight_before) AS lev FROM src4),
src6 AS (SELECT *, lev > ratio AS is_full FROM src5),
lvl AS (SELECT arg_min(lev, (ratio, s)) AS level FROM src6 WHERE NOT is_full),
src7 AS (SELECT src6.*, CASE WHEN is_full THEN cap::DOUBLE ELSE level * weight END AS target FROM src6, lvl),
src8 AS (SELECT *, floor(target + 0.5)::BIGINT AS quota, greatest(1024, 65536 // n_sources) AS per_source FROM src7),
src9 AS (SELECT *, greatest(1, (quota + per_source - 1) // per_source)::BIGINT AS block FROM src8),
src10 AS (SELECT *, (quota + block - 1) // block AS blocks FROM src9),
src11 AS (SELECT *, CASE WHEN blocks > 0 THEN blocks + 64 ELSE 0 END AS share FROM src10),
src12 AS (SELECT *, sum(share) OVER () AS slots,
                 floor((sum(share) OVER (ORDER BY s))::DOUBLE / greatest(sum(share) OVER (), 1)::DOUBLE * 4294967296.0)::BIGINT AS hi FROM src11),
src13 AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY s), 0) AS lo FROM src12),
slots AS (SELECT ((j + 1) * 2654435769) % 4294967296 AS p FROM (SELECT unnest(range((SELECT max(slots) FROM src13)::BIGINT)) AS j)),
won AS (SELECT s, count(*) AS n FROM slots JOIN src13 ON p >= lo AND p < hi GROUP BY s),
placed AS (SELECT z.doc_id, z.size, r.source, r.s, r.source_size, r.target, r.quota, r.block,
                  sum(z.size) OVER (PARTITION BY r.s ORDER BY md5('mix-1:' || coalesce(z.doc_id::VARCHAR, 'none') || ':' || z.text_hash), z.doc_id, z.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - z.size AS place
           FROM sizes z JOIN src13 r ON z.source IS NOT DISTINCT FROM r.source),
upto AS (SELECT placed.*, least(quota, coalesce(n, 0) * block) AS last FROM placed LEFT JOIN won ON placed.s = won.s)
SELECT doc_id, size, source_size, target, source,
       (greatest(0, least(size, last - place)) + greatest(0, least(size, last - place - source_size))
        + greatest(0, least(size, last - place - 2 * source_size)))::BIGINT AS taken
FROM upto
"""
