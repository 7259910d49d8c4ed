"""Connected components of a graph of links, as joins: nothing of it comes to the driver but the
number of labels that changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.session import checkpoint_root


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the folder the session names."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)``: label is the least node reachable. Rounds
    of two steps, each cut: take the least label among the neighbours (partial aggregation before
    the shuffle), then the label of one's label (pointer jumping). A node with very many links is a
    skewed join key on one side only, which Spark splits."""
    both = cut(links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
                 .select("node", F.least("node", "label").alias("label")))
    while True:
        heard = both.join(labels, both["a"] == labels["node"]).select(F.col("b").alias("node"), "label")
        least = cut(heard.unionAll(labels).groupBy("node").agg(F.min("label").alias("label")))
        up = least.select(F.col("node").alias("parent"), F.col("label").alias("higher"))
        jumped = cut(least.join(up, least["label"] == up["parent"], "left")
                     .select("node", F.coalesce("higher", "label").alias("label")))
        old = labels.withColumnsRenamed({"node": "was", "label": "old"})
        changed = jumped.join(old, jumped["node"] == old["was"]).where("label <> old").limit(1).count()
        labels = jumped
        if not changed:
            return labels
