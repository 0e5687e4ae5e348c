"""Connected components of links held in a DataFrame, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.session import cut_lineage, drop_stages


def relabel(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """`column` replaced by its label in `labels` (node, label), where it has one."""
    look = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    return df.join(look, F.col(column) == F.col("_node"), "left").withColumn(column, F.coalesce("_label", column)).drop("_node", "_label")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of `links` (a, b): the smallest node it is linked with, over any number of links.

    Every round hooks each node to its smallest neighbour, jumps over two hooks, and contracts the links;
    a star vanishes in one round, a chain of n in about log n. Neighbours are reduced by map-side minima,
    so a node with very many links is no hot group. Each round is written, so that a lost executor costs
    no more than a round.
    """
    both = links.select("a", "b").where("a <> b")
    edges = cut_lineage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = None
    while not edges.isEmpty():
        hook = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        near = cut_lineage(hook.select("node", F.least("node", "label").alias("label")))
        hook = near
        for _ in range(2):
            hook = relabel(hook, "label", hook)
        hook, before, old = cut_lineage(hook), labels, edges
        # a label that was a node of this round moves on; nodes keep their first name
        labels = hook if before is None else cut_lineage(relabel(before, "label", hook))
        edges = cut_lineage(relabel(relabel(old, "a", hook), "b", hook).where("a <> b").distinct())
        drop_stages(near, before, old, hook if before is not None else None)
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
