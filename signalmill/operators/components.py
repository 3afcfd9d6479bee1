"""Connected components, and joins that no hot key holds up, as plans over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, scratch

#: A key is hot when it has more than one in so many rows, and more rows than any task minds; there are fewer hot keys than the first.
HOT_PARTS, HOT_ROWS = 1_000, 200


def join_sized(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str) -> DataFrame:
    """``rows`` left-joined by ``key`` with ``groups`` (one row a key), whose ``size`` says how many rows have it.

    Rows of hot keys meet a broadcast of fewer than HOT_PARTS groups and aren't shuffled; the others are joined by key. Both
    tables are read more than once, so they should be written ones.
    """
    limit = max(HOT_ROWS, rows.count() // HOT_PARTS)
    if groups.where(F.col(size) > limit).isEmpty():
        return rows.join(groups, key, "left")
    hot, cold = F.broadcast(groups.where(F.col(size) > limit)), groups.where(F.col(size) <= limit)
    rest = rows.join(hot, key, "left_anti").join(cold, key, "left")
    return rest.unionByName(rows.join(hot, key))


def smallest_labels(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) of every node of ``edges`` (a, b); without edges, no row.

    A round takes the least label among a node and its neighbours and then the label's own
    label, so the distance to the smallest node at least halves where labels form chains: rounds grow with the logarithm of
    the longest chain. It stops when no label has changed. A node with very many neighbours, or a label of very many nodes, is joined by broadcast.
    """
    with scratch(edges.sparkSession) as keep:
        both = edges.where("a <> b").select("a", "b").distinct()
        both = materialise(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))), "cc-edges")
        labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"), F.count("*").alias("degree"))
        labels = materialise(labels.withColumnRenamed("a", "node"), "cc-labels")
        while True:
            near = join_sized(both, labels.withColumnRenamed("node", "b"), "b", "degree").groupBy("a").agg(F.min("label").alias("near")).withColumnRenamed("a", "node")
            low = materialise(labels.join(near, "node").select("node", "degree", F.col("label").alias("old"), F.least("label", "near").alias("label")), "cc-low")
            used = low.groupBy("label").agg(F.count("*").alias("nodes"))
            jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further")).join(used, "label")
            nxt = join_sized(low, jump, "label", "nodes").select("node", "degree", "old", F.least("label", "further").alias("label"))
            labels = materialise(nxt, "cc-labels")
            if labels.where("label <> old").isEmpty():
                return keep(labels.select("node", "label"), "cc-components")
