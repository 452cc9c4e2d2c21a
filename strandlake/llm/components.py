"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.session import discard, settle


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of edges (a, b).

    Each round takes the least label among the neighbours, then the label of that label; the labels are
    written to the shared folder in between. A hub's edges meet in partial minima, not in one task.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both, edges_path = settle(both, "edges")
    labels, path = settle(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        told = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("m"))
        near = labels.join(told, labels["node"] == told["a"]).select("node", F.least("component", "m").alias("component"), F.col("component").alias("before"))
        near, near_path = settle(near, "near")
        jump = near.select(F.col("node").alias("c"), F.col("component").alias("further"))
        after, after_path = settle(near.join(jump, near["component"] == jump["c"]).select("node", F.least("component", "further").alias("component"), "before"), "labels")
        done = after.where("component <> before").isEmpty()
        for old in (path, near_path):
            discard(spark, old)
        labels, path = after.drop("before"), after_path
        if done:
            discard(spark, edges_path)
            return labels


def contracted_components(edges: DataFrame) -> DataFrame:
    """As components(). In each round nodes that have one label become one node, and only links between different ones go on,
    so that later rounds read what is still to be joined alone. The least node of a component keeps its name."""
    spark = edges.sparkSession
    link = lambda df, a, b: df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    left, path = settle(link(edges, "a", "b"), "edges")
    rounds = []
    while True:
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near, near_path = settle(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "near")
        jump = near.select(F.col("node").alias("c"), F.col("component").alias("further"))
        labels, labels_path = settle(near.join(jump, near["component"] == jump["c"]).select("node", F.col("further").alias("component")), "labels")
        rounds.append((labels, labels_path))
        one, two = labels.toDF("a", "one"), labels.toDF("b", "two")
        after, after_path = settle(link(left.join(one, "a").join(two, "b"), "one", "two"), "edges")
        discard(spark, near_path)
        discard(spark, path)
        left, path = after, after_path
        if left.isEmpty():
            break
    out, _ = rounds[-1]
    for labels, _ in reversed(rounds[:-1]):
        last = out.select(F.col("node").alias("c"), F.col("component").alias("further"))
        out = labels.join(last, labels["component"] == last["c"], "left").select("node", F.coalesce("further", "component").alias("component"))
    out, _ = settle(out, "labels")
    for old in (path, *(old for _, old in rounds)):
        discard(spark, old)
    return out
