"""Connected components of a links table by contraction: no group is gathered anywhere."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node reachable.

    Each round hooks every node to its least neighbour, follows the pointers twice,
    renames the links by them and drops what fell together; every node with a link has
    one of them hooked, so rounds grow with the logarithm of the nodes.  Aggregates
    combine map-side, and a node with very many links is one row after the first round.
    """
    edges = staged(links.select("a", "b").where("a <> b").distinct(), name)
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node"))
    rounds = 0
    while edges.limit(1).count():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("up"))
        hook = staged(hook, f"{name}-hook")
        for _ in range(2):
            over = hook.select(F.col("a").alias("up"), F.col("up").alias("_up"))
            hook = hook.join(over, "up", "left").select("a", F.coalesce("_up", "up").alias("up"))
        hook = staged(hook, f"{name}-jump")
        labels = staged(labels.join(hook.select(F.col("a").alias("root"), "up"), "root", "left").select(
            "node", F.coalesce("up", "root").alias("root")), f"{name}-labels-{rounds}")
        left = edges.join(hook.select("a", F.col("up").alias("_a")), "a", "left")
        left = left.join(hook.select(F.col("a").alias("b"), F.col("up").alias("_b")), "b", "left")
        left = left.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a <> b")
        edges = staged(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
        rounds += 1
    return labels
