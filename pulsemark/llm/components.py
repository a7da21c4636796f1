"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.llm.sizes import store


def connected(edges: DataFrame, rows: int) -> DataFrame:
    """Rows (node, label) for the nodes of the edges (a, b); the label is the smallest node reachable.

    Large-star and small-star steps alternate until nothing changes, a number of rounds that grows with the
    logarithm of the nodes. ``rows`` bounds the number of edges from above. Neighbours are never gathered in one row: each step is an aggregation and a join.
    """
    current = store(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        "u <> v").distinct(), rows)
    mark = _mark(current)
    while mark[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = store(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), 2 * mark[0])
        after = _mark(new)
        done = after == mark
        current, mark = new, after
        if done:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """The number of edges and a sum over them, which tell one set of edges from another."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def relabel(labels: DataFrame, higher: DataFrame, rows: int) -> DataFrame:
    """Labels after components were merged: ``higher`` maps labels (or nodes without one) to new labels."""
    up = higher.select(F.col("node").alias("label"), F.col("label").alias("_up"))
    moved = labels.join(up, "label", "left").select("node", F.coalesce("_up", "label").alias("label"))
    lone = up.join(labels.select("label").distinct(), "label", "left_anti")
    return store(moved.union(lone.select(F.col("label").alias("node"), F.col("_up").alias("label"))), rows)
