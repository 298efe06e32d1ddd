"""Connected components by alternating star contraction, each round a few joins and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.session import materialise, scratch


def component_labels(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(_node, _label) for every end of an edge (_a, _b): the least node of its component.

    A large-star step hangs each node's larger neighbours on its least neighbour, a small-star
    step does so with the smaller ones. Both only move edges, so no table is larger than the
    edges given. A step's table lies in the shared folder, so it survives lost executors.
    """
    with scratch(edges.sparkSession) as keep:
        current = keep(_contracted(edges, max_rounds))
    roots = current.select(F.col("_b").alias("_node"), F.col("_b").alias("_label")).distinct()
    return current.select(F.col("_a").alias("_node"), F.col("_b").alias("_label")).unionByName(roots)


def _contracted(edges: DataFrame, max_rounds: int) -> DataFrame:
    """(_a, _b): every node but the least of a component, hung on that."""
    current = materialise(_tidy(edges.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b"))), "edges")
    before = None
    for _ in range(max_rounds):
        current = materialise(_small_star(_large_star(current)), "edges")
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)"))).first())
        if now == before:
            return current
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where("_a <> _b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges (_a > _b) after each node's larger neighbours moved to the least of node and neighbours."""
    least = edges.groupBy("_a").agg(F.min("_b").alias("_m")).withColumnRenamed("_a", "_n")
    moved = edges.join(least, edges._b == least._n, "left").select("_a", F.coalesce("_m", "_b").alias("_b"))
    return moved.where("_a <> _b")  # the small-star step drops repeats


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges (_a > _b) after each node's smaller neighbours moved to the least of them."""
    least = edges.groupBy("_a").agg(F.min("_b").alias("_m")).withColumnRenamed("_a", "_n")
    joined = edges.join(least, edges._a == least._n)
    moved = joined.where("_b <> _m").select(F.col("_b").alias("_a"), F.col("_m").alias("_b"))
    own = least.select(F.col("_n").alias("_a"), F.col("_m").alias("_b"))
    return _tidy(moved.unionByName(own))
