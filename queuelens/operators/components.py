"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.session import materialise, scratch


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every id in ``edges`` (src, dst); the label is the least id reachable.

    Rounds of hooking to the least neighbour and shortening, each a few joins.
    """
    with scratch(edges.sparkSession) as keep:
        return keep(_labelled(edges))


def _labelled(edges: DataFrame) -> DataFrame:
    ids = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    labels = materialise(ids.select("id", F.col("id").alias("label")), "labels")
    live = edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).filter("a <> b").distinct()
    live = materialise(live, "live-edges")
    while not live.isEmpty():
        # Every label with a smaller neighbour hooks to the least one; chains are then shortened.
        hooks = materialise(live.groupBy("a").agg(F.min("b").alias("b")), "hooks")
        while True:
            nxt = hooks.alias("h").join(hooks.alias("n"), F.col("h.b") == F.col("n.a"), "left")
            nxt = nxt.select("h.a", F.coalesce("n.b", "h.b").alias("b"), F.col("n.a").isNotNull().alias("moved"))
            nxt = materialise(nxt, "hooks")
            hooks = nxt.select("a", "b")
            if nxt.filter("moved").isEmpty():
                break

        def relabel(df: DataFrame, column: str) -> DataFrame:
            found = df.join(hooks.select(F.col("a").alias(column), F.col("b").alias("_new")), column, "left")
            return found.withColumn(column, F.coalesce("_new", column)).drop("_new")

        labels = materialise(relabel(labels, "label"), "labels")
        moved = relabel(relabel(live, "a"), "b").filter("a <> b")
        live = materialise(moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "live-edges")
    return labels
