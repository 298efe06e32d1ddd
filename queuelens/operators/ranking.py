"""Consecutive numbers over a sorted table, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queuelens.session import materialise


def with_position(df: DataFrame, order: list, name: str = "pos") -> DataFrame:
    """Add each row's place (from 0) in the total order of ``order``.

    Rows are range-partitioned and written; each part counts on from the sizes of the
    parts before it.
    """
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    stored = materialise(parts, "ranked")
    sizes = sorted(stored.groupBy("_part").count().collect())  # one row per partition
    offsets, total = {}, 0
    for part, n in sizes:
        offsets[part], total = total, total + n
    table = F.lit([offsets.get(p, 0) for p in range(max(offsets, default=-1) + 1)]).cast("array<bigint>")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return stored.withColumn(name, inside - 1 + table[F.col("_part")]).drop("_part")
