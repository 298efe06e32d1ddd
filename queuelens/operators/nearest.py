"""Assign vectors to the nearest centroid, in batch or on a stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_NUMBERS = 4_000_000  # of centroids that are sent to the tasks together


def centroid_blocks(centroids: DataFrame, numbers: int = BLOCK_NUMBERS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(unit vectors, clusters) by cluster, a block at a time; the driver holds one block."""
    names, rows, size = [], [], 0
    for row in centroids.select(F.col("cluster").cast("int"), "centroid").orderBy("cluster").toLocalIterator():
        vector = np.asarray(row.centroid, dtype=float)
        names.append(row.cluster)
        rows.append(vector / (np.linalg.norm(vector) or 1.0))
        size += len(vector)
        if size >= numbers:
            yield np.stack(rows), np.array(names)
            names, rows, size = [], [], 0
    if rows:
        yield np.stack(rows), np.array(names)


def nearer(vector: Column, best: Column, block) -> Column:
    """The better of ``best`` (cosine, cluster) and the most similar centroid of a broadcast block.

    The lower cluster wins ties; a null vector has no nearest centroid.
    """

    @F.pandas_udf("cosine double, cluster int")
    def score(vectors: pd.Series, missing: pd.Series, cosine: pd.Series, cluster: pd.Series) -> pd.DataFrame:
        matrix, names = block.value
        top = cosine.to_numpy(dtype=float, na_value=np.nan).copy()
        name = cluster.astype("Int32").to_numpy(dtype=object, na_value=None).copy()
        given = np.flatnonzero(~missing.to_numpy(dtype=bool))
        if len(given):
            stack = np.stack(vectors.iloc[given].to_numpy()).astype(float)
            norms = np.linalg.norm(stack, axis=1, keepdims=True)
            cosines = stack / np.where(norms == 0, 1, norms) @ matrix.T
            place = cosines.argmax(1)
            found = cosines[np.arange(len(place)), place]
            better = ~(found <= top[given])  # also where there is none yet
            top[given[better]] = found[better]
            name[given[better]] = names[place[better]]
        return pd.DataFrame({"cosine": pd.array(np.where(pd.isna(name), np.nan, top), dtype="Float64"), "cluster": pd.array(name, dtype="Int32")})

    # The vector is named twice, so the planner computes it before the call and not inside it.
    return score(vector, vector.isNull(), best["cosine"], best["cluster"])


def assign(df: DataFrame, centroids: DataFrame, vector: str = "semantic", block_numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """Add ``cluster`` and ``cosine`` of the nearest centroid; both null for a null vector.

    Centroids go to the tasks in blocks of a fixed size, however many there are. No rows are
    shuffled or multiplied, so the same works on a stream. The blocks in turn keep the best so
    far. Without any centroid both columns are null.
    """
    none = F.lit(None)
    found = df.withColumn("_nearest", F.struct(none.cast("double").alias("cosine"), none.cast("int").alias("cluster")))
    for block in centroid_blocks(centroids, block_numbers):
        shared = df.sparkSession.sparkContext.broadcast(block)
        found = found.withColumn("_nearest", nearer(F.col(vector), F.col("_nearest"), shared))
    return found.withColumns({"cluster": F.col("_nearest.cluster"), "cosine": F.col("_nearest.cosine")}).drop("_nearest")
