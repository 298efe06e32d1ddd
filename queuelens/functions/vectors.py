"""Dense vector expressions over ``array<double>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from queuelens.functions.text import let


def as_doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def squared_norm(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x)


def l2_normalised(vec: Column) -> Column:
    """``vec`` at length 1; a zero vector stays as it is."""
    return let(
        F.struct(vec.alias("v"), F.sqrt(squared_norm(vec)).alias("norm")),
        lambda s: F.when(s["norm"] == 0, s["v"]).otherwise(F.transform(s["v"], lambda x: x / s["norm"])),
    )


def scaled(vec: Column, factor: float) -> Column:
    return F.transform(vec, lambda x: x * F.lit(float(factor)))


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def cosine(left: Column, right: Column) -> Column:
    """Cosine of the angle; 0 if either vector is zero."""
    size = F.sqrt(squared_norm(left)) * F.sqrt(squared_norm(right))
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(left, right) / F.nullif(size, F.lit(0.0)))


def fingerprint(vec: Column) -> Column:
    """128-bit key of a vector: equal vectors, and in practice only those, share it."""
    plain = F.transform(vec, lambda x: x + F.lit(0.0))  # -0.0 becomes 0.0
    return let(plain, lambda v: F.struct(F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(7), v).alias("h2")))
