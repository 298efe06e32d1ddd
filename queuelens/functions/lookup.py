"""Joins against a small side whose size is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame):
    """Bytes of one row: text and vectors by length, anything else as 16."""
    total = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = F.octet_length(column).cast("bigint")
        elif kind in ("array<double>", "array<float>", "array<bigint>", "array<int>"):
            size = F.size(column).cast("bigint") * 8
        elif kind == "array<string>":
            size = F.octet_length(F.array_join(column, ",")).cast("bigint")
        else:
            size = F.lit(16).cast("bigint")
        total = total + F.coalesce(size, F.lit(0).cast("bigint"))
    return total


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True if ``df`` is small in rows and in bytes. Reads no further than ``max_rows``."""
    rows, size = df.limit(max_rows + 1).select(_row_bytes(df).alias("b")).agg(F.count("*"), F.sum("b")).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def join_lookup(big: DataFrame, small: DataFrame, on, how: str = "left", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join that broadcasts ``small`` if it is measured small, else shuffles.

    In the shuffled form AQE splits the partitions of hot keys on the big side.
    """
    return big.join(F.broadcast(small) if fits(small, max_rows) else small, on, how)


def bounded_rows(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a list that must stay small, or raise."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} {what}")
    return rows
