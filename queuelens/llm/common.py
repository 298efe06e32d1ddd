"""Words, private columns and small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters, x20 and x09 to x0D. ``bytes.split()`` cuts at just these.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes) -> list[bytes]:
    """The ``WORD`` matches of a text in UTF-8."""
    return text.split()


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, any other letter unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(name: str, docs: DataFrame) -> str:
    """``name``, with underscores in front until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """``docs`` as one struct column ``_given`` beside private columns, whatever its own are called."""
    return docs.select(F.struct(F.col("*")).alias("_given"), *(key.alias(name) for name, key in keys.items()))


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; nulls become empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one holds about ``max_bytes`` of text, or one row.

    Arrow batches are counted in rows; texts differ in length by orders of magnitude.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64)
        part = np.cumsum(size + 64) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def grouped(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.Table]:
    """Record batches cut and joined again into tables of about ``max_bytes`` of text."""
    held, size = [], 0
    for piece in slices(batches, text, max_bytes):
        held.append(piece)
        size += piece.nbytes
        if size >= max_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)
