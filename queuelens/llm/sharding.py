"""Sharding by jump consistent hashing.

The shard of a row depends on its key and the number of shards alone. The published loop draws
pseudorandom jumps from the key and stops at the last one below the number of shards, so no ring
is stored, shards get equal shares of the keys, and with shards appended only those rows move
that the new shards take.

Shards are written as Parquet, a folder each. A shard is dealt over as many tasks and files as
its bytes ask for (AQE splits what REBALANCE deals), so neither a large shard nor a key that a
third of the rows share ends in one task. A row's slot is its rank in its shard by key; it is
found on the narrow columns, by a range partitioning whose last column is the row's own place
in the files, so ties are split as well.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelens.functions.lookup import join_lookup
from queuelens.session import materialise, new_table_path

MULTIPLIER = 2862933555777941757  # fixed value of the published function
ROW_BYTES = 8  # what a row takes beside its text
SHARD = "shard"


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, 0 to ``shards`` - 1."""
    if shards < 1:
        raise ValueError("at least one shard")
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        state = state * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state >> np.uint64(33)).astype(np.float64) + 1.0
        to = ((at[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        on = to < shards
        live, state = live[on], state[on]
        at[live] = to[on]
    return at


def shard_of(key: Column, shards: int) -> Column:
    """``jump`` of a column of longs; a null counts as key -1."""

    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return F.pandas_udf(run, "int")(F.coalesce(key, F.lit(-1).cast("bigint")))


def key_of(rows: DataFrame, key: str) -> Column:
    """The 64-bit key of a row: whole numbers as they are, anything else by its hash."""
    column = F.col(f"`{key}`")
    whole = isinstance(rows.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return column.cast("bigint") if whole else F.when(column.isNotNull(), F.xxhash64(column))


def write_shards(rows: DataFrame, key: str, shards: int) -> str:
    """Write the rows to a new folder below the shared one, a folder a shard; returns its path.

    A file has the row as a struct ``row``, whatever its columns are called, and its ``key``.
    """
    path = new_table_path(rows.sparkSession, "shards")
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), key_of(rows, key).alias("key"))
    dealt = keyed.withColumn(SHARD, shard_of(F.col("key"), shards)).hint("rebalance", SHARD)
    dealt.write.partitionBy(SHARD).parquet(path, compression="zstd")
    return path


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(shard, file, place, key, row) of every row; file and place in it tell rows apart."""
    whole = T.StructType([T.StructField("row", schema), T.StructField("key", T.LongType()), T.StructField(SHARD, T.IntegerType())])
    read = spark.read.schema(whole).parquet(path)
    return read.select(SHARD, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"), "key", "row")


def with_slots(rows: DataFrame) -> DataFrame:
    """Adds ``slot`` to rows with (shard, key, file, place): the rank in the shard, from 0, by key.

    Nulls come first; equal keys are ranked by file and place. The rows are range partitioned and
    written in order, then a file's share of a shard starts where the files before it end.
    """
    order = [SHARD, "key", "file", "place"]
    ranked = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order), "shard-order")
    read = ranked.withColumn("_file", F.col("_metadata.file_name")).withColumn("_at", F.col("_metadata.row_index"))
    share = read.groupBy(SHARD, "_file").agg(F.count("*").alias("_rows"), F.min("_at").alias("_low"))
    before = Window.partitionBy(SHARD).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    first = share.select(SHARD, "_file", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_low")).alias("_first"))
    placed = join_lookup(read, first, [SHARD, "_file"], "inner")
    return placed.withColumn("slot", F.col("_first") + F.col("_at")).select(*rows.columns, "slot")


def shard_texts(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the documents in shards and reports on each from the files: (doc_id, size, text_crc32,
    law, shard, slot, grown_shard).

    ``size`` is the text's UTF-8 bytes and ``ROW_BYTES``; a null text has none and the checksum
    of an empty one. ``grown_shard`` is the shard with one more. Rows that repeat an id share its
    shard and have a slot each, rows without an id lie in one shard, as equal keys do. Equal texts
    under different ids are different keys. An empty table gives no rows. Other columns, whatever
    their names, are written with the row.
    """
    spark = docs.sparkSession
    written = read_shards(spark, write_shards(docs, doc_id, shards), docs.schema)
    held = F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit(""))
    narrow = written.select(
        F.col(f"row.`{doc_id}`").alias("doc_id"), SHARD, "key", "file", "place",
        (F.octet_length(held) + ROW_BYTES).cast("bigint").alias("size"), F.crc32(held.cast("binary")).alias("text_crc32"),
    )
    found = with_slots(materialise(narrow, "shard-rows"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), SHARD, "slot",
        shard_of(F.col("key"), shards + 1).alias("grown_shard"),
    )
