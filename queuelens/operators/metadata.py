"""Operational columns of a ticket as one numeric vector."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelens.functions.lookup import join_lookup
from queuelens.operators.profile import value_shares
from queuelens.operators.ranking import with_position
from queuelens.session import materialise

LITERAL_CATEGORIES = 1000


def ordinal(column: Column, ranks: dict) -> Column:
    """Rank of a value; 0 where it is null or not listed."""
    if not ranks:
        return F.lit(0.0)
    table = F.create_map(*[F.lit(x) for name, rank in ranks.items() for x in (name, float(rank))])
    return F.coalesce(F.try_element_at(table, column), F.lit(0.0))


def with_place(df: DataFrame, column: str, name: str) -> tuple[DataFrame, int]:
    """Add each value's place among the sorted values of its column (null for null); returns their
    number too.

    A short list travels as a literal, a longer one is joined; either way the rows are the same.
    """
    values = df.select(column).distinct().filter(F.col(column).isNotNull())
    rows = values.limit(LITERAL_CATEGORIES + 1).collect()
    if len(rows) <= LITERAL_CATEGORIES:
        listed = sorted(row[0] for row in rows)
        if not listed:
            return df.withColumn(name, F.lit(None).cast("bigint")), 0
        place = F.array_position(F.lit(listed), F.col(column)) - 1
        return df.withColumn(name, F.when(place >= 0, place)), len(listed)
    placed = with_position(values, [column], name).select(F.col(column), F.col(name).cast("bigint").alias(name))
    return join_lookup(df, placed, column), placed.count()


def flags(place: Column, width: int) -> Column:
    """One 0/1 entry per value; all 0 where the place is null."""
    if not width:
        return F.array().cast("array<double>")
    at = F.sequence(F.lit(0).cast("bigint"), F.lit(width - 1).cast("bigint"))
    return F.transform(at, lambda i: F.coalesce((place == i).cast("double"), F.lit(0.0)))


def one_hot_sparse(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the flags of a column of any width as (size, indices, values), at most one entry each."""
    placed, width = with_place(df, column, "_place")
    none = F.col("_place").isNull()
    entry = F.struct(
        F.lit(width).alias("size"),
        F.when(none, F.array().cast("array<int>")).otherwise(F.array(F.col("_place").cast("int"))).alias("indices"),
        F.when(none, F.array().cast("array<double>")).otherwise(F.array(F.lit(1.0))).alias("values"),
    )
    return placed.withColumn(name, entry).select(*df.columns, name)


def with_frequency(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the share that a row's value has among the non-null rows; 0 for null."""
    shares = value_shares(df, column).select(F.col("value").alias(column), F.col("share").alias(name))
    return join_lookup(df, materialise(shares, "shares"), column).withColumn(name, F.coalesce(name, F.lit(0.0)))


def _extremes(df: DataFrame, column: str) -> DataFrame:
    """(low, high): the least and largest value of each dimension, in one row of one pass."""
    vectors = df.filter(F.col(column).isNotNull()).select(array_to_vector(column).alias("v"))
    found = vectors.select(Summarizer.metrics("min", "max").summary(F.col("v")).alias("s"))
    return found.select(vector_to_array("s.min").alias("low"), vector_to_array("s.max").alias("high"))


def vector_ranges(df: DataFrame, column: str) -> DataFrame:
    """(dim, low, high) over all rows of a vector column."""
    if df.filter(F.col(column).isNotNull()).isEmpty():
        return df.sparkSession.createDataFrame([], "dim int, low double, high double")
    rows = _extremes(df, column).select(F.posexplode(F.arrays_zip("low", "high")).alias("dim", "r"))
    return rows.select("dim", "r.low", "r.high")


def min_max_scaled(df: DataFrame, column: str) -> DataFrame:
    """Scale each dimension to [0, 1]; a constant dimension becomes 0."""
    if df.filter(F.col(column).isNotNull()).isEmpty():
        return df
    row = _extremes(df, column).first()  # two vectors, each as long as one row's
    low, span = F.lit(list(row.low)), F.lit([(b - a) or 1.0 for a, b in zip(row.low, row.high)])
    moved = F.zip_with(column, low, lambda x, lo: x - lo)
    return df.withColumn(column, F.zip_with(moved, span, lambda x, s: x / s))


def encode_metadata(df: DataFrame, config: dict, name: str = "operational") -> DataFrame:
    """Add the operational vector: priority rank, type flags, product, channel flags.

    Reads the columns named in ``data.metadata_columns``. The product is its share of
    the table, or flags if ``product_encoding`` is not ``frequency``.
    """
    cfg, meta = config["operational_features"], config["data"]["metadata_columns"]
    out, n_kinds = with_place(df, meta["ticket_type"], "_kind_place")
    out, n_channels = with_place(out, meta["channel"], "_channel_place")
    if cfg["product_encoding"] == "frequency":
        out = with_frequency(out, meta["product"], "_product_share")
        product = F.array("_product_share")
    else:
        out, n_products = with_place(out, meta["product"], "_product_place")
        product = flags(F.col("_product_place"), n_products)
    out = out.withColumn(
        name,
        F.concat(
            F.array(ordinal(F.col(meta["priority"]), cfg["priority_map"])),
            flags(F.col("_kind_place"), n_kinds),
            product,
            flags(F.col("_channel_place"), n_channels),
        ),
    ).select(*df.columns, name)
    return min_max_scaled(out, name) if cfg.get("normalize", True) else out
