"""Operational vectors of any width, as entries.

A vector is (size, indices, values): places in order and what stands there, no zeros. A column
of flags adds at most one entry to a row, however many values it has, so width costs nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelens.functions.lookup import join_lookup
from queuelens.functions.text import let
from queuelens.operators.metadata import LITERAL_CATEGORIES, ordinal, with_frequency, with_place
from queuelens.session import materialise

ENTRY = "struct<i:bigint,x:double>"


def _entry(place: Column, value: Column) -> Column:
    """An entry, or null where the place is null or the value is null or 0."""
    made = F.struct(place.cast("bigint").alias("i"), value.cast("double").alias("x"))
    return F.when(place.isNotNull() & (value != 0), made)


def vector_of(entries: Column, size) -> Column:
    """A vector from entries in order of their places; nulls and zeros are dropped."""
    kept = F.filter(entries, lambda e: e.isNotNull() & (e["x"] != 0))
    return let(kept, lambda e: F.struct(
        F.lit(size).cast("bigint").alias("size"), F.transform(e, lambda x: x["i"]).alias("indices"), F.transform(e, lambda x: x["x"]).alias("values"),
    ))


def entries_of(vector: Column) -> Column:
    """The entries (i, x) of a vector."""
    return F.zip_with(vector["indices"], vector["values"], lambda i, x: F.struct(i.alias("i"), x.alias("x")))


def encode_sparse(df: DataFrame, config: dict, name: str = "operational") -> DataFrame:
    """Add the vector of ``metadata.encode_metadata`` as entries.

    Flags of a column with more values than a literal list holds are joined by value. The columns
    of ``df`` stay as they are.
    """
    cfg, meta = config["operational_features"], config["data"]["metadata_columns"]
    out, n_kinds = with_place(df, meta["ticket_type"], "_kind_place")
    out, n_channels = with_place(out, meta["channel"], "_channel_place")
    if cfg["product_encoding"] == "frequency":
        out, n_products = with_frequency(out, meta["product"], "_product_share"), 1
        product = _entry(F.lit(1 + n_kinds), F.col("_product_share"))
    else:
        out, n_products = with_place(out, meta["product"], "_product_place")
        product = _entry(1 + n_kinds + F.col("_product_place"), F.lit(1.0))
    entries = F.array(
        _entry(F.lit(0), ordinal(F.col(meta["priority"]), cfg["priority_map"])),
        _entry(1 + F.col("_kind_place"), F.lit(1.0)),
        product,
        _entry(1 + n_kinds + n_products + F.col("_channel_place"), F.lit(1.0)),
    )
    out = out.withColumn(name, vector_of(entries, 1 + n_kinds + n_products + n_channels)).select(*df.columns, name)
    return min_max_scaled(out, name) if cfg.get("normalize", True) else out


def ranges(df: DataFrame, column: str) -> DataFrame:
    """(i, low, high) of each place that any row has an entry at; a row without one counts as 0 there.

    Least and largest values are combined before the shuffle, so a place that all rows share is a row a task.
    """
    rows = df.where(F.col(column).isNotNull())
    total = rows.count()
    found = rows.select(F.explode(entries_of(F.col(column))).alias("e")).groupBy("e.i").agg(
        F.min("e.x").alias("low"), F.max("e.x").alias("high"), F.count("*").alias("n")
    )
    some = F.col("n") < total
    return found.select(
        "i", F.when(some, F.least("low", F.lit(0.0))).otherwise(F.col("low")).alias("low"),
        F.when(some, F.greatest("high", F.lit(0.0))).otherwise(F.col("high")).alias("high"),
    )


def min_max_scaled(df: DataFrame, column: str, listed: int = LITERAL_CATEGORIES) -> DataFrame:
    """Scale each place to [0, 1] over all rows; a constant place becomes 0. Values below 0 are an error.

    Flags that not all rows have stay as they are, so only the few other places are looked up: as
    a literal, or joined by place if there are more than ``listed``. Null vectors stay null.
    """
    moved = materialise(ranges(df, column).where("low <> 0 OR high <> 1"), "ranges")
    if not moved.where("low < 0").isEmpty():
        raise ValueError("a value below 0 would turn absent entries into present ones")
    span = F.when(F.col("high") == F.col("low"), 1.0).otherwise(F.col("high") - F.col("low"))
    table = moved.select("i", "low", span.alias("span"))
    few = table.limit(listed + 1).collect()
    if not few:
        return df
    if len(few) <= listed:
        known = F.create_map(*[v for r in few for v in (F.lit(r.i), F.struct(F.lit(r.low).alias("low"), F.lit(r.span).alias("span")))])

        def scaled(e: Column) -> Column:
            at = F.try_element_at(known, e["i"])
            return F.struct(e["i"].alias("i"), F.when(at.isNull(), e["x"]).otherwise((e["x"] - at["low"]) / at["span"]).alias("x"))

        made = vector_of(F.transform(entries_of(F.col(column)), scaled), F.col(column)["size"])
        return df.withColumn(column, F.when(F.col(column).isNotNull(), made))
    # Rows are numbered where they lie and written, so that entries find their row again.
    held = materialise(df.withColumn("_row_no", F.monotonically_increasing_id()), "numbered")
    entries = held.select("_row_no", F.explode(entries_of(F.col(column))).alias("e")).select("_row_no", "e.i", "e.x")
    found = join_lookup(entries, table, "i")
    value = F.when(F.col("low").isNull(), F.col("x")).otherwise((F.col("x") - F.col("low")) / F.col("span"))
    lists = found.groupBy("_row_no").agg(F.array_sort(F.collect_list(F.struct("i", value.alias("x")))).alias("_entries"))
    none = F.array().cast(f"array<{ENTRY}>")
    joined = held.join(lists, "_row_no", "left")
    made = vector_of(F.coalesce("_entries", none), F.col(column)["size"])
    return joined.withColumn(column, F.when(F.col(column).isNotNull(), made)).select(*df.columns)


def l2_normalised(vector: Column) -> Column:
    """The vector at length 1; one without entries stays as it is."""
    return let(
        F.struct(vector.alias("v"), F.sqrt(F.aggregate(vector["values"], F.lit(0.0), lambda s, x: s + x * x)).alias("norm")),
        lambda s: F.when(s["norm"] == 0, s["v"]).otherwise(s["v"].withField("values", F.transform(s["v"]["values"], lambda x: x / s["norm"]))),
    )


def of_dense(vector: Column) -> Column:
    """A dense vector as entries."""
    entries = F.transform(vector, lambda x, i: F.struct(i.cast("bigint").alias("i"), x.cast("double").alias("x")))
    return F.when(vector.isNotNull(), vector_of(entries, F.size(vector)))


def joined(left: Column, right: Column) -> Column:
    """Two vectors one behind the other."""
    return F.struct(
        (left["size"] + right["size"]).alias("size"),
        F.concat(left["indices"], F.transform(right["indices"], lambda i: i + left["size"])).alias("indices"),
        F.concat(left["values"], right["values"]).alias("values"),
    )


def fused(df: DataFrame, alpha: float | None = None, semantic: str = "semantic", operational: str = "operational", name: str = "vector") -> DataFrame:
    """Add both halves side by side as entries, each at length 1; scaled by ``alpha`` and ``1 - alpha`` if given.

    ``semantic`` is dense, ``operational`` has entries.
    """
    left, right = l2_normalised(of_dense(F.col(semantic))), l2_normalised(F.col(operational))
    if alpha is not None:
        left, right = (v.withField("values", F.transform(v["values"], lambda x: x * F.lit(float(f)))) for v, f in ((left, alpha), (right, 1.0 - alpha)))  # noqa: B023
    return df.withColumn(name, let(F.struct(left.alias("l"), right.alias("r")), lambda s: joined(s["l"], s["r"])))
