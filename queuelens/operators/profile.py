"""Data audit of a ticket table: nulls, counts, shares, lengths, tags, cross-tabs.

Every function is one aggregation over the table. Group-bys combine map-side, so a
value held by a third of the rows costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queuelens.config import key_column
from queuelens.operators.prepare import with_lengths

PRIORITY_ORDER = ["low", "medium", "high"]
SHORT_WORDS = 5
LONG_WORDS = 512


def _percent(part, whole, digits=1):
    return F.round(100 * part / F.nullif(whole, F.lit(0)), digits)


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls, pct) for every column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    )
    long = counts.unpivot(["_n"], list(df.columns), "column", "nulls")
    return long.select("column", "nulls", F.coalesce(_percent(F.col("nulls"), F.col("_n")), F.lit(0.0)).alias("pct"))


def columns_with_nulls(df: DataFrame) -> DataFrame:
    """The columns that hold nulls, fewest first."""
    return null_profile(df).filter("nulls > 0").orderBy("pct", "column")


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """(value, n) per different value."""
    rows = df.filter(F.col(column).isNotNull()) if dropna else df
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """(value, share) with shares of the non-null rows."""
    total = df.agg(F.count(column)).scalar()
    return value_counts(df, column).select("value", (F.col("n") / total).alias("share"))


def ordered_counts(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Counts of the listed values only, with their place in the list."""
    place = F.array_position(F.lit(list(order)), F.col("value"))
    return value_counts(df.filter(F.col(column).isin(list(order))), column).select(
        place.cast("int").alias("place"), "value", "n"
    )


def dominant_value(df: DataFrame, column: str, among: list[str] | None = None) -> DataFrame:
    """The most frequent value, its share of all rows in percent, and the skew verdict."""
    counts = value_counts(df.filter(F.col(column).isin(list(among))) if among else df, column)
    rows = df.agg(F.count(F.lit(1))).scalar()
    top = counts.agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("dominant"), F.max("n").alias("n")
    )
    pct = 100 * F.col("n") / F.nullif(rows, F.lit(0))
    return top.select(
        "dominant", "n", F.round(pct, 1).alias("pct"), F.when(pct > 50, "SKEWED").otherwise("BALANCED").alias("verdict")
    )


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_distinct) without nulls, of all columns in one pass.

    Values are told apart by two hashes, so no text is shuffled and no row carries a set.
    """
    def entry(c):
        hashes = (F.xxhash64(F.col(c)).alias("a"), F.xxhash64(F.lit(7), F.col(c)).alias("b"))
        return F.struct(F.lit(c).alias("column"), F.col(c).isNull().alias("empty"), *hashes)

    cells = df.select(F.explode(F.array(*[entry(c) for c in columns])).alias("e")).select("e.*")
    found = cells.groupBy("column", "empty", "a", "b").agg(F.lit(1).alias("one"))
    return found.groupBy("column").agg(F.count_if(~F.col("empty")).alias("n_distinct"))


def counts_of_counts(df: DataFrame, column: str) -> DataFrame:
    """How many values have n rows."""
    return value_counts(df, column).groupBy("n").agg(F.count("*").alias("n_values"))


def imbalance(df: DataFrame, column: str) -> DataFrame:
    """Largest and smallest value and the ratio of their counts."""
    counts = value_counts(df, column)
    return counts.agg(
        F.count("*").alias("n_values"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("largest"),
        F.max("n").alias("largest_n"),
        F.min_by("value", F.struct(F.col("n"), F.col("value"))).alias("smallest"),
        F.min("n").alias("smallest_n"),
        F.round(F.max("n") / F.min("n"), 1).alias("ratio"),
    )


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values; ties go to the smaller value."""
    return value_counts(df, column).orderBy(F.desc("n"), "value").limit(n)


def head(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(key).limit(n)


def crosstab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Share of each listed ``column`` value within every ``row`` value.

    Shares are of the rows where both columns are set, whatever the value.
    """
    rows = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    n = F.count(F.lit(1))
    return rows.groupBy(F.col(row).alias("row")).agg(
        *[(F.count_if(F.col(column) == v) / n).alias(v) for v in values]
    )


def reindexed(table: DataFrame, order: list[str]) -> DataFrame:
    """Only the listed rows of a cross-tab, absent ones as zeros."""
    listed = table.sparkSession.createDataFrame([(i + 1, v) for i, v in enumerate(order)], "place int, row string")
    return listed.join(table, "row", "left").fillna(0.0)


def most_common_per_row(df: DataFrame, row: str, column: str) -> DataFrame:
    """Per ``row`` value the most common ``column`` value and its share."""
    rows = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    counts = rows.groupBy(F.col(row).alias("row"), F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.groupBy("row").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top_value"),
        (F.max("n") / F.sum("n")).alias("share"),
    )


def length_counts(df: DataFrame, config: dict) -> DataFrame:
    """(measure, words, n): how many tickets have each word count. Small for any table."""
    lengths = ["subject_len", "body_len", "combined_len"]
    long = with_lengths(df, config).select(*lengths).unpivot([], lengths, "measure", "words")
    return long.groupBy("measure", "words").agg(F.count("*").alias("n"))


def length_stats(df: DataFrame, config: dict) -> DataFrame:
    """Median and maximum word count, and the shares of empty, short and long texts."""
    words, n = F.col("words"), F.col("n")

    def share(condition):
        return F.round(100 * F.sum(F.when(condition, n).otherwise(0)) / F.sum(n), 1)

    return length_counts(df, config).groupBy("measure").agg(
        F.expr("percentile(words, 0.5, n)").alias("median"),
        F.max(words).alias("longest"),
        share(words == 0).alias("empty_pct"),
        share(words < SHORT_WORDS).alias("short_pct"),
        share(words > LONG_WORDS).alias("long_pct"),
    )


def length_histogram(df: DataFrame, config: dict, bins: int = 50) -> DataFrame:
    """Equal-width bins of the positive word counts; the last bin is closed."""
    counts = length_counts(df, config).filter("words > 0")
    whole = Window.partitionBy("measure")
    low, high = F.min("words").over(whole), F.max("words").over(whole)
    placed = counts.withColumns({"low": low, "high": high}).withColumn(
        "bin",
        F.when(F.col("high") == F.col("low"), F.lit(bins // 2)).otherwise(
            F.least(
                F.floor((F.col("words") - F.col("low")) * bins / F.nullif(F.col("high") - F.col("low"), F.lit(0))),
                F.lit(bins - 1),
            )
        ).cast("int"),
    )
    return placed.groupBy("measure", "bin").agg(F.sum("n").alias("n"))


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equal rows.

    Rows are compared by a SHA-256 of their values, so no long text is shuffled.
    """
    names = columns or df.columns
    digest = F.sha2(F.to_json(F.struct(*names)), 256)
    groups = df.groupBy(digest.alias("digest")).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def tag_columns(df: DataFrame, prefix: str = "tag_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def tag_counts(df: DataFrame, prefix: str = "tag_") -> DataFrame:
    """(column, tag, n) over all tag columns, nulls counted as a null tag."""
    tags = tag_columns(df, prefix)
    return df.select(*tags).unpivot([], tags, "column", "tag").groupBy("column", "tag").agg(F.count("*").alias("n"))


def tag_fill(df: DataFrame, prefix: str = "tag_") -> DataFrame:
    """Fill rate and number of different tags per tag column."""
    filled = F.sum(F.when(F.col("tag").isNotNull(), F.col("n")).otherwise(0))
    return tag_counts(df, prefix).groupBy("column").agg(
        F.round(100 * filled / F.sum("n"), 1).alias("filled_pct"), F.count("tag").alias("n_distinct")
    )


def top_tags(df: DataFrame, n: int = 20, prefix: str = "tag_") -> DataFrame:
    """The most frequent tags over all tag columns together."""
    tags = tag_counts(df, prefix).filter("tag IS NOT NULL").groupBy("tag").agg(F.sum("n").alias("n"))
    return tags.orderBy(F.desc("n"), "tag").limit(n)


def table_shape(df: DataFrame) -> DataFrame:
    """(column, type, n_rows) per column."""
    kinds = df.sparkSession.createDataFrame(df.dtypes, "column string, type string")
    return kinds.withColumn("n_rows", df.agg(F.count(F.lit(1))).scalar())


def labelled_split(df: DataFrame, column: str) -> DataFrame:
    """Counts of rows with and without a label."""
    n = F.count(F.lit(1))
    return df.agg(
        F.count(column).alias("labelled"),
        F.count_if(F.col(column).isNull()).alias("unlabelled"),
        _percent(F.count_if(F.col(column).isNull()), n).alias("unlabelled_pct"),
    )


def parameter_advice(df: DataFrame, type_column: str) -> DataFrame:
    """Suggested range of k and least density-cluster size."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    kinds = value_counts(df, type_column).agg(F.count("*").alias("k_low"))
    return kinds.select("k_low", (F.col("k_low") * 3).alias("k_high")).withColumn(
        "min_cluster_size", F.greatest(F.lit(30).cast("bigint"), F.floor(rows / 200))
    )


def insights(df: DataFrame, config: dict) -> DataFrame:
    """The audit as one row.

    Three passes: the plain counts, the values of priority, type and queue counted together,
    and the repeated rows.
    """
    meta, (subject, body) = config["data"]["metadata_columns"], config["data"]["text_columns"]
    priority, kind, queue, language = (meta[c] for c in ("priority", "ticket_type", "product", "channel"))
    n = F.count(F.lit(1))

    def null_pct(c):
        return _percent(F.count_if(F.col(c).isNull()), n)

    lengths = with_lengths(df, config)
    base = lengths.agg(
        n.alias("n_rows"),
        null_pct(kind).alias("type_null_pct"),
        null_pct(subject).alias("subject_null_pct"),
        F.count_if(F.col(body).isNull()).alias("body_nulls"),
        _percent(F.count_if(F.col(language) == "en"), n).alias("en_pct"),
        _percent(F.count_if(F.col(language) == "de"), n).alias("de_pct"),
        _percent(F.count_if(F.col("combined_len") < SHORT_WORDS), n).alias("short_pct"),
        _percent(F.count_if(F.col("combined_len") > LONG_WORDS), n).alias("over_512_pct"),
        F.percentile("body_len", 0.5).alias("body_median"),
        F.max("body_len").alias("body_max"),
    )
    named = {"p": priority, "t": kind, "q": queue}
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("c"), F.col(v).cast("string").alias("v")) for k, v in named.items()])).alias("e"))
    counted = cells.select("e.*").filter("v IS NOT NULL").groupBy("c", "v").agg(F.count("*").alias("m"))
    values = counted.agg(
        F.count_if(F.col("c") == "q").alias("n_queues"),
        F.count_if(F.col("c") == "t").alias("k_low"),
        (F.max(F.when(F.col("c") == "p", F.col("m"))) / F.sum(F.when(F.col("c") == "p", F.col("m")))).alias("_top"),
    )
    repeats = duplicate_rows(df, [c for c in df.columns if c != key_column(config)])
    # Three tables of one row each.
    joined = base.crossJoin(F.broadcast(values)).crossJoin(F.broadcast(repeats.toDF("duplicates")))
    return joined.select(
        *base.columns,
        F.lit(len(df.columns)).alias("n_columns"),
        "n_queues",
        F.round(100 * F.col("_top"), 1).alias("priority_max_pct"),
        F.when(100 * F.col("_top") > 50, "SKEWED").otherwise("BALANCED").alias("priority_skew"),
        "k_low",
        (3 * F.col("k_low")).alias("k_high"),
        F.greatest(F.lit(30).cast("bigint"), F.floor(F.col("n_rows") / 200)).alias("min_cluster_size"),
        "duplicates",
    )
