"""Terms that set each cluster apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queuelens.functions.words import STOP_WORDS
from queuelens.operators import tfidf

NOISE = -1
SCORE_DIGITS = 9


def group_columns(df: DataFrame) -> list[str]:
    """What names a group: the cluster, and its run where several are looked at together."""
    return [c for c in ("run", "cluster") if c in df.columns]


def cluster_sizes(labels: DataFrame) -> DataFrame:
    """Rows per cluster, noise (-1) included."""
    return labels.groupBy(*group_columns(labels)).agg(F.count("*").alias("size"))


def term_means(weights: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Mean weight of each term over all texts of a cluster; absent terms count as 0.

    ``labels`` may hold several runs: the weights are then read and placed once for all.
    ``weights`` are rows (key, term, weight), or a list of them per text (key, entries), which
    meets its cluster as one row.
    """
    group = group_columns(labels)
    members = labels.filter(F.col("cluster") != NOISE).select(key, *group)
    rows = weights.join(members, key)
    if "entries" in weights.columns:
        rows = tfidf.weight_rows(rows, *group)
    sums = rows.groupBy(*group, "term").agg(F.sum("weight").alias("total"))
    return sums.join(cluster_sizes(members), group).select(*group, "term", (F.col("total") / F.col("size")).alias("score"))


def ranked_keywords(means: DataFrame, top_n: int) -> DataFrame:
    """The ``top_n`` terms per cluster as (cluster, rank, term, score).

    Order is by the score at 9 digits, then by term, so sums taken in another order
    rank alike. Terms a cluster does not hold are not listed.
    """
    group = group_columns(means)
    order = Window.partitionBy(*group).orderBy(F.desc(F.round("score", SCORE_DIGITS)), "term")
    ranked = means.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_n)
    return ranked.select(*group, "rank", "term", "score")


def keyword_lists(ranked: DataFrame) -> DataFrame:
    """One row (cluster, keywords) with the terms in rank order (at most top-n each)."""
    pairs = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy(*group_columns(ranked)).agg(F.transform(pairs, lambda p: p["term"]).alias("keywords"))


def weight_lists(texts: DataFrame, key: str, config: dict, text: str = "text") -> DataFrame:
    """(key, entries): the TF-IDF weights that keyword lists are drawn from; the same for every clustering."""
    cfg = config["evaluation"]
    return tfidf.fit_lists(
        texts, key, text, max_features=cfg.get("max_features", 5000), stop_words=cfg.get("stop_words", STOP_WORDS)
    )


def text_weights(texts: DataFrame, key: str, config: dict, text: str = "text") -> DataFrame:
    """:func:`weight_lists` as rows (key, term, weight)."""
    return tfidf.weight_rows(weight_lists(texts, key, config, text), key)


def cluster_keywords(texts: DataFrame, labels: DataFrame, key: str, config: dict, text: str = "text", weights: DataFrame | None = None) -> DataFrame:
    """Ranked keywords per cluster, with idf taken over the whole corpus."""
    if weights is None:
        weights = weight_lists(texts, key, config, text)
    return ranked_keywords(term_means(weights, labels, key), config["evaluation"]["top_n_keywords"])
