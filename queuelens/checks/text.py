"""Text preparation, terms, keywords and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuelens.checks.sql import (
    CLEAN_SQL, KEYWORD_PARTS, RAW_SQL, ROUTED_PARTS, TEST_RULES, with_tickets, words_sql,
)
from queuelens.config import settings
from queuelens.functions import text as tx
from queuelens.functions.words import STOP_WORDS
from queuelens.operators import keywords, prepare, routing, tfidf
from queuelens.plans.ticket_view import given_labels, tickets
from queuelens.sources.tickets import load_data

CONFIG = settings()
KEY = "ticket_id"
QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def clean_texts(spark, folder):
    return prepare.preprocess(tickets(spark, folder), CONFIG).select(KEY, "text")


@query("load_snapshot", "SELECT doc_id, lang, source, n_chars, length(text) AS text_length FROM documents")
def load_snapshot(spark, folder):
    config = settings({"data": {"source": "parquet", "key": "doc_id", "text_columns": ["source", "text"],
                                "metadata_columns": {"channel": "lang", "product": "source", "priority": "n_chars", "ticket_type": "lang"}}})
    df = load_data(spark, f"{folder}/documents.parquet", config)
    return df.select("doc_id", "lang", "source", "n_chars", F.length("text").cast("bigint").alias("text_length"))


@query("clean_text", with_tickets(("clean", CLEAN_SQL)) + "SELECT ticket_id, subject, text FROM clean")
def clean_text(spark, folder):
    return prepare.preprocess(tickets(spark, folder), CONFIG).select(KEY, "subject", "text")


@query("raw_combined_text", with_tickets(("raw", RAW_SQL)) + "SELECT ticket_id, raw_text FROM raw")
def raw_combined_text(spark, folder):
    return prepare.with_raw_text(tickets(spark, folder), CONFIG).select(KEY, "raw_text")


@query("cast_key_to_text", "SELECT vec_id, CAST(vec_id AS VARCHAR) || ' | ' || CAST(label AS VARCHAR) AS text FROM embeddings")
def cast_key_to_text(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    return df.select("vec_id", tx.combined(F.col("vec_id"), F.col("label"), " | ").alias("text"))


@query(
    "word_counts",
    with_tickets()
    + r"""SELECT ticket_id, CAST(subject_len AS INTEGER) AS subject_len, CAST(body_len AS INTEGER) AS body_len,
       CAST(subject_len + body_len AS INTEGER) AS combined_len
FROM (SELECT ticket_id, len(list_filter(regexp_split_to_array(coalesce(subject, ''), '[\s\p{Z}\x{0B}\x{1C}-\x{1F}\x{85}]+'), lambda x: x <> '')) AS subject_len,
             len(list_filter(regexp_split_to_array(coalesce(body, ''), '[\s\p{Z}\x{0B}\x{1C}-\x{1F}\x{85}]+'), lambda x: x <> '')) AS body_len FROM tickets) t""",
)
def word_counts(spark, folder):
    return prepare.with_lengths(tickets(spark, folder), CONFIG).select(KEY, "subject_len", "body_len", "combined_len")


@query(
    "word_tokens",
    with_tickets(("words", words_sql("body", "tickets")))
    + "SELECT term, count(*) AS n FROM words GROUP BY term",
)
def word_tokens(spark, folder):
    counts = tfidf.term_counts(tickets(spark, folder), KEY, "body")
    return tfidf.corpus_frequencies(counts).select("term", F.col("tf").alias("n"))


BIGRAM_PARTS = [
    ("raw", RAW_SQL),
    ("words", words_sql("raw_text", "raw")),
    (
        "grams",
        "SELECT ticket_id, term FROM words UNION ALL SELECT ticket_id, term || ' ' || next FROM (SELECT *, "
        "lead(term) OVER (PARTITION BY ticket_id ORDER BY pos) AS next FROM words) x WHERE next IS NOT NULL",
    ),
    ("tf", "SELECT ticket_id, term, count(*) AS tf FROM grams GROUP BY ALL"),
    ("corpus", "SELECT term, sum(tf) AS tf, count(*) AS df FROM tf GROUP BY term"),
    ("vocab", "SELECT * FROM corpus ORDER BY tf DESC, term LIMIT 15000"),
]


@query(
    "bigram_vocabulary",
    with_tickets(*BIGRAM_PARTS)
    + "SELECT term, CAST(tf AS BIGINT) AS tf, df, round(ln((1 + (SELECT count(*) FROM tickets)) / (1.0 + df)) + 1, 8) AS idf FROM vocab",
)
def bigram_vocabulary(spark, folder):
    df = prepare.with_raw_text(tickets(spark, folder), CONFIG)
    return tfidf.fit(df, KEY, "raw_text", 15000, (1, 2)).withColumn("idf", F.round("idf", 8))


@query(
    "sublinear_weights",
    with_tickets(
        *BIGRAM_PARTS,
        ("w", "SELECT ticket_id, term, (1 + ln(tf.tf)) * (ln((1 + (SELECT count(*) FROM tickets)) / (1.0 + df)) + 1) AS w "
              "FROM tf JOIN vocab USING (term)"),
    )
    + "SELECT ticket_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY ticket_id)), 7) AS weight FROM w",
)
def sublinear_weights(spark, folder):
    df = prepare.with_raw_text(tickets(spark, folder), CONFIG)
    rows = tfidf.fit_transform(df, KEY, "raw_text", 15000, (1, 2), sublinear=True)
    return rows.withColumn("weight", F.round("weight", 7))


@query(
    "corpus_frequencies",
    with_tickets(*KEYWORD_PARTS) + "SELECT term, CAST(tf AS BIGINT) AS tf, df FROM corpus",
)
def corpus_frequencies(spark, folder):
    return tfidf.corpus_frequencies(tfidf.term_counts(clean_texts(spark, folder), KEY, "text", stop_words=STOP_WORDS))


@query("tfidf_weights", with_tickets(*KEYWORD_PARTS) + "SELECT ticket_id, term, round(weight, 7) AS weight FROM weights")
def tfidf_weights(spark, folder):
    rows = keywords.text_weights(clean_texts(spark, folder), KEY, CONFIG)
    return rows.withColumn("weight", F.round("weight", 7))


@query("cluster_term_means", with_tickets(*KEYWORD_PARTS) + "SELECT cluster, term, round(score, 8) AS score FROM means")
def cluster_term_means(spark, folder):
    weights = keywords.text_weights(clean_texts(spark, folder), KEY, CONFIG)
    return keywords.term_means(weights, given_labels(spark, folder), KEY).withColumn("score", F.round("score", 8))


@query(
    "cluster_keywords",
    with_tickets(*KEYWORD_PARTS) + "SELECT cluster, rank, term, round(score, 8) AS score FROM ranked",
)
def cluster_keywords(spark, folder):
    ranked = keywords.cluster_keywords(clean_texts(spark, folder), given_labels(spark, folder), KEY, CONFIG)
    return ranked.withColumn("score", F.round("score", 8))


def _ranked(spark, folder):
    return keywords.cluster_keywords(clean_texts(spark, folder), given_labels(spark, folder), KEY, CONFIG)


@query(
    "rule_overlaps",
    with_tickets(*KEYWORD_PARTS, *ROUTED_PARTS) + "SELECT cluster, CAST(rule_idx AS INTEGER) AS rule_idx, category, overlap FROM shared",
)
def rule_overlaps(spark, folder):
    rules = routing.rule_table(spark, TEST_RULES)
    return routing.rule_overlaps(_ranked(spark, folder), rules).select("cluster", "rule_idx", "category", "overlap")


def route_clusters_on(spark, folder, rules):
    routed = routing.business_interpret(_ranked(spark, folder), routing.rule_table(spark, rules))
    return routed.withColumn("top_keywords", F.array_join("top_keywords", ", "))


@query("route_clusters", with_tickets(*KEYWORD_PARTS, *ROUTED_PARTS) + "SELECT * FROM routed")
def route_clusters(spark, folder):
    return route_clusters_on(spark, folder, TEST_RULES)


@query(
    "route_unmatched_clusters",
    with_tickets(*KEYWORD_PARTS, *ROUTED_PARTS)
    + "SELECT cluster, 'Uncategorized' AS category, 'General Support' AS team, FALSE AS automation, 0.0::DOUBLE AS confidence, top_keywords FROM tops",
)
def route_unmatched_clusters(spark, folder):
    """The stock rules, none of whose words ranks in the test texts."""
    return route_clusters_on(spark, folder, None)


@query(
    "cluster_ticket_texts",
    with_tickets(*KEYWORD_PARTS)
    + "SELECT cluster, count(*) AS n_tickets, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM clean JOIN given USING (ticket_id) "
      "WHERE cluster <> -1 GROUP BY cluster",
)
def cluster_ticket_texts(spark, folder):
    joined = clean_texts(spark, folder).join(given_labels(spark, folder).filter("cluster <> -1"), KEY)
    return joined.groupBy("cluster").agg(F.count("*").alias("n_tickets"), F.sum(F.length("text")).alias("n_chars"))
