"""Feature encoding, embeddings and fusion."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuelens.checks.sql import CLEAN_SQL, with_tickets, words_sql
from queuelens.config import settings
from queuelens.functions import vectors as vx
from queuelens.operators import embed, fusion, metadata, prepare, sparse
from queuelens.plans.ticket_view import tickets

CONFIG = settings()
KEY = "ticket_id"
QUERIES, SQL = {}, {}
TYPES = ["Change", "Incident", "Problem", "Request"]


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def long_form(df, key: str, column: str, digits: int = 7):
    """One row (key, dim, value) per entry that is not 0."""
    rows = df.select(key, F.posexplode_outer(column).alias("dim", "value"))
    return rows.select(key, "dim", (F.round("value", digits) + F.lit(0.0)).alias("value")).filter("value <> 0")


RANKS_SQL = "coalesce(CASE priority WHEN 'very_low' THEN 0 WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 WHEN 'critical' THEN 4 END, 0)"


@query("priority_rank", with_tickets() + f"SELECT ticket_id, {RANKS_SQL}::DOUBLE AS rank FROM tickets")
def priority_rank(spark, folder):
    ranks = CONFIG["operational_features"]["priority_map"]
    return tickets(spark, folder).select(KEY, metadata.ordinal(F.col("priority"), ranks).alias("rank"))


@query(
    "order_priority_rank",
    "SELECT o_orderkey, (CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 1 ELSE 0 END)::DOUBLE AS rank FROM orders",
)
def order_priority_rank(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    ranks = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "5-LOW": 1}
    return orders.select("o_orderkey", metadata.ordinal(F.col("o_orderpriority"), ranks).alias("rank"))


@query(
    "type_flags",
    with_tickets() + "SELECT ticket_id, " + ", ".join(f"(coalesce(type = '{t}', FALSE))::INTEGER::DOUBLE AS {t}" for t in TYPES) + " FROM tickets",
)
def type_flags(spark, folder):
    df, width = metadata.with_place(tickets(spark, folder), "type", "_place")
    flags = df.withColumn("flags", metadata.flags(F.col("_place"), width))
    return flags.select(KEY, *[F.col("flags")[i].alias(v) for i, v in enumerate(TYPES)])


@query(
    "one_hot_wide",
    "SELECT o_orderkey, (SELECT count(DISTINCT o_custkey) FROM orders) AS width, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS place, 1.0::DOUBLE AS value FROM orders",
)
def one_hot_wide(spark, folder):
    """Flags of a column with more values than a literal list holds."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    rows = metadata.one_hot_sparse(orders, "o_custkey", "flags")
    return rows.select("o_orderkey", F.col("flags.size").cast("bigint").alias("width"), F.col("flags.indices")[0].alias("place"), F.col("flags.values")[0].alias("value"))


WIDE = {
    "operational_features": {"priority_map": {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "5-LOW": 1}},
    "data": {"metadata_columns": {"priority": "o_orderpriority", "ticket_type": "o_orderstatus", "product": "o_orderdate", "channel": "o_custkey"}},
}
WIDE_SQL = """
WITH s AS (SELECT o_orderdate AS d, count(*) / (SELECT count(o_orderdate) FROM orders) AS share FROM orders WHERE o_orderdate IS NOT NULL GROUP BY o_orderdate),
o AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 4.0 WHEN '2-HIGH' THEN 3.0 WHEN '3-MEDIUM' THEN 2.0 WHEN '5-LOW' THEN 1.0 ELSE 0.0 END AS prio,
  dense_rank() OVER (ORDER BY o_orderstatus) AS kind, (SELECT count(DISTINCT o_orderstatus) FROM orders) AS kinds, coalesce(share, 0) AS share,
  dense_rank() OVER (ORDER BY o_custkey) AS channel FROM orders LEFT JOIN s ON o_orderdate = d),
r AS (SELECT o_orderkey, kind, kinds, channel, prio / (SELECT max(prio) FROM o) AS prio,
  (share - (SELECT min(share) FROM o)) / coalesce(nullif((SELECT max(share) - min(share) FROM o), 0), 1) AS share FROM o),
e AS (SELECT o_orderkey, 0 AS dim, prio AS value FROM r UNION ALL SELECT o_orderkey, kind, 1.0 FROM r
  UNION ALL SELECT o_orderkey, kinds + 1, share FROM r UNION ALL SELECT o_orderkey, kinds + 1 + channel, 1.0 FROM r)
SELECT o_orderkey, CAST(dim AS INTEGER) AS dim, round(CAST(value / sqrt(sum(value * value) OVER (PARTITION BY o_orderkey)) AS DOUBLE), 7) AS value FROM e
QUALIFY round(CAST(value / sqrt(sum(value * value) OVER (PARTITION BY o_orderkey)) AS DOUBLE), 7) <> 0
"""


@query("operational_vectors_wide", WIDE_SQL)
def operational_vectors_wide(spark, folder):
    """Priority, status, share of the date and flags of the customer, scaled and at length 1, as entries alone."""
    rows = sparse.encode_sparse(spark.read.parquet(f"{folder}/orders.parquet"), settings(WIDE))
    unit = rows.select("o_orderkey", F.explode(sparse.entries_of(sparse.l2_normalised(F.col("operational")))).alias("e"))
    value = F.round("e.x", 7)
    return unit.select("o_orderkey", F.col("e.i").cast("int").alias("dim"), value.alias("value")).filter("value <> 0")


@query(
    "queue_frequency",
    with_tickets() + "SELECT ticket_id, round(coalesce(count(queue) OVER (PARTITION BY queue) / (SELECT count(queue) FROM tickets), 0), 8) AS share FROM tickets",
)
def queue_frequency(spark, folder):
    return metadata.with_frequency(tickets(spark, folder), "queue", "share").select(KEY, F.round("share", 8).alias("share"))


@query(
    "type_frequency_with_nulls",
    with_tickets() + "SELECT ticket_id, round(CASE WHEN type IS NULL THEN 0 ELSE count(type) OVER (PARTITION BY type) / (SELECT count(type) FROM tickets) END, 8)::DOUBLE AS share FROM tickets",
)
def type_frequency_with_nulls(spark, folder):
    return metadata.with_frequency(tickets(spark, folder), "type", "share").select(KEY, F.round("share", 8).alias("share"))


@query(
    "brand_frequency",
    "SELECT p_partkey, round(count(p_brand) OVER (PARTITION BY p_brand) / (SELECT count(p_brand) FROM part), 8) AS share FROM part",
)
def brand_frequency(spark, folder):
    part = spark.read.parquet(f"{folder}/part.parquet")
    return metadata.with_frequency(part, "p_brand", "share").select("p_partkey", F.round("share", 8).alias("share"))


# Long form of the unscaled operational vector: rank, type flags, queue share, language flags.
OPERATIONAL_PARTS = [
    ("kinds", "SELECT value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS place FROM (SELECT DISTINCT type AS value FROM tickets WHERE type IS NOT NULL) t"),
    ("langs", "SELECT value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS place FROM (SELECT DISTINCT language AS value FROM tickets WHERE language IS NOT NULL) t"),
    ("shares", "SELECT queue, count(*) / (SELECT count(queue) FROM tickets) AS share FROM tickets WHERE queue IS NOT NULL GROUP BY queue"),
    (
        "op",
        f"SELECT ticket_id, 0 AS dim, {RANKS_SQL}::DOUBLE AS value FROM tickets "
        "UNION ALL SELECT ticket_id, k.place, (coalesce(type = k.value, FALSE))::INTEGER::DOUBLE FROM tickets, kinds k "
        "UNION ALL SELECT ticket_id, (SELECT count(*) FROM kinds) + 1, coalesce(share, 0)::DOUBLE FROM tickets LEFT JOIN shares USING (queue) "
        "UNION ALL SELECT ticket_id, (SELECT count(*) FROM kinds) + 1 + l.place, (coalesce(language = l.value, FALSE))::INTEGER::DOUBLE FROM tickets, langs l",
    ),
    ("ranges", "SELECT dim, min(value) AS low, max(value) AS high FROM op GROUP BY dim"),
    ("scaled_op", "SELECT ticket_id, dim, CASE WHEN high = low THEN 0 ELSE (value - low) / (high - low) END AS value FROM op JOIN ranges USING (dim)"),
]


@query(
    "operational_vectors_unscaled",
    with_tickets(*OPERATIONAL_PARTS) + "SELECT ticket_id, CAST(dim AS INTEGER) AS dim, round(value, 7) AS value FROM op WHERE round(value, 7) <> 0",
)
def operational_vectors_unscaled(spark, folder):
    config = settings({"operational_features": {"normalize": False}})
    return long_form(metadata.encode_metadata(tickets(spark, folder), config), KEY, "operational")


@query("feature_ranges", with_tickets(*OPERATIONAL_PARTS) + "SELECT CAST(dim AS INTEGER) AS dim, round(low, 7) AS low, round(high, 7) AS high FROM ranges")
def feature_ranges(spark, folder):
    config = settings({"operational_features": {"normalize": False}})
    ranges = metadata.vector_ranges(metadata.encode_metadata(tickets(spark, folder), config), "operational")
    return ranges.select("dim", F.round("low", 7).alias("low"), F.round("high", 7).alias("high"))


@query(
    "operational_vectors",
    with_tickets(*OPERATIONAL_PARTS) + "SELECT ticket_id, CAST(dim AS INTEGER) AS dim, round(value, 7) AS value FROM scaled_op WHERE round(value, 7) <> 0",
)
def operational_vectors(spark, folder):
    return long_form(metadata.encode_metadata(tickets(spark, folder), CONFIG), KEY, "operational")


@query(
    "operational_vectors_product_flags",
    with_tickets(
        *OPERATIONAL_PARTS,
        ("queues", "SELECT value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS place FROM (SELECT DISTINCT queue AS value FROM tickets) t"),
        (
            "wide",
            "SELECT ticket_id, dim, value FROM scaled_op WHERE dim <= (SELECT count(*) FROM kinds) "
            "UNION ALL SELECT ticket_id, (SELECT count(*) FROM kinds) + q.place, (queue = q.value)::INTEGER::DOUBLE FROM tickets, queues q "
            "UNION ALL SELECT ticket_id, dim - 1 + (SELECT count(*) FROM queues), value FROM scaled_op WHERE dim > (SELECT count(*) FROM kinds) + 1",
        ),
    )
    + "SELECT ticket_id, CAST(dim AS INTEGER) AS dim, round(value, 7) AS value FROM wide WHERE round(value, 7) <> 0",
)
def operational_vectors_product_flags(spark, folder):
    config = settings({"operational_features": {"product_encoding": "onehot"}})
    return long_form(metadata.encode_metadata(tickets(spark, folder), config), KEY, "operational")


def _hashed(words: str, key: str = "ticket_id") -> str:
    return (
        f"SELECT {key}, CAST(('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS INTEGER) AS dim, "
        f"CAST(sum(CASE WHEN substr(md5(term), 9, 1) < '8' THEN 1 ELSE -1 END) AS DOUBLE) AS value FROM {words} GROUP BY ALL"
    )


HASHED_PARTS = [
    ("clean", CLEAN_SQL),
    ("words", words_sql("text", "clean")),
    ("sem", _hashed("words")),
]


def semantic(spark, folder):
    df = prepare.preprocess(tickets(spark, folder), CONFIG)
    return embed.generate_embeddings(df, CONFIG)


@query("hashing_embeddings", with_tickets(*HASHED_PARTS) + "SELECT * FROM sem WHERE value <> 0")
def hashing_embeddings(spark, folder):
    return long_form(semantic(spark, folder), KEY, "semantic")


@query(
    "precomputed_embeddings",
    with_tickets() + "SELECT ticket_id, CAST(d - 1 AS INTEGER) AS dim, round(embedding[d]::DOUBLE, 7) AS value FROM "
    "(SELECT ticket_id, embedding, unnest(range(1, 65)) AS d FROM tickets JOIN embeddings ON ticket_id = vec_id) x WHERE round(embedding[d]::DOUBLE, 7) <> 0",
)
def precomputed_embeddings(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").withColumnRenamed("vec_id", KEY)
    embedder = embed.PrecomputedEmbedder(table, KEY, "embedding", 64)
    return long_form(embed.generate_embeddings(tickets(spark, folder), CONFIG, embedder, text="body"), KEY, "semantic")


@query("distinct_tags", with_tickets() + "SELECT DISTINCT tag_1 AS tag FROM tickets WHERE tag_1 IS NOT NULL AND tag_1 <> 'Unknown'")
def distinct_tags(spark, folder):
    return embed.distinct_tags(tickets(spark, folder), "tag_1")


@query("tag_sentinel", with_tickets() + "SELECT coalesce(tag_2, 'Unknown') AS tag, count(*) AS n FROM tickets GROUP BY ALL")
def tag_sentinel(spark, folder):
    df = tickets(spark, folder).select(F.coalesce("tag_2", F.lit(embed.UNKNOWN)).alias("tag"))
    return df.groupBy("tag").agg(F.count("*").alias("n"))


ENRICHED_PARTS = [
    *HASHED_PARTS,
    ("tags", "SELECT DISTINCT tag_1 AS tag FROM tickets WHERE tag_1 IS NOT NULL"),
    ("tag_words", "SELECT tag, unnest(regexp_extract_all(lower(tag), '[\\p{L}\\p{N}_]{2,}')) AS term FROM tags"),
    ("tag_vecs", _hashed("tag_words", "tag")),
    (
        "enriched",
        "SELECT ticket_id, dim, value FROM sem UNION ALL SELECT ticket_id, dim + 64, 0.3::DOUBLE * value FROM tickets JOIN tag_vecs ON tag_1 = tag",
    ),
]


def enriched(spark, folder):
    return embed.enrich_with_tag_embeddings(semantic(spark, folder), CONFIG)


@query("tag_enrichment", with_tickets(*ENRICHED_PARTS) + "SELECT ticket_id, dim, round(value, 7) AS value FROM enriched WHERE round(value, 7) <> 0")
def tag_enrichment(spark, folder):
    return long_form(enriched(spark, folder), KEY, "semantic")


@query(
    "unit_length_rows",
    with_tickets(*HASHED_PARTS) + "SELECT ticket_id, dim, round(value / sqrt(sum(value * value) OVER (PARTITION BY ticket_id)), 7) AS value FROM sem WHERE value <> 0",
)
def unit_length_rows(spark, folder):
    df = semantic(spark, folder)
    return long_form(df.withColumn("semantic", vx.l2_normalised(F.col("semantic"))), KEY, "semantic")


FUSED_PARTS = [
    *ENRICHED_PARTS,
    *OPERATIONAL_PARTS,
    ("sem_unit", "SELECT ticket_id, dim, value / sqrt(sum(value * value) OVER (PARTITION BY ticket_id)) AS value FROM enriched WHERE value <> 0"),
    ("op_unit", "SELECT ticket_id, 128 + dim AS dim, value / sqrt(sum(value * value) OVER (PARTITION BY ticket_id)) AS value FROM scaled_op WHERE value <> 0"),
]


def _fused_sql(left: str, right: str) -> str:
    return (
        f"SELECT ticket_id, CAST(dim AS INTEGER) AS dim, round({left} * value, 7) AS value FROM sem_unit WHERE round({left} * value, 7) <> 0 "
        f"UNION ALL SELECT ticket_id, CAST(dim AS INTEGER) AS dim, round({right} * value, 7) AS value FROM op_unit WHERE round({right} * value, 7) <> 0"
    )


def both_vectors(spark, folder):
    return metadata.encode_metadata(enriched(spark, folder), CONFIG)


@query("concatenate_fusion", with_tickets(*FUSED_PARTS) + _fused_sql("1.0::DOUBLE", "1.0::DOUBLE"))
def concatenate_fusion(spark, folder):
    return long_form(fusion.concatenate_fusion(both_vectors(spark, folder)), KEY, "vector")


@query("weighted_fusion", with_tickets(*FUSED_PARTS) + _fused_sql("0.7::DOUBLE", "(1.0 - 0.7)::DOUBLE"))
def weighted_fusion(spark, folder):
    return long_form(fusion.weighted_fusion(both_vectors(spark, folder), 0.7), KEY, "vector")


@query(
    "join_vectors",
    with_tickets(*OPERATIONAL_PARTS)
    + "SELECT ticket_id, CAST(count(*) FILTER (value <> 0) AS INTEGER) AS n_set, round(sum(value), 6) AS total FROM "
    "(SELECT ticket_id, value FROM scaled_op WHERE ticket_id IN (SELECT vec_id FROM embeddings) UNION ALL "
    "SELECT vec_id, unnest(embedding)::DOUBLE FROM embeddings WHERE vec_id IN (SELECT ticket_id FROM tickets)) x GROUP BY ticket_id",
)
def join_vectors(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    left = vectors.select(F.col("vec_id").alias(KEY), vx.as_doubles(F.col("embedding")).alias("semantic"))
    right = metadata.encode_metadata(tickets(spark, folder), CONFIG).select(KEY, "operational")
    both = F.concat("semantic", "operational")
    return fusion.join_vectors(left, right, KEY).select(
        KEY,
        F.size(F.filter(both, lambda x: x != 0)).alias("n_set"),
        F.round(F.aggregate(both, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
    )


@query("word2vec_embeddings")
def word2vec_embeddings(spark, folder):
    df = prepare.preprocess(tickets(spark, folder), CONFIG)
    rows = embed.generate_embeddings(df, CONFIG, embed.Word2VecEmbedder(dim=16))
    return long_form(rows, KEY, "semantic")
