"""Data audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuelens.checks.sql import with_tickets
from queuelens.config import settings
from queuelens.operators import profile
from queuelens.plans.ticket_view import tickets

CONFIG = settings()
QUERIES, SQL = {}, {}

COLUMNS = ["ticket_id", "subject", "body", "type", "queue", "priority", "language", "tag_1", "tag_2", "tag_3"]
TYPES = ["Change", "Incident", "Problem", "Request"]


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


NULLS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, "
    f"round(100.0 * (count(*) - count({c})) / count(*), 1)::DOUBLE AS pct FROM tickets"
    for c in COLUMNS
)


@query("null_profile", with_tickets() + NULLS_SQL)
def null_profile(spark, folder):
    return profile.null_profile(tickets(spark, folder))


@query("columns_with_nulls", with_tickets() + f"SELECT * FROM ({NULLS_SQL}) n WHERE nulls > 0")
def columns_with_nulls(spark, folder):
    return profile.columns_with_nulls(tickets(spark, folder))


@query("type_counts_with_nulls", with_tickets() + "SELECT type AS value, count(*) AS n FROM tickets GROUP BY type")
def type_counts_with_nulls(spark, folder):
    return profile.value_counts(tickets(spark, folder), "type", dropna=False)


@query("language_counts", with_tickets() + "SELECT language AS value, count(*) AS n FROM tickets WHERE language IS NOT NULL GROUP BY language")
def language_counts(spark, folder):
    return profile.value_counts(tickets(spark, folder), "language")


@query(
    "type_shares",
    with_tickets() + "SELECT type AS value, round(count(*) / (SELECT count(type) FROM tickets), 8) AS share FROM tickets "
    "WHERE type IS NOT NULL GROUP BY type",
)
def type_shares(spark, folder):
    return profile.value_shares(tickets(spark, folder), "type").withColumn("share", F.round("share", 8))


@query(
    "priority_counts_in_order",
    with_tickets() + "SELECT CAST(list_position(['low', 'medium', 'high'], priority) AS INTEGER) AS place, priority AS value, "
    "count(*) AS n FROM tickets WHERE priority IN ('low', 'medium', 'high') GROUP BY priority",
)
def priority_counts_in_order(spark, folder):
    return profile.ordered_counts(tickets(spark, folder), "priority", profile.PRIORITY_ORDER)


@query(
    "dominant_priority",
    with_tickets() + "SELECT priority AS dominant, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM tickets), 1)::DOUBLE AS pct, "
    "CASE WHEN 100.0 * count(*) / (SELECT count(*) FROM tickets) > 50 THEN 'SKEWED' ELSE 'BALANCED' END AS verdict "
    "FROM tickets WHERE priority IN ('low', 'medium', 'high') GROUP BY priority ORDER BY n DESC, priority LIMIT 1",
)
def dominant_priority(spark, folder):
    return profile.dominant_value(tickets(spark, folder), "priority", profile.PRIORITY_ORDER)


@query(
    "dominant_language",
    with_tickets() + "SELECT language AS dominant, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM tickets), 1)::DOUBLE AS pct, "
    "CASE WHEN 100.0 * count(*) / (SELECT count(*) FROM tickets) > 50 THEN 'SKEWED' ELSE 'BALANCED' END AS verdict "
    "FROM tickets WHERE language IS NOT NULL GROUP BY language ORDER BY n DESC, language LIMIT 1",
)
def dominant_language(spark, folder):
    return profile.dominant_value(tickets(spark, folder), "language")


@query(
    "distinct_counts",
    with_tickets() + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM tickets" for c in COLUMNS),
)
def distinct_counts(spark, folder):
    return profile.distinct_counts(tickets(spark, folder), COLUMNS)


@query(
    "queue_size_distribution",
    with_tickets() + "SELECT n, count(*) AS n_values FROM (SELECT count(*) AS n FROM tickets WHERE queue IS NOT NULL GROUP BY queue) q GROUP BY n",
)
def queue_size_distribution(spark, folder):
    return profile.counts_of_counts(tickets(spark, folder), "queue")


@query("event_user_distribution", "SELECT n, count(*) AS n_values FROM (SELECT count(*) AS n FROM events GROUP BY user_id) q GROUP BY n")
def event_user_distribution(spark, folder):
    return profile.counts_of_counts(spark.read.parquet(f"{folder}/events.parquet"), "user_id")


IMBALANCE_SQL = (
    "SELECT count(*) AS n_values, arg_min(value, (-n, value)) AS largest, max(n) AS largest_n, "
    "arg_min(value, (n, value)) AS smallest, min(n) AS smallest_n, round(max(n) / min(n), 1) AS ratio FROM c"
)


@query(
    "priority_imbalance",
    with_tickets(("c", "SELECT priority AS value, count(*) AS n FROM tickets WHERE priority IS NOT NULL GROUP BY priority")) + IMBALANCE_SQL,
)
def priority_imbalance(spark, folder):
    return profile.imbalance(tickets(spark, folder), "priority")


@query("brand_imbalance", "WITH c AS (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY p_brand) " + IMBALANCE_SQL)
def brand_imbalance(spark, folder):
    return profile.imbalance(spark.read.parquet(f"{folder}/part.parquet"), "p_brand")


@query(
    "top_queues",
    with_tickets() + "SELECT queue AS value, count(*) AS n FROM tickets WHERE queue IS NOT NULL GROUP BY queue ORDER BY n DESC, value LIMIT 20",
)
def top_queues(spark, folder):
    return profile.top_values(tickets(spark, folder), "queue", 20)


@query("first_tickets", with_tickets() + "SELECT * FROM tickets ORDER BY ticket_id LIMIT 3")
def first_tickets(spark, folder):
    return profile.head(tickets(spark, folder), "ticket_id", 3)


def _crosstab_sql(row: str, column: str, values: list[str]) -> str:
    shares = ", ".join(f"round(count(*) FILTER ({column} = '{v}') / count(*), 8) AS \"{v}\"" for v in values)
    return f"SELECT {row} AS \"row\", {shares} FROM tickets WHERE {row} IS NOT NULL AND {column} IS NOT NULL GROUP BY {row}"


def _rounded(df, values):
    return df.withColumns({v: F.round(v, 8) for v in values})


@query(
    "priority_by_type",
    with_tickets(("shares", _crosstab_sql("priority", "type", TYPES)))
    + "SELECT o.place, o.row, "
    + ", ".join(f"coalesce(\"{v}\", 0.0) AS \"{v}\"" for v in TYPES)
    + " FROM (VALUES (1, 'low'), (2, 'medium'), (3, 'high')) o(place, row) LEFT JOIN shares s ON o.row = s.row",
)
def priority_by_type(spark, folder):
    df = tickets(spark, folder).dropna(subset=["type"])
    table = profile.crosstab(df, "priority", "type", TYPES)
    return _rounded(profile.reindexed(table, profile.PRIORITY_ORDER), TYPES)


@query("language_by_type", with_tickets() + _crosstab_sql("language", "type", TYPES))
def language_by_type(spark, folder):
    return _rounded(profile.crosstab(tickets(spark, folder), "language", "type", TYPES), TYPES)


@query("language_by_priority", with_tickets() + _crosstab_sql("language", "priority", profile.PRIORITY_ORDER))
def language_by_priority(spark, folder):
    table = profile.crosstab(tickets(spark, folder), "language", "priority", profile.PRIORITY_ORDER)
    return _rounded(table, profile.PRIORITY_ORDER)


@query(
    "most_common_type_per_language",
    with_tickets(("c", "SELECT language AS \"row\", type AS value, count(*) AS n FROM tickets WHERE type IS NOT NULL GROUP BY ALL"))
    + "SELECT \"row\", arg_min(value, (-n, value)) AS top_value, round(max(n) / sum(n), 8) AS share FROM c GROUP BY \"row\"",
)
def most_common_type_per_language(spark, folder):
    df = profile.most_common_per_row(tickets(spark, folder), "language", "type")
    return df.withColumn("share", F.round("share", 8))


SPACES = r"[\s\p{Z}\x{0B}\x{1C}-\x{1F}\x{85}]+"
LENGTHS_SQL = (
    "SELECT *, subject_len + body_len AS combined_len FROM (SELECT *, "
    + ", ".join(
        f"len(list_filter(regexp_split_to_array(coalesce({c}, ''), '{SPACES}'), lambda x: x <> '')) AS {c}_len" for c in ("subject", "body")
    )
    + " FROM tickets) t"
)
MEASURED_PARTS = [
    ("lengths", LENGTHS_SQL),
    ("measured", " UNION ALL ".join(f"SELECT '{m}' AS measure, {m} AS words FROM lengths" for m in ("subject_len", "body_len", "combined_len"))),
]


@query(
    "length_stats",
    with_tickets(*MEASURED_PARTS)
    + "SELECT measure, quantile_cont(words, 0.5)::DOUBLE AS median, CAST(max(words) AS INTEGER) AS longest, "
    "round(100.0 * count(*) FILTER (words = 0) / count(*), 1)::DOUBLE AS empty_pct, "
    "round(100.0 * count(*) FILTER (words < 5) / count(*), 1)::DOUBLE AS short_pct, "
    "round(100.0 * count(*) FILTER (words > 512) / count(*), 1)::DOUBLE AS long_pct FROM measured GROUP BY measure",
)
def length_stats(spark, folder):
    return profile.length_stats(tickets(spark, folder), CONFIG)


@query(
    "length_histogram",
    with_tickets(*MEASURED_PARTS, ("pos", "SELECT *, min(words) OVER (PARTITION BY measure) AS lo, max(words) OVER (PARTITION BY measure) AS hi FROM measured WHERE words > 0"))
    + "SELECT measure, CAST(CASE WHEN hi = lo THEN 25 ELSE least(((words - lo) * 50) // (hi - lo), 49) END AS INTEGER) AS bin, count(*) AS n FROM pos GROUP BY ALL",
)
def length_histogram(spark, folder):
    return profile.length_histogram(tickets(spark, folder), CONFIG)


@query(
    "duplicate_rows",
    with_tickets() + "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM tickets GROUP BY "
    + ", ".join(COLUMNS[1:]) + ") g",
)
def duplicate_rows(spark, folder):
    return profile.duplicate_rows(tickets(spark, folder), COLUMNS[1:])


@query(
    "duplicate_texts",
    with_tickets() + "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM tickets GROUP BY subject, body) g",
)
def duplicate_texts(spark, folder):
    return profile.duplicate_rows(tickets(spark, folder), ["subject", "body"])


TAGS = ["tag_1", "tag_2", "tag_3"]


@query(
    "tag_fill",
    with_tickets() + " UNION ALL ".join(
        f"SELECT '{t}' AS \"column\", round(100.0 * count({t}) / count(*), 1)::DOUBLE AS filled_pct, count(DISTINCT {t}) AS n_distinct FROM tickets" for t in TAGS
    ),
)
def tag_fill(spark, folder):
    return profile.tag_fill(tickets(spark, folder))


@query(
    "top_tags",
    with_tickets(("tags", " UNION ALL ".join(f"SELECT {t} AS tag FROM tickets WHERE {t} IS NOT NULL" for t in TAGS)))
    + "SELECT tag, count(*) AS n FROM tags GROUP BY tag ORDER BY n DESC, tag LIMIT 20",
)
def top_tags(spark, folder):
    return profile.top_tags(tickets(spark, folder))


@query(
    "table_shape",
    with_tickets() + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{'bigint' if c == 'ticket_id' else 'string'}' AS type, count(*) AS n_rows FROM tickets" for c in COLUMNS
    ),
)
def table_shape(spark, folder):
    return profile.table_shape(tickets(spark, folder))


@query(
    "labelled_split",
    with_tickets() + "SELECT count(type) AS labelled, count(*) - count(type) AS unlabelled, "
    "round(100.0 * (count(*) - count(type)) / count(*), 1)::DOUBLE AS unlabelled_pct FROM tickets",
)
def labelled_split(spark, folder):
    return profile.labelled_split(tickets(spark, folder), "type")


@query(
    "parameter_advice",
    with_tickets() + "SELECT count(DISTINCT type) AS k_low, 3 * count(DISTINCT type) AS k_high, greatest(30, count(*) // 200) AS min_cluster_size FROM tickets",
)
def parameter_advice(spark, folder):
    return profile.parameter_advice(tickets(spark, folder), "type")


@query(
    "insights",
    with_tickets(("lengths", LENGTHS_SQL))
    + """SELECT count(*) AS n_rows, round(100.0 * count(*) FILTER (type IS NULL) / count(*), 1)::DOUBLE AS type_null_pct,
  round(100.0 * count(*) FILTER (subject IS NULL) / count(*), 1)::DOUBLE AS subject_null_pct,
  count(*) FILTER (body IS NULL) AS body_nulls,
  round(100.0 * count(*) FILTER (language = 'en') / count(*), 1)::DOUBLE AS en_pct,
  round(100.0 * count(*) FILTER (language = 'de') / count(*), 1)::DOUBLE AS de_pct,
  round(100.0 * count(*) FILTER (combined_len < 5) / count(*), 1)::DOUBLE AS short_pct,
  round(100.0 * count(*) FILTER (combined_len > 512) / count(*), 1)::DOUBLE AS over_512_pct,
  quantile_cont(body_len, 0.5)::DOUBLE AS body_median, CAST(max(body_len) AS INTEGER) AS body_max,
  10 AS n_columns, count(DISTINCT queue) AS n_queues,
  (SELECT round(100.0 * max(n) / sum(n), 1)::DOUBLE FROM (SELECT count(*) AS n FROM tickets WHERE priority IS NOT NULL GROUP BY priority) p) AS priority_max_pct,
  (SELECT CASE WHEN 100.0 * max(n) / sum(n) > 50 THEN 'SKEWED' ELSE 'BALANCED' END FROM (SELECT count(*) AS n FROM tickets WHERE priority IS NOT NULL GROUP BY priority) p) AS priority_skew,
  count(DISTINCT type) AS k_low, 3 * count(DISTINCT type) AS k_high, greatest(30, count(*) // 200) AS min_cluster_size,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM tickets GROUP BY subject, body, type, queue, priority, language, tag_1, tag_2, tag_3) g) AS duplicates
FROM lengths""",
)
def insights(spark, folder):
    return profile.insights(tickets(spark, folder), CONFIG)
