"""SQL pieces that several reference queries share."""

from __future__ import annotations

from queuelens.functions.words import STOP_WORDS
from queuelens.plans.ticket_view import GIVEN_LABELS_SQL, TICKETS_SQL

# A second rule set of words that occur in the test texts, and the same as SQL.
TEST_RULES = [
    ("Articles", "Desk A", True, ["la", "der", "die", "les", "une", "des"]),
    ("Fragments", "Desk B", False, ["er", "re", "th", "nd", "ti", "ing", "tion"]),
    ("Endings", "Desk C", True, ["ble", "ment", "heit", "keit", "ung", "aux"]),
    ("Particles", "Desk D", False, ["que", "en", "un", "de", "el", "los"]),
    ("Stems", "Desk E", False, ["ou", "ha", "ea", "sh", "st", "nt", "es"]),
]


def _literal(value) -> str:
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(_literal(v) for v in value) + "]"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


RULES_SQL = "SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join([str(i)] + [_literal(v) for v in rule]) + ")" for i, rule in enumerate(TEST_RULES)
) + ") r(rule_idx, category, team, automation, keywords)"

STOP_SQL = "SELECT unnest(" + _literal(STOP_WORDS) + ") AS term"

CLEAN_SQL = r"""
SELECT *, trim(regexp_replace(regexp_replace(lower(coalesce(subject, '') || ' ' || coalesce(body, '')),
       '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM tickets
"""

RAW_SQL = "SELECT *, coalesce(subject, '') || ' ' || coalesce(body, '') AS raw_text FROM tickets"


def words_sql(text: str, source: str) -> str:
    """Positions and words of a text column."""
    return (
        f"SELECT ticket_id, generate_subscripts(w, 1) AS pos, unnest(w) AS term FROM "
        f"(SELECT ticket_id, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM {source}) x"
    )


def with_tickets(*parts: tuple[str, str]) -> str:
    """``WITH tickets AS (...), name AS (...), ...`` before a final SELECT."""
    named = [("tickets", TICKETS_SQL), *parts]
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in named) + "\n"


# Weights of cleaned texts under the 5,000 most frequent terms, stop words left out.
KEYWORD_PARTS = [
    ("clean", CLEAN_SQL),
    ("given", GIVEN_LABELS_SQL),
    ("stops", STOP_SQL),
    ("words", words_sql("text", "clean")),
    ("tf", "SELECT ticket_id, term, count(*) AS tf FROM words WHERE term NOT IN (SELECT term FROM stops) GROUP BY ALL"),
    ("corpus", "SELECT term, sum(tf) AS tf, count(*) AS df FROM tf GROUP BY term"),
    ("vocab", "SELECT * FROM corpus ORDER BY tf DESC, term LIMIT 5000"),
    (
        "raw",
        "SELECT ticket_id, term, tf.tf * (ln((1 + (SELECT count(*) FROM clean)) / (1.0 + df)) + 1) AS w "
        "FROM tf JOIN vocab USING (term)",
    ),
    ("weights", "SELECT ticket_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY ticket_id)) AS weight FROM raw"),
    ("sizes", "SELECT cluster, count(*) AS size FROM given WHERE cluster <> -1 GROUP BY cluster"),
    (
        "means",
        "SELECT cluster, term, sum(weight) / any_value(size) AS score FROM weights JOIN given USING (ticket_id) "
        "JOIN sizes USING (cluster) GROUP BY cluster, term",
    ),
    (
        "ranked",
        "SELECT * FROM (SELECT cluster, term, score, CAST(row_number() OVER (PARTITION BY cluster "
        "ORDER BY round(score, 9) DESC, term) AS INTEGER) AS rank FROM means) x WHERE rank <= 10",
    ),
]

ROUTED_PARTS = [
    ("rules", RULES_SQL),
    ("rule_words", "SELECT rule_idx, category, team, automation, len(keywords) AS n_words, unnest(keywords) AS term FROM rules"),
    (
        "shared",
        "SELECT cluster, rule_idx, category, team, automation, n_words, count(*) AS overlap "
        "FROM ranked JOIN rule_words USING (term) GROUP BY ALL",
    ),
    (
        "best",
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY overlap DESC, rule_idx) AS place "
        "FROM shared) x WHERE place = 1",
    ),
    ("tops", "SELECT cluster, string_agg(term, ', ' ORDER BY rank) AS top_keywords FROM ranked WHERE rank <= 5 GROUP BY cluster"),
    (
        "routed",
        "SELECT tops.cluster, coalesce(category, 'Uncategorized') AS category, coalesce(team, 'General Support') AS team, "
        "coalesce(automation, FALSE) AS automation, coalesce(round(overlap / n_words, 2), 0.0) AS confidence, top_keywords "
        "FROM tops LEFT JOIN best USING (cluster)",
    ),
]
