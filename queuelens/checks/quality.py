"""Evaluation of given clusterings, routing to centroids, label training views."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queuelens.checks.features import HASHED_PARTS, semantic
from queuelens.checks.sql import KEYWORD_PARTS, ROUTED_PARTS, TEST_RULES, with_tickets
from queuelens.checks.text import clean_texts
from queuelens.config import settings
from queuelens.functions import vectors as vx
from queuelens.operators import evaluate, impute, kmeans, routing
from queuelens.operators import silhouette as sil
from queuelens.operators.nearest import assign
from queuelens.operators.neighbours import CELL_ROWS, build, core_distances, distinct_points, nearest_neighbours, squared_distances, stacked
from queuelens.operators.ranking import with_position
from queuelens.operators.spanning import spanning_trees
from queuelens.plans.sweeps import grid_table, recommended_k
from queuelens.session import materialise
from queuelens.sources.sinks import evaluation_summary
from queuelens.sources.tickets import spread
from queuelens.plans.ticket_view import GIVEN_LABELS_SQL, given_labels, tickets

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


def embedding_points(spark, folder):
    """(ticket_id, vector, cluster) of the whole embeddings table."""
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    return df.select(F.col("vec_id").alias(KEY), vx.as_doubles(F.col("embedding")).alias("vector"), F.col("label").alias("cluster"))


POINTS = "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label AS cluster FROM embeddings"


def silhouette_parts(distance: str) -> list[tuple[str, str]]:
    """Silhouette of each row of ``pts`` (id, v, cluster) under a distance of p.v and q.v."""
    return [
        ("sizes", "SELECT cluster, count(*) AS n FROM pts GROUP BY cluster"),
        ("sums", f"SELECT p.id, p.cluster, q.cluster AS other, sum({distance}) AS s FROM pts p, pts q GROUP BY ALL"),
        ("own", "SELECT id, sums.cluster, CASE WHEN n > 1 THEN s / (n - 1) END AS a FROM sums JOIN sizes ON sums.cluster = sizes.cluster WHERE other = sums.cluster"),
        ("next", "SELECT id, min(s / n) AS b FROM sums JOIN sizes ON other = sizes.cluster WHERE other <> sums.cluster GROUP BY id"),
        ("scores", "SELECT id, cluster, CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM own JOIN next USING (id)"),
    ]


def _with(parts):
    return "WITH " + ", ".join(f"{n} AS ({b})" for n, b in parts) + " "


EUCLIDEAN = "list_distance(p.v, q.v)"
SQUARED = "list_distance(p.v, q.v) ** 2"


def drawn(source: str, key: str = "id", seed: int = 42, size: int = 5000) -> str:
    """The same random rows as ``silhouette.random_points``."""
    return f"SELECT * FROM ({source}) s ORDER BY md5('{seed}:' || {key}), {key} LIMIT {size}"


@query(
    "silhouette_sampled",
    _with([("pts", drawn(POINTS, size=300)), *silhouette_parts(EUCLIDEAN)]) + "SELECT round(avg(s), 6) AS silhouette FROM scores",
)
def silhouette_sampled(spark, folder):
    sample = sil.sample_points(embedding_points(spark, folder), KEY, 300)
    return sil.point_silhouettes(sample).agg(F.round(F.avg("silhouette"), 6).alias("silhouette"))


@query(
    "silhouette_per_cluster",
    _with([("pts", drawn(POINTS)), *silhouette_parts(EUCLIDEAN)])
    + "SELECT cluster, count(*) AS n, round(avg(s), 6) AS silhouette, round(min(s), 6) AS lowest FROM scores GROUP BY cluster",
)
def silhouette_per_cluster(spark, folder):
    sample = sil.sample_points(embedding_points(spark, folder), KEY, 5000)
    return sil.point_silhouettes(sample).groupBy("cluster").agg(
        F.count("*").alias("n"), F.round(F.avg("silhouette"), 6).alias("silhouette"), F.round(F.min("silhouette"), 6).alias("lowest")
    )


@query(
    "silhouette_of_first_rows",
    _with([("pts", POINTS + " ORDER BY vec_id LIMIT 2000"), *silhouette_parts(EUCLIDEAN)]) + "SELECT round(avg(s), 6) AS silhouette FROM scores",
)
def silhouette_of_first_rows(spark, folder):
    sample = sil.head_points(embedding_points(spark, folder), KEY, 2000)
    return sil.point_silhouettes(sample).agg(F.round(F.avg("silhouette"), 6).alias("silhouette"))


@query(
    "silhouette_all_rows_squared",
    _with([("pts", POINTS), *silhouette_parts(SQUARED)]) + "SELECT round(avg(s), 6) AS silhouette FROM scores",
)
def silhouette_all_rows_squared(spark, folder):
    value = sil.full_silhouette(embedding_points(spark, folder))
    return spark.range(1).select(F.round(F.lit(value), 6).alias("silhouette"))


@query("random_sample", drawn(f"SELECT * FROM ({GIVEN_LABELS_SQL}) g WHERE cluster <> -1", "ticket_id", size=400))
def random_sample(spark, folder):
    return sil.sample_points(given_labels(spark, folder), KEY, 400, seed=42)


@query("cluster_sizes", f"SELECT cluster, count(*) AS size FROM ({GIVEN_LABELS_SQL}) g GROUP BY cluster")
def cluster_sizes(spark, folder):
    return evaluate.keywords.cluster_sizes(given_labels(spark, folder))


@query("cluster_ids", f"SELECT DISTINCT cluster FROM ({GIVEN_LABELS_SQL}) g WHERE cluster <> -1")
def cluster_ids(spark, folder):
    return evaluate.cluster_ids(given_labels(spark, folder))


@query(
    "cluster_totals",
    f"SELECT count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters, count(*) FILTER (cluster = -1) AS noise_count, "
    f"round(100.0 * count(*) FILTER (cluster = -1) / count(*), 6)::DOUBLE AS noise_pct FROM ({GIVEN_LABELS_SQL}) g",
)
def cluster_totals(spark, folder):
    return evaluate.cluster_totals(given_labels(spark, folder)).withColumn("noise_pct", F.round("noise_pct", 6))


@query(
    "tickets_with_clusters",
    with_tickets(("given", GIVEN_LABELS_SQL)) + "SELECT ticket_id, type, queue, language, cluster AS cluster_given FROM tickets JOIN given USING (ticket_id)",
)
def tickets_with_clusters(spark, folder):
    df = tickets(spark, folder).select(KEY, "type", "queue", "language")
    return evaluate.attach_labels(df, given_labels(spark, folder), KEY, "cluster_given")


# Semantic vectors of the tickets as lists, for distances in SQL.
TICKET_POINTS = [
    *HASHED_PARTS,
    (
        "vecs",
        "SELECT t.ticket_id AS id, list(coalesce(s.value, 0.0) ORDER BY d.dim) AS v FROM tickets t CROSS JOIN (SELECT unnest(range(0, 64)) AS dim) d "
        "LEFT JOIN sem s ON s.ticket_id = t.ticket_id AND s.dim = d.dim GROUP BY t.ticket_id",
    ),
]
LANGUAGE_LABELS = "SELECT ticket_id, CAST(list_position(['de', 'en', 'es', 'fr'], language) - 1 AS INTEGER) AS cluster FROM tickets"


def language_labels(spark, folder):
    place = F.array_position(F.lit(["de", "en", "es", "fr"]), F.col("language")) - 1
    return tickets(spark, folder).select(KEY, place.cast("int").alias("cluster"))


def _vectors(spark, folder):
    return semantic(spark, folder).select(KEY, F.col("semantic").alias("vector"))


KEYWORDS_ONLY = [p for p in KEYWORD_PARTS if p[0] not in ("clean", "words", "sizes")]
EVALUATED_PARTS = [
    *TICKET_POINTS,
    *[p for p in KEYWORD_PARTS if p[0] not in ("clean", "words")],
]


@query(
    "evaluate_given_clusters",
    with_tickets(
        *[(n, b) if n != "sizes" else ("cluster_sizes", b) for n, b in EVALUATED_PARTS if n not in ("means", "ranked")],
        *[(n, b.replace("JOIN sizes", "JOIN cluster_sizes")) for n, b in EVALUATED_PARTS if n in ("means", "ranked")],
        ("pts", drawn("SELECT id, v, cluster FROM vecs JOIN given ON ticket_id = id WHERE cluster <> -1")),
        *silhouette_parts(EUCLIDEAN),
    )
    + "SELECT r.cluster, size, string_agg(term, ' ' ORDER BY rank) AS keywords, (SELECT round(avg(s), 5) FROM scores) AS silhouette "
    "FROM ranked r JOIN cluster_sizes c ON r.cluster = c.cluster GROUP BY r.cluster, size",
)
def evaluate_given_clusters(spark, folder):
    result = evaluate.evaluate(_vectors(spark, folder), given_labels(spark, folder), clean_texts(spark, folder), CONFIG)
    lists = evaluate.keywords.keyword_lists(result.keywords)
    return result.sizes.join(lists, "cluster").select(
        "cluster", "size", F.array_join("keywords", " ").alias("keywords"), F.round(F.lit(result.silhouette), 5).alias("silhouette")
    )


@query(
    "evaluate_run_report",
    with_tickets(*KEYWORD_PARTS, *ROUTED_PARTS)
    + "SELECT 'by_source' AS run, r.cluster, size, category, team, automation, confidence, top_keywords FROM routed r JOIN sizes s ON r.cluster = s.cluster",
)
def evaluate_run_report(spark, folder):
    rules = routing.rule_table(spark, TEST_RULES)
    result = evaluate.evaluate_run(_vectors(spark, folder), given_labels(spark, folder), clean_texts(spark, folder), CONFIG, rules=rules)
    report = evaluate.cluster_report(result, "by_source").drop("keywords")
    return report.withColumn("top_keywords", F.array_join("top_keywords", ", "))


def _run_sql(run: str, labels: str) -> str:
    parts = [("pts", drawn(f"SELECT id, v, cluster FROM vecs JOIN ({labels}) l ON ticket_id = id WHERE cluster <> -1")), *silhouette_parts(EUCLIDEAN)]
    return (
        f"SELECT * FROM ({_with(parts)} SELECT '{run}' AS run, (SELECT round(avg(s), 5) FROM scores) AS silhouette, "
        f"count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters, count(*) FILTER (cluster = -1) AS noise_count FROM ({labels}) a) z"
    )


@query(
    "run_summary",
    with_tickets(*TICKET_POINTS) + _run_sql("by_source", GIVEN_LABELS_SQL) + " UNION ALL " + _run_sql("by_language", LANGUAGE_LABELS),
)
def run_summary(spark, folder):
    vectors, out = _vectors(spark, folder), None
    for run, labels in (("by_source", given_labels(spark, folder)), ("by_language", language_labels(spark, folder))):
        value = evaluate.run_silhouette(vectors, labels, CONFIG)
        part = evaluate.run_report(evaluate.keywords.cluster_sizes(labels), run, value)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("silhouette", F.round("silhouette", 5))


@query(
    "grid_table",
    with_tickets() + "SELECT priority, max(n) FILTER (language = 'de') AS de, max(n) FILTER (language = 'en') AS en, max(n) FILTER (language = 'fr') AS fr "
    "FROM (SELECT priority, language, count(*) AS n FROM tickets GROUP BY ALL) g GROUP BY priority",
)
def parameter_grid_table(spark, folder):
    grid = tickets(spark, folder).groupBy("priority", "language").agg(F.count("*").alias("n"))
    return grid_table(grid, "priority", "language", "n", ["de", "en", "fr"])


CENTROID_PARTS = [
    ("pts", POINTS),
    ("means", "SELECT cluster, d, avg(v[d]) AS x FROM (SELECT cluster, v, unnest(range(1, 65)) AS d FROM pts) e GROUP BY cluster, d"),
    ("centroids", "SELECT cluster, list(x ORDER BY d) AS c FROM means GROUP BY cluster"),
]


@query("cluster_centroids", _with(CENTROID_PARTS) + "SELECT cluster, CAST(d - 1 AS INTEGER) AS dim, round(x, 7) AS value FROM means")
def cluster_centroids(spark, folder):
    rows = kmeans.centroids(embedding_points(spark, folder)).select("cluster", F.posexplode("centroid").alias("dim", "value"))
    return rows.withColumn("value", F.round("value", 7))


@query(
    "nearest_centroid",
    _with([*CENTROID_PARTS, ("near", "SELECT id, centroids.cluster, list_cosine_similarity(v, c) AS s FROM pts, centroids")])
    + "SELECT id AS ticket_id, CAST(arg_min(cluster, (-round(s, 9), cluster)) AS INTEGER) AS cluster, round(max(s), 6) AS cosine FROM near GROUP BY id",
)
def nearest_centroid(spark, folder):
    points = embedding_points(spark, folder)
    routed = assign(points.drop("cluster"), kmeans.centroids(points), "vector")
    return routed.select(KEY, "cluster", F.round("cosine", 6).alias("cosine"))


@query(
    "nearest_centroid_with_nulls",
    _with([*CENTROID_PARTS, ("near", "SELECT id, centroids.cluster, list_cosine_similarity(v, c) AS s FROM pts, centroids")])
    + "SELECT id AS ticket_id, CASE WHEN id % 7 <> 0 THEN CAST(arg_min(cluster, (-round(s, 9), cluster)) AS INTEGER) END AS cluster, "
    "CASE WHEN id % 7 <> 0 THEN round(max(s), 6) END AS cosine FROM near GROUP BY id",
)
def nearest_centroid_with_nulls(spark, folder):
    """Some vectors are null, and the centroids come in several blocks."""
    points = embedding_points(spark, folder)
    some = points.select(KEY, F.when(F.col(KEY) % 7 != 0, F.col("vector")).alias("vector"))
    routed = assign(some, kmeans.centroids(points), "vector", block_numbers=200)
    return routed.select(KEY, "cluster", F.round("cosine", 6).alias("cosine"))


@query(
    "evaluation_summary_records",
    with_tickets(*KEYWORD_PARTS, *ROUTED_PARTS)
    + "SELECT 'by_source' AS run, g.cluster, g.size, (SELECT count(DISTINCT cluster) FROM given WHERE cluster <> -1) AS n_clusters, "
    "(SELECT count(*) FROM given WHERE cluster = -1) AS noise_count, category, team, automation, confidence, top_keywords "
    "FROM (SELECT cluster, count(*) AS size FROM given GROUP BY cluster) g LEFT JOIN routed r ON g.cluster = r.cluster",
)
def evaluation_summary_records(spark, folder):
    """One record per cluster, noise included."""
    labels, rules = given_labels(spark, folder), routing.rule_table(spark, TEST_RULES)
    sizes = evaluate.keywords.cluster_sizes(labels)
    ranked = evaluate.keywords.cluster_keywords(clean_texts(spark, folder), labels, KEY, CONFIG)
    table = evaluate.cluster_table(sizes, ranked, routing.business_interpret(ranked, rules, evaluate.cluster_ids(sizes)))
    named = [df.withColumn("run", F.lit("by_source")) for df in (table, sizes)]
    records = evaluation_summary(evaluate.run_report(sizes, "by_source", None), *named).drop("silhouette", "keywords")
    return records.withColumn("top_keywords", F.array_join("top_keywords", ", "))


GIVEN_SWEEP = "SELECT cluster + 2 AS k, CASE WHEN cluster % 3 <> 0 THEN round(avg(v[1]), 2) END AS silhouette FROM pts GROUP BY cluster"


@query(
    "best_of_given_sweep",
    _with([("pts", POINTS), ("sweep", GIVEN_SWEEP)]) + "SELECT CAST(k AS INTEGER) AS k, silhouette FROM sweep WHERE silhouette IS NOT NULL ORDER BY silhouette DESC, k LIMIT 1",
)
def best_of_given_sweep(spark, folder):
    """The best of scores taken from the table, some of which are null."""
    score = F.when(F.col("cluster") % 3 != 0, F.round(F.avg(F.col("vector")[0]), 2))
    sweep = embedding_points(spark, folder).groupBy("cluster").agg(score.alias("silhouette"))
    return recommended_k(sweep.select((F.col("cluster") + 2).cast("int").alias("k"), "silhouette"))


COPIES = 32  # points around each vector of the table
ASKED_AT_ONCE = 10_000


@query(
    "neighbour_recall",
    _with([("pts", POINTS)])
    + f"SELECT 10 * count(*) AS pairs, TRUE AS recall_reached FROM pts, (SELECT unnest(range(0, {COPIES})) AS c) WHERE (id * {COPIES} + c) % 100 = 0",
)
def neighbour_recall(spark, folder):
    """Of the ten nearest of each hundredth point, by comparison with all, at least 95 of 100 are
    found in cells of the size that clustering uses. The points lie around the table's vectors."""
    points = surrounded(embedding_points(spark, folder), COPIES)
    nodes, _ = distinct_points(points, KEY, "vector")
    found = nearest_neighbours(build(nodes), 10)
    exact = exact_neighbours(points, points.filter(F.col(KEY) % 100 == 0), 10)
    hits = exact.join(found.select("node", "other", F.lit(1).alias("hit")), ["node", "other"], "left")
    return hits.agg(F.count("*").alias("pairs"), (F.sum(F.coalesce("hit", F.lit(0))) >= 0.95 * F.count("*")).alias("recall_reached"))


def surrounded(points, copies: int):
    """``copies`` points a vector, each entry moved by up to a tenth as a hash of point and entry has it."""
    moved = F.transform(
        F.col("vector"), lambda x, i: x.cast("double") + F.pmod(F.xxhash64(KEY, "_copy", i), F.lit(20001)).cast("double") / 100000 - 0.1
    )
    rows = points.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return materialise(rows.select((F.col(KEY) * copies + F.col("_copy")).alias(KEY), moved.alias("vector")), "surrounded")


def exact_neighbours(points, asked, k: int):
    """(node, other): the ``k`` nearest points of each one asked for, by comparison with all.

    Those asked for go to the points in blocks of ``ASKED_AT_ONCE``, so what is sent is bounded. Each task gives
    its points' own nearest of a block by matrix products, with their distances computed anew.
    """
    spark = points.sparkSession
    asked = materialise(with_position(asked.select(F.col(KEY).alias("node"), F.col("vector").alias("a")), ["node"]), "asked")
    place = F.row_number().over(Window.partitionBy("node").orderBy("d", "other"))
    # Tables of a few files are dealt out: the work is heavy per row.
    points = spread(points.select(KEY, "vector"))
    parts = []
    for start in range(0, max(1, asked.count()), ASKED_AT_ONCE):
        block = asked.filter((F.col("pos") >= start) & (F.col("pos") < start + ASKED_AT_ONCE)).select("node", "a").toArrow()
        if not block.num_rows:
            continue
        shared = spark.sparkContext.broadcast((block["node"].to_numpy(), stacked(block["a"].to_pandas())))

        def nearest(frames):
            nodes, a = shared.value
            best = {}  # of each hundred asked for (other, d) of the nearest so far, so a task's rows do not grow with its points
            for frame in frames:
                keys, b = frame[KEY].to_numpy(), stacked(frame["vector"])
                for first in range(0, len(nodes), 100):
                    d, own = squared_distances(a[first : first + 100], b), nodes[first : first + 100]
                    d[own[:, None] == keys[None, :]] = np.inf
                    m = min(k + 5, len(keys))  # some more, as products round
                    at = np.argpartition(d, m - 1, axis=1)[:, :m]
                    exact = ((b[at] - a[first : first + 100, None, :]) ** 2).sum(-1)
                    exact[keys[at] == own[:, None]] = np.inf
                    other = keys[at]
                    if first in best:
                        other, exact = (np.concatenate(p, axis=1) for p in zip(best[first], (other, exact)))
                        order = np.lexsort((other, exact), axis=1)[:, :k]
                        other, exact = np.take_along_axis(other, order, 1), np.take_along_axis(exact, order, 1)
                    best[first] = other, exact
            for first, (other, exact) in best.items():
                rows = pd.DataFrame({"node": np.repeat(nodes[first : first + 100], other.shape[1]), "other": other.ravel(), "d": exact.ravel()})
                yield rows[rows["node"] != rows["other"]]

        found = points.mapInPandas(nearest, "node bigint, other bigint, d double")
        parts.append(found.withColumn("place", place).filter(F.col("place") <= k).select("node", "other"))
    if not parts:
        return spark.createDataFrame([], "node bigint, other bigint")
    return reduce(DataFrame.unionByName, parts)


@query("density_tree_edges", "SELECT count(*) - 1 AS edges, 0 AS unlinked FROM (SELECT DISTINCT embedding FROM embeddings) e")
def density_tree_edges(spark, folder):
    """The tree has an edge less than there are different points, also over many cells. Cells hold a fifth of
    a small table, and never more than clustering has in them."""
    nodes, _ = distinct_points(embedding_points(spark, folder), KEY, "vector")
    cells = build(nodes, cell_rows=min(CELL_ROWS, max(50, nodes.count() // 5)))
    tree = spanning_trees(cells, materialise(core_distances(cells, [5]), "cores"), [5])
    return tree.agg(F.count("*").alias("edges"), F.count_if(F.col("weight") == float("inf")).cast("int").alias("unlinked"))


@query(
    "core_distances",
    _with([
        ("pts", POINTS),
        ("ranked", f"SELECT p.id, {EUCLIDEAN} AS d, row_number() OVER (PARTITION BY p.id ORDER BY {EUCLIDEAN}) AS place FROM pts p JOIN pts q ON p.id <> q.id"),
    ])
    + "SELECT id AS ticket_id, round(max(d) FILTER (place = 3), 6) AS core_3, round(max(d) FILTER (place = 10), 6) AS core_10 FROM ranked GROUP BY id",
)
def core_distance_table(spark, folder):
    nodes, members = distinct_points(embedding_points(spark, folder), KEY, "vector")
    cores = core_distances(build(nodes), [3, 10])
    return members.join(cores, "node").select(KEY, F.round("core_3", 6).alias("core_3"), F.round("core_10", 6).alias("core_10"))


TRAIN = "type IS NOT NULL AND tag_2 IS NOT NULL"


@query("labelled_rows", with_tickets() + "SELECT ticket_id, type FROM tickets WHERE type IS NOT NULL")
def labelled_rows(spark, folder):
    return impute.labelled_rows(tickets(spark, folder), CONFIG).select(KEY, "type")


@query(
    "class_weights",
    with_tickets(("c", "SELECT type AS label, count(*) AS n FROM tickets WHERE type IS NOT NULL GROUP BY type HAVING count(*) >= 5"))
    + "SELECT label, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 8) AS weight FROM c",
)
def class_weights(spark, folder):
    return impute.class_weights(tickets(spark, folder), "type", CONFIG).withColumn("weight", F.round("weight", 8))


@query(
    "training_rows",
    with_tickets(("c", f"SELECT tag_2, count(*) AS n FROM tickets WHERE {TRAIN} GROUP BY tag_2 HAVING count(*) >= 5"))
    + f"SELECT ticket_id, tag_2 FROM tickets WHERE {TRAIN} AND tag_2 IN (SELECT tag_2 FROM c)",
)
def training_rows(spark, folder):
    return impute.training_rows(tickets(spark, folder), "tag_2", CONFIG).select(KEY, "tag_2")


@query(
    "imputation_keeps_labels",
    with_tickets() + "SELECT type, FALSE AS type_imputed, count(*) AS n FROM tickets WHERE type IS NOT NULL GROUP BY type",
)
def imputation_keeps_labels(spark, folder):
    df = tickets(spark, folder)
    filled = impute.impute(df, CONFIG).select(KEY, "type", "type_imputed")
    known = filled.join(df.filter("type IS NOT NULL").select(KEY), KEY, "left_semi")
    return known.groupBy("type", "type_imputed").agg(F.count("*").alias("n"))
