"""Fitted models and whole analyses: results that SQL cannot state."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuelens.checks.features import both_vectors
from queuelens.checks.quality import embedding_points
from queuelens.checks.sql import TEST_RULES, with_tickets
from queuelens.config import settings
from queuelens.operators import density, evaluate, fusion, impute, kmeans, routing
from queuelens.operators.cluster import cluster
from queuelens.plans import run as plan
from queuelens.plans import sweeps
from queuelens.plans.ticket_view import tickets
from queuelens.session import materialise
from queuelens.streaming.route import route_tickets

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


def points(spark, folder):
    return embedding_points(spark, folder).drop("cluster")


@query("impute_types")
def impute_types(spark, folder):
    return impute.impute(tickets(spark, folder), CONFIG).select(KEY, "type", "type_imputed")


@query("imputation_report")
def imputation_report(spark, folder):
    config = settings({"imputation": {"columns": {"type": {"threshold": 0.7}, "tag_2": {"threshold": 0.6}}}})
    df = tickets(spark, folder)
    return impute.imputation_report(df, impute.impute(df, config), config)


@query("kmeans_clusters")
def kmeans_clusters(spark, folder):
    return cluster(points(spark, folder), "kmeans", CONFIG, KEY)


@query(
    "kmeans_nearest_centre",
    "SELECT count(*) AS n, 0 AS astray, 8 AS clusters FROM embeddings",
)
def kmeans_nearest_centre(spark, folder):
    """No point is nearer to the mean of another cluster than to that of its own, up to the fit's tolerance."""
    df = points(spark, folder)
    labelled = df.join(cluster(df, "kmeans", CONFIG, KEY), KEY)
    means = kmeans.centroids(labelled)
    gap = F.aggregate(F.zip_with("vector", "centroid", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    # k means, compared with every point.
    far = labelled.crossJoin(F.broadcast(means.withColumnRenamed("cluster", "other"))).withColumn("gap", gap)
    least = far.groupBy(KEY, "cluster").agg(F.min("gap").alias("least"), F.min(F.when(F.col("other") == F.col("cluster"), F.col("gap"))).alias("own"))
    return least.agg(
        F.count("*").alias("n"), F.count_if(F.col("own") > 1.01 * F.col("least") + 1e-6).cast("int").alias("astray"),
        F.count_distinct("cluster").cast("int").alias("clusters"),
    )


@query("density_least_size", "SELECT count(*) AS n, 0 AS too_small FROM embeddings")
def density_least_size(spark, folder):
    """Every row has a label, and no cluster is smaller than the settings allow."""
    labels = cluster(points(spark, folder), "hdbscan", CONFIG, KEY)
    sizes = labels.groupBy("cluster").agg(F.count("*").alias("n"))
    small = (F.col("cluster") >= 0) & (F.col("n") < CONFIG["clustering"]["hdbscan"]["min_cluster_size"])
    return sizes.agg(F.sum("n").alias("n"), F.count_if(small).cast("int").alias("too_small"))


@query(
    "imputation_adds_up",
    with_tickets() + "SELECT count(*) FILTER (type IS NULL) AS nulls, 0 AS left_null FROM tickets",
)
def imputation_adds_up(spark, folder):
    """What was imputed and what was not sure enough are together the nulls."""
    df = tickets(spark, folder)
    filled = impute.impute(df, CONFIG)
    report = impute.imputation_report(df, filled, CONFIG)
    left = filled.agg(F.count_if(F.col("type").isNull()).cast("int")).scalar()
    return report.select((F.col("imputed") + F.col("not_sure")).alias("nulls"), left.alias("left_null"))


@query("projection_is_centred", "SELECT count(*) AS n, TRUE AS first_is_wider, TRUE AS uncorrelated FROM embeddings")
def projection_is_centred(spark, folder):
    """The first axis carries at least as much variance as the second, and they are uncorrelated."""
    rows = sweeps.projection(points(spark, folder), KEY)
    return rows.agg(
        F.count("*").alias("n"), (F.variance("x") >= F.variance("y")).alias("first_is_wider"),
        (F.abs(F.corr("x", "y")) < 1e-6).alias("uncorrelated"),
    )


@query("density_clusters")
def density_clusters(spark, folder):
    return cluster(points(spark, folder), "hdbscan", CONFIG, KEY)


@query("density_cluster_totals")
def density_cluster_totals(spark, folder):
    labels = density.hdbscan(points(spark, folder), KEY, {"min_cluster_size": 5, "min_samples": 3})
    return evaluate.cluster_totals(labels)


@query("k_sweep")
def k_sweep(spark, folder):
    return sweeps.k_sweep(points(spark, folder), KEY)


@query("recommended_k")
def recommended_k(spark, folder):
    return sweeps.recommended_k(sweeps.k_sweep(points(spark, folder), KEY, ks=range(6, 13, 2), n_init=2))


@query("density_sensitivity")
def density_sensitivity(spark, folder):
    return sweeps.density_sensitivity(points(spark, folder), KEY)


@query("fusion_comparison")
def fusion_comparison(spark, folder):
    both = materialise(both_vectors(spark, folder).select(KEY, "semantic", "operational"), "both")
    sets = {
        "concatenation": fusion.concatenate_fusion(both).select(KEY, "vector"),
        "weighted": fusion.weighted_fusion(both, CONFIG["fusion"]["alpha"]).select(KEY, "vector"),
        "semantic_only": both.select(KEY, F.col("semantic").alias("vector")),
        "operational_only": both.select(KEY, F.col("operational").alias("vector")),
    }
    return sweeps.fusion_comparison(sets, KEY, CONFIG)


@query("projection")
def projection(spark, folder):
    return sweeps.projection(points(spark, folder), KEY)


def _analysis(spark, folder):
    return plan.analyse(tickets(spark, folder), CONFIG, rules=routing.rule_table(spark, TEST_RULES))


@query("analysis_runs")
def analysis_runs(spark, folder):
    return _analysis(spark, folder).runs


@query("analysis_clusters")
def analysis_clusters(spark, folder):
    """The cluster table of the four-way analysis."""
    table = _analysis(spark, folder).clusters
    return table.withColumns({c: F.array_join(c, ", ") for c in ("keywords", "top_keywords")})


@query("routed_tickets")
def routed_tickets(spark, folder):
    ready = plan.prepared(tickets(spark, folder), settings(
        {"embeddings": {"tag_enrichment": {"enabled": False}}, "imputation": {"enabled": False}}))
    vectors = ready.select(KEY, F.col("semantic").alias("vector"))
    labels = kmeans.kmeans(vectors, KEY, CONFIG["clustering"]["kmeans"])
    routed = route_tickets(tickets(spark, folder), kmeans.centroids(vectors.join(labels, KEY)), CONFIG)
    return routed.select(KEY, "cluster", F.round("cosine", 6).alias("cosine"))
