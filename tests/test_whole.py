import pytest

import __spark_entry__ as entry
from compare import difference, duck
from queuelens.checks.sql import TEST_RULES
from queuelens.config import settings
from queuelens.operators import kmeans, routing
from queuelens.operators.prepare import preprocess
from queuelens.operators.embed import generate_embeddings
from queuelens.plans import run as plan
from queuelens.plans import sweeps
from queuelens.plans.ticket_view import tickets
from queuelens.session import shared_folder
from queuelens.streaming.route import route_tickets, start_routing

KEY = "ticket_id"


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, folder, con, name):
    got = entry.queries()[name](spark, folder).toPandas()
    assert difference(got, con.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 19


def test_full_run_writes_everything(spark, folder, tmp_path):
    snapshot = str(tmp_path / "snapshot")
    tickets(spark, folder).write.parquet(snapshot)
    config = settings({"data": {"path": snapshot}, "imputation": {"max_features": 500, "max_iter": 30},
                       "clustering": {"kmeans": {"k": 4, "n_init": 2}, "hdbscan": {"min_cluster_size": 5, "min_samples": 3}}})
    got = plan.run(spark, config, str(tmp_path / "out"), rules=routing.rule_table(spark, TEST_RULES))
    assert got.names == ["concatenation_kmeans", "concatenation_hdbscan", "weighted_kmeans", "weighted_hdbscan"]
    runs = {r.run: r for r in got.runs.collect()}
    table = spark.read.parquet(str(tmp_path / "out" / "clustered_tickets"))
    assert table.count() == 200 and set(f"cluster_{n}" for n in got.names) < set(table.columns)
    for name in got.names:
        found = table.groupBy(f"cluster_{name}").count().collect()
        assert runs[name].n_clusters == len([r for r in found if r[0] >= 0])
        assert runs[name].noise_count == sum(r[1] for r in found if r[0] == -1)
    assert runs["weighted_kmeans"].n_clusters == 4 and -1 <= runs["weighted_kmeans"].silhouette <= 1
    summary = spark.read.json(str(tmp_path / "out" / "evaluation_summary"))
    assert summary.count() == got.sizes.count() and summary.select("run").distinct().count() == 4
    text = spark.read.text(str(tmp_path / "out" / "cluster_descriptions")).filter("value LIKE '### Cluster%'")
    assert text.count() == got.clusters.count()


def tables_left(spark):
    import os

    folder = shared_folder(spark).removeprefix("file:").replace("//", "/")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_a_run_leaves_no_intermediate_table(spark, folder, tmp_path):
    snapshot = str(tmp_path / "snapshot")
    tickets(spark, folder).limit(60).write.parquet(snapshot)
    config = settings({"data": {"path": snapshot}, "imputation": {"max_features": 200, "max_iter": 5},
                       "clustering": {"kmeans": {"k": 2, "n_init": 1}, "hdbscan": {"min_cluster_size": 5, "min_samples": 3}}})
    before = tables_left(spark)
    got = plan.run(spark, config, str(tmp_path / "out"), rules=routing.rule_table(spark, TEST_RULES))
    assert tables_left(spark) <= before
    assert got.tickets.count() == 60 and got.runs.count() == 4


def test_stream_with_a_model_provider(spark, folder, tmp_path):
    from queuelens.operators.embed import FunctionEmbedder

    def load():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    config, df = settings(), tickets(spark, folder)
    embedder = FunctionEmbedder(load, 2, "len", str(tmp_path / "store"))
    centroids = spark.createDataFrame([(0, [1.0, 1.0]), (1, [1000.0, 1.0])], "cluster int, centroid array<double>")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = start_routing(stream, centroids, config, str(tmp_path / "out"), str(tmp_path / "ck"), embedder=embedder)
    assert query.awaitTermination(120)
    want = route_tickets(df, centroids, config, embedder=embedder).select(KEY, "cluster")
    assert sorted(spark.read.parquet(str(tmp_path / "out")).select(KEY, "cluster").collect()) == sorted(want.collect())


def test_stream_routes_like_batch(spark, folder, tmp_path):
    config = settings()
    df = tickets(spark, folder)
    vectors = generate_embeddings(preprocess(df, config), config).selectExpr(KEY, "semantic AS vector")
    labels = kmeans.kmeans(vectors, KEY, {"k": 4, "n_init": 1})
    centroids = kmeans.centroids(vectors.join(labels, KEY))
    routes = spark.createDataFrame([(i, f"c{i}", f"t{i}", i > 1) for i in range(4)], "cluster int, category string, team string, automation boolean")
    want = route_tickets(df, centroids, config, routes)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    query = start_routing(stream, centroids, config, str(tmp_path / "out"), str(tmp_path / "ck"), routes)
    assert query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    columns = [KEY, "cluster", "team", "automation"]
    assert sorted(got.select(*columns).collect()) == sorted(want.select(*columns).collect())


def test_sweeps(spark, folder):
    points = spark.read.parquet(f"{folder}/embeddings.parquet").selectExpr(f"vec_id AS {KEY}", "CAST(embedding AS array<double>) AS vector")
    sweep = sweeps.k_sweep(points, KEY, ks=[2, 6, 10], n_init=2)
    rows = {r.k: r for r in sweep.collect()}
    assert rows[2].inertia > rows[6].inertia > rows[10].inertia
    given = spark.createDataFrame([(2, 3.0, None), (3, 2.0, 0.2), (4, 1.0, 0.5)], sweep.schema)
    assert tuple(sweeps.recommended_k(given).first()) == (4, 0.5)
    best = sweeps.recommended_k(sweep).first()
    assert best.silhouette == max(r.silhouette for r in rows.values()) and rows[best.k].silhouette == best.silhouette
    plane = sweeps.projection(points, KEY)
    assert plane.count() == points.count() and plane.columns == [KEY, "x", "y"]


class Settings:
    """A session that names a checkpoint folder, or none, on a given master."""

    def __init__(self, folder, master, own=None):
        self.conf = self.sparkContext = self
        self.folder, self.master, self.applicationId, self.own = folder, master, "app-probe", own

    def get(self, name, default=None):
        assert name == "spark.checkpoint.dir"
        return self.folder

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return self.own


def test_checkpoint_folder():
    assert shared_folder(Settings("hdfs://x/ck/", "yarn")) == "hdfs://x/ck"
    assert shared_folder(Settings(None, "yarn", "hdfs://y/own")) == "hdfs://y/own"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Settings(None, "yarn"))
    local = Settings(None, "local[2]")
    assert shared_folder(local) == shared_folder(local)
