import json

import pytest
from pyspark.sql import functions as F

from queuelens.config import load_settings, settings
from queuelens.sources import sinks
from queuelens.sources.store import embed_with_store, stored_vectors
from queuelens.sources.tickets import load_data, read_csv

CONFIG = settings({"data": {"source": "csv", "text_columns": ["Title", "Details"], "metadata_columns": {
    "priority": "Urgency", "ticket_type": "Kind", "product": "Product", "channel": "Via"}}})

CSV = (
    "Title,Details,Urgency,Kind,Product,Via\n"
    'VPN down,"Cannot ""connect"",\nsince noon",High,Fault,P1,Mail\n'
    "N/A,Lost my badge,null,Request,P2,Phone\n"
)


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "tickets.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_rows_columns_and_missing_values(spark, csv_file):
    df = load_data(spark, csv_file, CONFIG)
    assert {"Title", "Details", "Urgency", "ticket_id"} <= set(df.columns)
    rows = {r.Product: r for r in df.collect()}
    assert len(rows) == 2 and len({r.ticket_id for r in rows.values()}) == 2
    assert rows["P1"].Details == 'Cannot "connect",\nsince noon'
    assert rows["P2"].Title is None and rows["P2"].Urgency is None


def test_further_missing_value_texts(spark, csv_file):
    assert read_csv(spark, csv_file, na_values=["P1"]).filter("Product IS NULL").count() == 1


def test_missing_path_and_columns_and_source(spark, csv_file):
    with pytest.raises(FileNotFoundError, match="not found"):
        load_data(spark, "/tmp/no-such-tickets.csv", CONFIG)
    with pytest.raises(ValueError, match="Missing expected columns: .*'severity'"):
        load_data(spark, csv_file, settings({"data": {**CONFIG["data"], "metadata_columns": {"priority": "severity"}}}))
    with pytest.raises(ValueError, match="Unknown source"):
        load_data(spark, csv_file, settings({"data": {**CONFIG["data"], "source": "xml"}}))


def test_snapshot_export_and_reload(spark, csv_file, tmp_path):
    df = load_data(spark, csv_file, CONFIG)
    sinks.write_tickets(df, str(tmp_path / "snap"))
    back = load_data(spark, str(tmp_path / "snap"), settings({"data": {**CONFIG["data"], "source": "parquet"}}))
    assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)
    sinks.export_snapshot(spark, str(tmp_path / "snap"), str(tmp_path / "csv"))
    again = read_csv(spark, str(tmp_path / "csv"))
    assert {r.Details for r in again.collect()} == {r.Details for r in df.collect()}


def test_settings_file(tmp_path):
    path = tmp_path / "settings.yaml"
    path.write_text("fusion:\n  alpha: 0.4\nimputation:\n  columns:\n    tag_1:\n      threshold: 0.65\n")
    got = load_settings(str(path))
    assert got["fusion"]["alpha"] == 0.4 and list(got["imputation"]["columns"]) == ["tag_1"]
    assert got["clustering"]["kmeans"]["k"] == 8


def test_store_embeds_each_text_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def embed(texts):
        def run(frames):
            for frame in frames:
                calls.add(len(frame))
                yield frame.assign(vector=[[float(len(t))] for t in frame["text"]])[["text_key", "vector"]]

        return texts.mapInPandas(run, "text_key string, vector array<double>")

    store = str(tmp_path / "store")
    first = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "a")], "id int, text string")
    assert embed_with_store(first, "text", store, "m", embed).count() == 2
    assert calls.value == 2
    more = first.union(spark.createDataFrame([(4, "cccc")], first.schema))
    assert {r.vector[0] for r in embed_with_store(more, "text", store, "m", embed).collect()} == {1.0, 2.0, 4.0}
    assert calls.value == 3
    assert stored_vectors(spark, store, "other").count() == 0


def report(spark):
    clusters = spark.createDataFrame(
        [("a_kmeans", 0, 7, ["vpn", "dns"], "Network", "NetOps", True, 0.29, ["vpn", "dns"]),
         ("a_kmeans", 1, 3, [], "Uncategorized", "General", False, 0.0, [])],
        "run string, cluster int, size bigint, keywords array<string>, category string, team string, automation boolean, confidence double, top_keywords array<string>",
    )
    runs = spark.createDataFrame([("a_kmeans", 0.5, 2, 1), ("b_hdbscan", None, 0, 11)], "run string, silhouette double, n_clusters bigint, noise_count bigint")
    sizes = spark.createDataFrame([("a_kmeans", -1, 1), ("a_kmeans", 0, 7), ("a_kmeans", 1, 3), ("b_hdbscan", -1, 11)], "run string, cluster int, size bigint")
    return runs, clusters, sizes


def test_summary_records(spark, tmp_path):
    sinks.write_evaluation_summary(*report(spark), str(tmp_path / "sum"))
    lines = [json.loads(x) for f in (tmp_path / "sum").glob("*.json") for x in f.read_text().splitlines()]
    by = {(x["run"], x["cluster"]): x for x in lines}
    assert {k: x["size"] for k, x in by.items()} == {("a_kmeans", -1): 1, ("a_kmeans", 0): 7, ("a_kmeans", 1): 3, ("b_hdbscan", -1): 11}
    assert by["a_kmeans", 0]["team"] == "NetOps" and by["a_kmeans", 0]["keywords"] == ["vpn", "dns"]
    assert "keywords" not in by["a_kmeans", -1] and by["a_kmeans", -1]["silhouette"] == 0.5
    assert by["b_hdbscan", -1]["noise_count"] == 11 and "silhouette" not in by["b_hdbscan", -1]


def test_summary_has_one_layout_for_any_number_of_clusters(spark):
    runs = spark.createDataFrame([("r", 0.1, 20_000, 3)], "run string, silhouette double, n_clusters bigint, noise_count bigint")
    sizes = spark.range(-1, 20_000).selectExpr("'r' AS run", "CAST(id AS INT) AS cluster", "CAST(5 AS BIGINT) AS size")
    clusters = sizes.filter("cluster >= 0").selectExpr("*", "array('a') AS keywords", "'c' AS category")
    records = sinks.evaluation_summary(runs, clusters, sizes)
    assert records.count() == 20_001 and records.filter("cluster = -1 AND category IS NULL").count() == 1


def test_repeated_store_entries_give_one_vector(spark, tmp_path):
    def embed(texts):
        from pyspark.sql import functions as F

        return texts.select("text_key", F.array(F.length("text").cast("double")).alias("vector"))

    store, df = str(tmp_path / "store"), spark.createDataFrame([(1, "a"), (2, "bb")], "id int, text string")
    embed_with_store(df, "text", store, "m", embed)
    spark.read.parquet(f"{store}/model=m").write.mode("append").parquet(f"{store}/model=m")
    assert stored_vectors(spark, store, "m").count() == 4
    assert embed_with_store(df, "text", store, "m", embed).count() == 2


def test_keys_depend_on_rows_not_on_files(spark, tmp_path):
    from queuelens.sources.tickets import with_key

    df = spark.createDataFrame([(f"t{i % 40}", i % 7) for i in range(60)], "a string, b int")
    one, two = (with_key(x, "k").orderBy("k").collect() for x in (df.coalesce(1), df.repartition(5)))
    assert one == two and [r.k for r in one] == list(range(60))


def test_description_lines(spark):
    _, clusters, _ = report(spark)
    lines = [r.line for r in sinks.description_lines(clusters, ["a_kmeans", "b_hdbscan"]).collect()]
    at = lines.index("### Cluster 0: Network")
    assert lines[at + 1 : at + 6] == [
        "- **Size:** 7 tickets", "- **Routing team:** NetOps", "- **Automation opportunity:** Yes",
        "- **Confidence:** 0.29", "- **Top keywords:** vpn, dns",
    ]
    assert lines.index("## a_kmeans") < at < lines.index("### Cluster 1: Uncategorized") < lines.index("## b_hdbscan")


def test_insight_lines(spark, folder):
    from queuelens.operators.profile import insights
    from queuelens.plans.ticket_view import tickets

    lines = [r.line for r in sinks.insight_lines(insights(tickets(spark, folder), settings())).collect()]
    assert "**Dataset:** 200 rows x 10 columns" in lines
    assert any(x.startswith("- clustering.hdbscan.min_cluster_size: 30") for x in lines)
    from queuelens.operators.profile import null_profile

    df = tickets(spark, folder).withColumn("version", F.lit(None).cast("string"))
    more = [r.line for r in sinks.insight_lines(insights(df, settings()), null_profile(df)).collect()]
    at = more.index("- **version nulls:** 100.0%")
    assert more.index("## Minor") < at < more.index("## Suggested settings") and any(x.startswith("- **tag_2 nulls:**") for x in more)


def test_spread_keeps_rows(spark, folder):
    from queuelens.sources.tickets import spread

    scan = spark.read.parquet(f"{folder}/documents.parquet")
    assert spread(scan).agg(F.sum("doc_id")).first() == scan.agg(F.sum("doc_id")).first()
