import numpy as np
import pytest
from pyspark.sql import functions as F

from queuelens.config import settings
from queuelens.operators import embed, fusion, metadata

CONFIG = settings({
    "data": {"metadata_columns": {"priority": "urgency", "ticket_type": "kind", "product": "product", "channel": "via"}},
    "operational_features": {"priority_map": {"Low": 1, "Medium": 2, "High": 3, "Critical": 4}},
})
ROWS = [(1, "High", "Fault", "A", "Mail"), (2, "Medium", "Access", "B", "Phone"), (3, "Low", "Fault", "A", "Mail"), (4, "Critical", None, None, "Chat"), (5, "Odd", "Bill", "C", "Mail")]
SCHEMA = "ticket_id bigint, urgency string, kind string, product string, via string"


def encoded(spark, rows=ROWS, config=CONFIG):
    df = metadata.encode_metadata(spark.createDataFrame(rows, SCHEMA), config)
    return {r.ticket_id: r.operational for r in df.collect()}


def test_raw_layout(spark):
    raw = encoded(spark, config=settings({**CONFIG, "operational_features": {**CONFIG["operational_features"], "normalize": False}}))
    # rank | Access Bill Fault | product share of the non-null rows | Chat Mail Phone
    assert raw[1] == [3, 0, 0, 1, 0.5, 0, 1, 0]
    assert raw[4] == [4, 0, 0, 0, 0, 1, 0, 0]
    assert raw[5] == [0, 0, 1, 0, 0.25, 0, 1, 0]


def test_scaled_to_unit_range(spark):
    got = np.array(list(encoded(spark).values()))
    assert got.shape == (5, 8) and got.min() == 0 and got.max() == 1
    assert (got.max(0) == 1).all()


def test_constant_column_becomes_zero(spark):
    got = encoded(spark, [r[:4] + ("Mail",) for r in ROWS])
    assert all(v[-1] == 0 for v in got.values())


def test_product_flags(spark):
    config = settings({**CONFIG, "operational_features": {**CONFIG["operational_features"], "product_encoding": "onehot"}})
    got = encoded(spark, config=config)
    assert len(got[1]) == 10 and got[4][4:7] == [0, 0, 0] and got[1][4:7] == [1, 0, 0]


def test_wide_columns_are_joined_with_equal_rows(spark, monkeypatch):
    config = settings({**CONFIG, "operational_features": {**CONFIG["operational_features"], "product_encoding": "onehot"}})
    want = encoded(spark, config=config)
    monkeypatch.setattr(metadata, "LITERAL_CATEGORIES", 1)
    assert encoded(spark, config=config) == want


def test_sparse_flags_of_a_wide_column(spark):
    df = spark.range(2500).selectExpr("id", "CASE WHEN id % 50 <> 0 THEN CAST(id % 1999 AS STRING) END AS v")
    rows = metadata.one_hot_sparse(df, "v", "f").collect()
    place = {v: i for i, v in enumerate(sorted({r.v for r in rows if r.v is not None}))}
    assert len(place) > 1000 and len(rows) == 2500
    for r in rows:
        assert r.f.size == len(place) and list(r.f.indices) == ([] if r.v is None else [place[r.v]])


def halves(spark, n=20):
    rng = np.random.default_rng(3)
    rows = [(i, rng.random(10).tolist(), rng.random(4).tolist()) for i in range(n)] + [(n, [0.0] * 10, [1.0, 0.0, 0.0, 0.0])]
    return spark.createDataFrame(rows, "ticket_id bigint, semantic array<double>, operational array<double>")


def test_fusion_shapes_and_norms(spark):
    got = np.array([r.vector for r in fusion.concatenate_fusion(halves(spark)).orderBy("ticket_id").collect()])
    assert got.shape == (21, 14)
    assert np.allclose(np.linalg.norm(got[:-1, :10], axis=1), 1) and np.allclose(np.linalg.norm(got[:, 10:], axis=1), 1)
    assert not got[-1, :10].any()


def test_fusion_weights(spark):
    for alpha, empty, full in ((1.0, slice(10, 14), slice(0, 10)), (0.0, slice(0, 10), slice(10, 14))):
        got = np.array([r.vector for r in fusion.weighted_fusion(halves(spark), alpha).collect()])
        assert not got[:, empty].any() and got[:, full].any()
    got = np.array([r.vector for r in fusion.weighted_fusion(halves(spark), 0.7).orderBy("ticket_id").collect()])
    assert np.allclose(np.linalg.norm(got[:-1, :10], axis=1), 0.7) and np.allclose(np.linalg.norm(got[:, 10:], axis=1), 0.3)


class Loader:
    """A stand-in model: text length and number of blanks."""

    def __call__(self):
        return lambda texts: np.array([[len(t), t.count(" ")] for t in texts], dtype=np.float32) if len(texts) <= 2 else 1 / 0


def test_function_provider_batches_and_stores(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, "ccc"), (3, "a b"), (4, None), (5, "dd dd d")], "ticket_id bigint, text string")
    provider = embed.FunctionEmbedder(Loader(), 2, "toy-1", str(tmp_path / "s"), batch_size=2)
    got = {r.ticket_id: r.semantic for r in embed.generate_embeddings(df, CONFIG, provider).collect()}
    assert got == {1: [3, 1], 2: [3, 0], 3: [3, 1], 4: [0, 0], 5: [7, 2]}
    assert spark.read.parquet(str(tmp_path / "s")).count() == 4
    with pytest.raises(ValueError, match="model_id"):
        embed.FunctionEmbedder(Loader(), 2, "a/b", "x")


def test_provider_names():
    assert isinstance(embed.embedder_for(settings()), embed.HashingEmbedder)
    with pytest.raises(ValueError, match="Unknown provider"):
        embed.embedder_for(settings({"embeddings": {"provider": "other"}}))


def test_tag_enrichment(spark):
    rows = [(1, "mail"), (2, None), (3, "Unknown"), (4, "mail")]
    df = spark.createDataFrame(rows, "ticket_id bigint, tag_1 string").withColumn("semantic", F.array(F.lit(1.0)))
    got = {r.ticket_id: r.semantic for r in embed.enrich_with_tag_embeddings(df, settings(), embed.HashingEmbedder(8)).collect()}
    assert all(len(v) == 9 and v[0] == 1.0 for v in got.values())
    assert got[1] == got[4] and sorted(map(abs, got[1][1:]))[-1] == pytest.approx(0.3)
    assert not any(got[2][1:]) and not any(got[3][1:])


def test_no_tags_at_all(spark):
    df = spark.createDataFrame([(1, None)], "ticket_id bigint, tag_1 string").withColumn("semantic", F.array(F.lit(1.0)))
    got = embed.enrich_with_tag_embeddings(df, settings(), embed.HashingEmbedder(4)).first()
    assert got.semantic == [1.0, 0, 0, 0, 0]


def test_precomputed_rows_without_vector_get_zeros(spark):
    table = spark.createDataFrame([(1, [0.5, 0.5])], "ticket_id bigint, vector array<float>")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "ticket_id bigint, text string")
    config = settings({"embeddings": {"provider": "precomputed", "dim": 2}})
    provider = embed.embedder_for(config, table=table)
    got = {r.ticket_id: r.semantic for r in embed.generate_embeddings(df, config, provider).collect()}
    assert got == {1: [0.5, 0.5], 2: [0, 0]}


def test_word_vectors_are_fitted_in_no_more_parts_than_cores(spark, monkeypatch):
    seen, made = [], embed.Word2Vec
    monkeypatch.setattr(embed, "Word2Vec", lambda **options: seen.append(options["numPartitions"]) or made(**options))
    cores = spark.sparkContext.defaultParallelism
    df = spark.createDataFrame([(i, f"one two three {i % 3}") for i in range(5 * cores)], "ticket_id bigint, text string")
    for rows, want in ((1, cores), (10 * cores, 1)):
        out = embed.Word2VecEmbedder(dim=4, min_count=1, rows_per_task=rows).add(df, "text", "semantic")
        assert out.count() == 5 * cores and seen.pop() == want
