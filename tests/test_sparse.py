"""Operational vectors as entries against the dense ones."""

import numpy as np
import pytest

from queuelens.config import settings
from queuelens.operators import fusion, metadata, sparse

ROWS = [
    (1, "high", "Incident", "q1", "en"), (2, "low", "Request", "q2", "de"), (3, None, None, None, None),
    (4, "critical", "Incident", "q1", "en"), (5, "very_low", "Change", "q3", "en"), (6, "odd", "Request", "q1", None),
]
SCHEMA = "ticket_id int, priority string, type string, queue string, language string"


def dense(vector):
    out = np.zeros(vector["size"])
    out[list(vector["indices"])] = vector["values"]
    return out


def tickets(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as e", "1 as i", "2 as indices")


@pytest.mark.parametrize("product", ["frequency", "onehot"])
@pytest.mark.parametrize("normalize", [True, False])
def test_entries_equal_the_dense_vectors(spark, product, normalize):
    config = settings({"operational_features": {"product_encoding": product, "normalize": normalize}})
    df = tickets(spark)
    want = {r.ticket_id: r.operational for r in metadata.encode_metadata(df, config).collect()}
    found = sparse.encode_sparse(df, config)
    assert found.columns == [*df.columns, "operational"]
    for r in found.collect():
        assert dense(r.operational).tolist() == pytest.approx(want[r.ticket_id])
        assert all(r.operational["values"]) and r.operational["indices"] == sorted(r.operational["indices"])


def test_listed_and_joined_ranges_agree(spark):
    config = settings({"operational_features": {"normalize": False}})
    df = sparse.encode_sparse(tickets(spark), config)
    listed = {r.ticket_id: r.operational for r in sparse.min_max_scaled(df, "operational").collect()}
    joined = {r.ticket_id: r.operational for r in sparse.min_max_scaled(df, "operational", listed=0).collect()}
    assert listed == joined and len(joined) == len(ROWS)


def test_a_value_that_all_rows_have_becomes_zero(spark):
    df = tickets(spark, [(i, "high", "Incident", "q", "en") for i in range(3)])
    found = sparse.encode_sparse(df, settings()).collect()
    assert all(r.operational["indices"] == [] and r.operational["size"] == 4 for r in found)


def test_wide_columns_are_joined(spark, monkeypatch):
    monkeypatch.setattr(metadata, "LITERAL_CATEGORIES", 1)
    config = settings({"operational_features": {"product_encoding": "onehot"}})
    joined = {r.ticket_id: r.operational for r in sparse.encode_sparse(tickets(spark), config).collect()}
    monkeypatch.undo()
    assert joined == {r.ticket_id: r.operational for r in sparse.encode_sparse(tickets(spark), config).collect()}


def test_fusions_equal_the_dense_ones(spark):
    config = settings()
    rows = metadata.encode_metadata(tickets(spark), config).selectExpr("*", "array(cast(ticket_id as double), 0.0, 2.0) as semantic")
    rows = rows.withColumnRenamed("operational", "plain")
    both = sparse.encode_sparse(rows, config)
    for alpha in (None, 0.7):
        want = fusion.concatenate_fusion(both, operational="plain", name="want") if alpha is None else fusion.weighted_fusion(both, alpha, operational="plain", name="want")
        for r in sparse.fused(want, alpha).collect():
            assert dense(r.vector).tolist() == pytest.approx(r.want)


def test_empty_tables_and_negative_values(spark):
    assert sparse.encode_sparse(tickets(spark, []), settings()).count() == 0
    below = spark.sql("SELECT named_struct('size', 2L, 'indices', array(0L), 'values', array(-1.0D)) AS v")
    with pytest.raises(ValueError, match="below 0"):
        sparse.min_max_scaled(below, "v")
    null = spark.sql("SELECT cast(null as struct<size:bigint,indices:array<bigint>,values:array<double>>) AS v UNION ALL SELECT named_struct('size', 2L, 'indices', array(0L), 'values', array(3.0D))")
    assert sum(r.v is None for r in sparse.min_max_scaled(null, "v").collect()) == 1
