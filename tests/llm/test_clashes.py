"""Extra columns that are called what an operator calls its own."""

import pytest
from pyspark.sql import functions as F

from queuelens.llm import leaks, line_dedup, line_field, mixing, simhash
from tests.llm import brute, data

NAMES = [
    "_given", "_key", "_hash", "_tie", "_at", "_h1", "_h2", "_docs", "_last", "_lost", "_lost_id", "_kept", "_n_lines", "_n_dropped",
    "_place", "_turn", "_turns", "_words", "_parts", "_row", "_source", "_start", "_no", "_fp", "_component", "_least",
    "_score", "_found", "_items", "_distances", "pass", "shard", "slot", "words",
]


def clashing(spark):
    docs = data.documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    return docs.select("*", *(F.lit(f"mine {i}").alias(name) for i, name in enumerate(NAMES)))


def unharmed(rows):
    return all(r[name] == f"mine {i}" for r in rows for i, name in enumerate(NAMES))


def test_lines(spark):
    docs = clashing(spark)
    got = line_dedup.dedup_lines(docs, min_chars=20, min_docs=5)
    assert got.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    found = got.select("doc_id", "__n_lines", "__n_dropped", F.sha2("text", 256)).collect()
    assert data.as_set(found) == data.as_set(brute.line_dedup(data.pairs(), 20, 5)) and unharmed(got.collect())


def test_one_row_of_each_group(spark):
    docs = clashing(spark)
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns and unharmed(got.collect())
    assert got.count() == simhash.keep_one(data.documents(spark)).count()


def test_leaks(spark):
    docs = clashing(spark)
    items = spark.createDataFrame([(1, data.texts()[7])], "item_id bigint, text string")
    got = leaks.find_leaks(docs, items)
    assert got.columns == [*docs.columns, "__items", "__distances"] and unharmed(got.collect())
    plain = leaks.find_leaks(data.documents(spark), items)
    assert got.where(F.size("__items") > 0).count() == plain.where(F.size("_items") > 0).count() > 5


def test_mixed_texts(spark):
    docs = clashing(spark)
    got = mixing.mixed_texts(docs, mixing.plan_mix(docs, block_words=8), 8)
    plain = mixing.mixed_texts(data.documents(spark), mixing.plan_mix(data.documents(spark), block_words=8), 8)
    assert got.columns == docs.columns and unharmed(got.collect())
    assert data.as_set(got.select("doc_id", "text", "n_chars").collect()) == data.as_set(plain.select("doc_id", "text", "n_chars").collect())


def test_quality_stage(spark, monkeypatch):
    import corpus_pipeline as cp

    monkeypatch.setattr(line_field, "learn", lambda docs, labels: None)
    monkeypatch.setattr(line_field, "score", lambda docs, field, column: docs.withColumn(column, F.lit(1.0)))
    docs = clashing(spark)
    got = cp.quality(spark, docs, "/root/testdata/sf0.001")
    assert got.columns == docs.columns and unharmed(got.collect())


@pytest.mark.parametrize("lines", [20_000])
def test_long_texts_take_linear_time(spark, lines):
    import time

    body = "\n".join(f"this is line number {i} of a text that is found many times" for i in range(lines))
    docs = spark.createDataFrame([(i, body) for i in range(6)], "doc_id bigint, text string")
    began = time.time()
    got = {r.doc_id: (r._n_lines, r._n_dropped, len(r.text)) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {**{i: (lines, lines, 0) for i in range(5)}, 5: (lines, 0, len(body))}
    assert time.time() - began < 60
