import math
import re

import pytest
from pyspark.sql import functions as F

from queuelens.config import settings
from queuelens.functions import text as tx
from queuelens.functions.lookup import bounded_rows, fits, join_lookup
from queuelens.operators import prepare, tfidf

CONFIG = settings()
ODD = ["VPN Connection Issue!", "Straße Ärger İx", "", "a b c1", "line\r\none\ttwo\x0bthree", None, "x_y  42 字字"]


def texts(spark):
    return spark.createDataFrame(list(enumerate(ODD)), "ticket_id bigint, body string").withColumn("subject", F.lit(None).cast("string"))


def test_cleaning_matches_plain_python(spark):
    for r in prepare.preprocess(texts(spark), CONFIG).collect():
        low = (" " + (r.body or "")).lower()
        want = re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", low)).strip()
        assert r.text == want


def test_preprocess_keeps_columns_and_survives_nulls(spark):
    df = spark.createDataFrame([(1, None, "Some MFA text", "High"), (2, "Normal", None, "Low"), (3, None, None, "Low")],
                               "ticket_id int, subject string, body string, priority string")
    got = prepare.preprocess(df, CONFIG)
    assert got.columns == df.columns + ["text"]
    assert {r.ticket_id: r.text for r in got.collect()} == {1: "some mfa text", 2: "normal", 3: ""}


def test_word_counts_match_split(spark):
    for r in prepare.with_lengths(texts(spark), CONFIG).collect():
        assert r.body_len == len((r.body or "").split()) and r.subject_len == 0 and r.combined_len == r.body_len


def test_tokens_match_plain_python(spark):
    for r in texts(spark).select("body", tx.tokens(tx.blank_if_null(F.col("body"))).alias("t")).collect():
        if "İ" not in (r.body or ""):  # lower-casing of the dotted capital I differs by a combining mark
            assert r.t == re.findall(r"\w\w+", (r.body or "").lower())


def test_ngrams_and_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), (["x"],), ([],)], "w array<string>")
    rows = df.select(tx.ngrams(F.col("w"), 1, 2).alias("g"), tx.counts(F.col("w")).alias("c")).collect()
    assert [r.g for r in rows] == [["b", "a", "b", "b a", "a b"], ["x"], []]
    assert [[tuple(e) for e in r.c] for r in rows] == [[("a", 1), ("b", 2)], [("x", 1)], []]


def test_runs_are_not_cut_out_one_by_one(spark):
    df = spark.createDataFrame([("a b c d".split(),), ("a b".split(),), (["a"],), ([],), (None,)], "w array<string>")
    got = [r.g for r in df.select(tx.ngrams(F.col("w"), 2, 3).alias("g")).collect()]
    assert got == [["a b", "b c", "c d", "a b c", "b c d"], ["a b"], [], [], None]
    plan = df.select(tx.ngrams(F.col("w"), 1, 2))._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and "zip_with(" in plan


def test_a_term_occurrence_is_one_row(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), (["b"],), ([],), (None,)], "terms array<string>")
    found = tfidf.listed_frequencies(df)
    assert sorted(tuple(r) for r in found.collect()) == [("a", 1, 1), ("b", 3, 2)]
    assert "array_distinct" not in found._jdf.queryExecution().optimizedPlan().toString()


def brute_tfidf(docs, sublinear, max_features):
    tokens = {k: re.findall(r"\w\w+", t.lower()) for k, t in docs.items()}
    total, df = {}, {}
    for words in tokens.values():
        for w in words:
            total[w] = total.get(w, 0) + 1
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    vocab = sorted(total, key=lambda w: (-total[w], w))[:max_features]
    out = {}
    for k, words in tokens.items():
        tf = {w: words.count(w) for w in set(words) if w in vocab}
        raw = {w: (1 + math.log(n) if sublinear else n) * (math.log((1 + len(docs)) / (1 + df[w])) + 1) for w, n in tf.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(k, w): v / norm for w, v in raw.items()})
    return out


@pytest.mark.parametrize("sublinear,features", [(False, None), (True, 4)])
def test_tfidf_matches_plain_python(spark, sublinear, features):
    docs = {1: "vpn vpn down again", 2: "mail down", 3: "", 4: "vpn mail mail mail error down", 5: "unrelated"}
    df = spark.createDataFrame(list(docs.items()), "ticket_id bigint, text string")
    got = tfidf.fit_transform(df, "ticket_id", "text", features, sublinear=sublinear).collect()
    want = brute_tfidf(docs, sublinear, features)
    assert {(r.ticket_id, r.term) for r in got} == set(want)
    for r in got:
        assert r.weight == pytest.approx(want[r.ticket_id, r.term], abs=1e-12)


def test_text_is_not_shuffled_for_weights(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    vocab = spark.createDataFrame([("the", 1.0)], "term string, idf double")
    plan = tfidf.transform(docs, vocab, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_weights_of_a_joined_vocabulary_are_the_same(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(40)
    rounded = lambda df: sorted((r.doc_id, r.term, round(r.weight, 9)) for r in df.collect())
    one = rounded(tfidf.fit_transform(docs, "doc_id", "text", 500))
    monkeypatch.setattr(tfidf, "LISTED_TERMS", 10)
    assert rounded(tfidf.fit_transform(docs, "doc_id", "text", 500)) == one


def test_lookup_join_gives_the_same_rows_either_way(spark):
    big = spark.range(100).withColumn("k", F.when(F.col("id") < 60, 0).otherwise(F.col("id") % 7))
    small = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k bigint, v string")
    assert sorted(join_lookup(big, small, "k").collect()) == sorted(join_lookup(big, small, "k", max_rows=2).collect())
    assert fits(small) and not fits(small, max_rows=4) and not fits(small, max_bytes=10)
    with pytest.raises(ValueError, match="more than 4 things"):
        bounded_rows(small, 4, "things")


def test_audits_read_only_their_columns(spark, folder):
    from queuelens.operators import profile

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = profile.value_counts(docs, "source")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<source:string>" in plan and "IsNotNull(source)" in plan and plan.count("partial_count") == 1
