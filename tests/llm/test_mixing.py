import collections

import numpy as np
import pytest

from queuelens.llm import mixing, tokens
from tests.llm import brute, data


def test_targets_share_the_excess():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    assert mixing.targets([10, 1000, 10], [1, 1, 8]) == [30, 960, 30]
    assert mixing.targets([], []) == [] and mixing.targets([0, 5], [1, 1]) == [0, 5]
    r = np.random.default_rng(0)
    for _ in range(50):
        sizes = r.integers(0, 1000, 12).tolist()
        weights = [1 + i % 3 for i in range(12)]
        got = mixing.targets(sizes, weights)
        assert np.isclose(sum(got), sum(sizes)) and all(t <= 3 * n + 1e-9 for t, n in zip(got, sizes))
        free = {round(t / w, 6) for t, n, w in zip(got, sizes, weights) if t < 3 * n - 1e-6}
        assert len(free) <= 1  # all that are not cut off get the same per weight


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutations_are_permutations(size):
    one = mixing.permuted(np.arange(size), size, mixing.hash_key(42, 3, 0))
    assert sorted(one.tolist()) == list(range(size))
    if size > 60:
        assert (one != mixing.permuted(np.arange(size), size, mixing.hash_key(42, 3, 1))).mean() > 0.9


def test_draws_add_up_and_never_exceed():
    rng, left = np.random.default_rng(1), np.array([5, 0, 1000, 3])
    got = mixing.draw(rng, 900, left)
    assert got.sum() == 900 and (got <= left).all()
    assert mixing.draw(rng, 5000, left).tolist() == left.tolist()


def mixed(spark, docs, **options):
    plan = mixing.plan_mix(docs, **options)
    return plan, [tuple(r) for r in mixing.taken(plan, options.get("block_words", 64)).collect()]


def test_mix_keeps_its_promises(spark):
    docs = data.documents(spark)
    plan, got = mixed(spark, docs, block_words=16, shard_slots=32)
    sizes = collections.Counter()
    for _, text, _, source, _ in data.rows():
        sizes[source] += len(brute.words(text))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = dict(zip(order, mixing.targets([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))])))
    assert len(got) == len(data.rows())
    assert data.as_set((d, n) for d, n, *_ in got) == data.as_set((d, len(brute.words(t))) for d, t in data.pairs())
    took = collections.Counter()
    for _, size, source, source_size, target, taken in got:
        assert source_size == sizes[source] and np.isclose(target, want[source])
        assert 0 <= taken <= 3 * size
        took[source] += taken
    for source in order:
        assert abs(took[source] - want[source]) <= 1.5 * 16  # half a block, and the last block may be short
    shards = collections.Counter(r.shard for r in plan.draws.collect())
    assert set(list(shards.values())[:-1]) <= {32} or sorted(shards.values())[-2] == 32
    slots = [(r.shard, r.slot) for r in plan.draws.collect()]
    assert len(slots) == len(set(slots))


def test_mix_does_not_depend_on_partitions(spark):
    docs = data.documents(spark)
    one, two = mixed(spark, docs)[1], mixed(spark, docs.repartition(3, "source"))[1]
    assert data.as_set(one) == data.as_set(two)


def test_mixed_texts_hold_the_words_taken(spark):
    docs = data.documents(spark)
    plan, got = mixed(spark, docs, block_words=8)
    out = mixing.mixed_texts(docs, plan, 8)
    assert out.columns == docs.columns
    have, want = collections.Counter(), collections.Counter()
    for r in out.collect():
        have[r.doc_id] += len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    for d, _, _, _, _, taken in got:
        want[d] += taken
    assert {k: v for k, v in have.items() if v} == {k: v for k, v in want.items() if v}
    source = collections.defaultdict(collections.Counter)
    for d, t in data.pairs():
        source[d].update(brute.words(t))
    for r in out.collect():
        assert set(brute.words(r.text)) <= set(source[r.doc_id])


def test_shards_hold_the_words_of_the_mix(spark):
    docs = data.documents(spark)
    plan, got = mixed(spark, docs, block_words=16, shard_slots=32)
    shards, draws = plan.shards.collect(), plan.draws.collect()
    key = lambda r: (r.shard, r.slot, r._no, r["pass"], r._block)
    assert sorted(map(key, shards)) == sorted(map(key, draws)) and len(shards) > 100
    spans = {(r._no, r._start): r for r in plan.spans.collect()}
    text = {(r.doc_id, r.source, r._tie): brute.words(r.text) for r in docs.selectExpr("*", "xxhash64(text) AS _tie").collect()}
    line = {}
    for (no, start), r in spans.items():
        line.update({(no, start + i): w for i, w in enumerate(text[r._id, r._source, r._tie])})
    for r in shards:
        want = [line[r._no, i] for i in range(r._block * 16, r._block * 16 + 16) if (r._no, i) in line]
        assert r.words.split(" ") == want and sum(p.b - p.a for p in r._parts) == len(want)
    assert sum(len(r.words.split(" ")) for r in shards) == sum(r[-1] for r in got)
    half = plan._replace(shards=plan.shards.where("pass = 0 and shard < 3"))
    assert sum(r._taken for r in mixing.taken(half, 16).collect()) == sum(len(r.words.split(" ")) for r in shards if r["pass"] == 0 and r.shard < 3)
    out = mixing.mixed_texts(docs, half, 16).collect()
    assert sum(len(brute.words(r.text)) for r in out) == sum(r._taken for r in mixing.taken(half, 16).collect())


def test_texts_and_words_move_as_frames(spark, monkeypatch):
    seen, keyed, shards = [], mixing._keyed, mixing._shards
    monkeypatch.setattr(mixing, "_keyed", lambda docs, sources: seen.append(docs) or keyed(docs, sources))
    monkeypatch.setattr(mixing, "_shards", lambda *args: seen.append(shards(*args)) or seen[-1])
    body = [" ".join(f"{'some words that many texts share'} {(i * 37 + k) % 101}" for k in range(60)) for i in range(200)]
    docs = spark.createDataFrame([(i, t, f"s{i % 3}") for i, t in enumerate(body)] + [(200, None, "s0"), (201, "", None)], "doc_id bigint, text string, source string")
    plan = mixing.plan_mix(docs, block_words=16, shard_slots=32)
    texts, said = seen
    assert dict(texts.dtypes)["_text"] == "binary" and "_said#" in said._jdf.queryExecution().optimizedPlan().toString()
    assert sum(len(r._text) for r in texts.collect()) < 0.3 * sum(map(len, body))
    assert sum(len(r.words.split(" ")) for r in plan.shards.collect()) == sum(r._taken for r in mixing.taken(plan, 16).collect()) > 0


def test_mix_of_empty_tables(spark):
    assert mixed(spark, data.empty(spark))[1] == []
    blank = data.documents(spark).where("text is null or trim(text) = ''")
    plan, got = mixed(spark, blank)
    assert all(r[5] == 0 for r in got) and plan.draws.count() == 0 and mixing.mixed_texts(blank, plan).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp

    sf_dir = "/root/testdata/sf0.001"
    first = spark.read.parquet(f"{sf_dir}/documents.parquet").drop("n_chars").withColumn("n_chars", __import__("pyspark.sql.functions").sql.functions.char_length("text").cast("bigint"))
    docs = first
    columns = first.columns
    seen = []
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir)
        path = f"{tmp_path}/{len(seen)}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs)
        if stage is not cp.token_ids:
            assert docs.columns == columns
    kept, single, clean, mix, ids = seen
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    stay = {r.doc_id for r in kept.collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in stay for d in good) >= 0.95 * len(good)
    want = {c for _, _, c in brute.near_duplicates([(r.doc_id, r.text) for r in kept.collect()])}
    assert {r.doc_id for r in single.collect()} == want
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in single.collect()} - {r.doc_id for r in clean.collect()}
    assert {r.doc_id for r in single.collect() if any(i in r.text for i in items)} <= gone
    assert len(gone) < 0.2 * single.count()
    assert ids.count() == mix.count()


def test_pipeline_of_an_empty_table(spark):
    import corpus_pipeline as cp

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.collect() == [] and tokens is not None


def test_pipeline_hands_python_small_batches(spark):
    import corpus_pipeline as cp
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    before = spark.conf.get(cp.ARROW_BYTES, None)
    spark.conf.unset(cp.ARROW_BYTES)
    try:
        docs = spark.range(0, 6000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")
        stage = cp.small_batches(lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "n bigint"))
        assert max(r.n for r in stage(spark, docs, "").collect()) < 2 * cp.MAX_ARROW_BYTES
        spark.conf.set(cp.ARROW_BYTES, "1000000")
        assert max(r.n for r in stage(spark, docs, "").collect()) < 2_000_000
    finally:
        spark.conf.unset(cp.ARROW_BYTES)
        if before is not None:
            spark.conf.set(cp.ARROW_BYTES, before)
