import numpy as np
import pytest
from pyspark.sql import functions as F

from queuelens.llm import components, line_dedup, simhash, windows
from tests.llm import brute, data


def test_windows_equal_brute_force(spark):
    got = windows.remove_repeats(data.documents(spark), length=50, buckets=7)
    assert data.as_set(got.drop("text").collect()) == data.as_set(brute.substring_dedup(data.pairs()))


def test_windows_text_and_digest_agree(spark):
    got = windows.remove_repeats(data.documents(spark), length=5)
    assert got.where(F.sha2("text", 256) != F.col("kept_sha256")).count() == 0
    assert data.as_set(got.drop("text").collect()) == data.as_set(brute.substring_dedup(data.pairs(), 5))


def test_windows_of_empty_table(spark):
    assert windows.remove_repeats(data.empty(spark)).collect() == []


def test_blocks_know_their_own_repeats():
    texts = [b"a b c d", b"x a b c", b"a b c a b c"]
    first, _, ids, known = windows.block_entries(np.array([5, 3, 9]), texts, 3)
    by = {}
    for h, d, k in zip(first.tolist(), ids.tolist(), known.tolist()):
        by.setdefault(h, set()).add((d, k))
    assert {(3, False), (5, True), (9, True)} in by.values()


def test_intervals_are_maximal():
    gone = windows.covered(12, np.array([1, 3, 8]), 3)
    assert windows.intervals(gone) == [(1, 6), (8, 11)]


def test_lines_equal_brute_force(spark):
    got = line_dedup.dedup_lines(data.documents(spark), min_chars=20, min_docs=5)
    found = got.select("doc_id", "_n_lines", "_n_dropped", F.sha2("text", 256)).collect()
    assert data.as_set(found) == data.as_set(brute.line_dedup(data.pairs(), 20, 5))
    assert got.columns[: len(data.SCHEMA.split(", "))] == [c.split()[0] for c in data.SCHEMA.split(", ")]


@pytest.mark.parametrize("batches,fan_out", [(1, 2), (5, 2), (4, 3)])
def test_lines_do_not_depend_on_batches(spark, batches, fan_out):
    got = line_dedup.dedup_lines(data.documents(spark), min_chars=20, min_docs=3, batches=batches, fan_out=fan_out)
    found = got.select("doc_id", "_n_lines", "_n_dropped", F.sha2("text", 256)).collect()
    assert data.as_set(found) == data.as_set(brute.line_dedup(data.pairs(), 20, 3))


def test_lines_of_empty_table(spark):
    assert line_dedup.dedup_lines(data.empty(spark)).collect() == []


def test_runs_tell_new_keys_from_known_ones(spark):
    runs = line_dedup.LineRuns(spark, fan_out=2)
    batch = lambda keys: spark.createDataFrame([(k, k, 1, 9) for k in keys], "_h1 bigint, _h2 bigint, _docs bigint, _last bigint")
    new = []
    for keys in ([1, 2, 3], [2, 4], [4, 5, 1]):
        added = runs.add(batch(keys))
        new.append(sorted(r._h1 for r in added.where("_new").collect()))
    assert new == [[1, 2, 3], [4], [5]]
    assert [len(level) for level in runs.levels] == [1, 1]
    assert {r._h1: r._docs for r in runs.totals().collect()} == {1: 2, 2: 2, 3: 1, 4: 2, 5: 1}
    runs.close()


def test_simhash_equals_brute_force(spark):
    got = simhash.near_duplicates(data.documents(spark)).select("_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")), "_component")
    assert data.as_set(got.collect()) == data.as_set(brute.near_duplicates(data.pairs()))


def test_simhash_of_empty_table(spark):
    assert simhash.near_duplicates(data.empty(spark)).collect() == []


def test_one_row_of_each_group_stays(spark):
    docs = data.documents(spark)
    kept = simhash.keep_one(docs)
    groups = {c for _, _, c in brute.near_duplicates(data.pairs())}
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(g for g in groups if g is not None)


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_bit_slices_find_every_pair(radius):
    r = np.random.default_rng(radius)
    mask = simhash.MASKS[9]
    bits = [b for b in range(64) if not mask >> b & 1]
    values = np.unique(r.integers(0, 1 << 16, 900))
    spread = np.array([sum((int(v) >> i & 1) << b for i, b in enumerate(bits)) for v in values], np.uint64)
    got = {(i, j) for i, others in simhash.near_pairs(spread, bits, radius) for j in others.tolist()}
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if (int(spread[i]) ^ int(spread[j])).bit_count() <= radius}
    assert got == want


def test_links_connect_random_fingerprints(spark):
    r = np.random.default_rng(5)
    values = set()
    for base in r.integers(0, 1 << 62, 20):
        for _ in range(30):
            v = int(base)
            for b in r.integers(0, 64, r.integers(0, 4)):
                v ^= 1 << int(b)
            values.add(v - (1 << 64) if v >> 63 else v)
    nodes = spark.createDataFrame([(v,) for v in values], "_fp bigint")
    labels = {r._node: r._label for r in components.component_labels(simhash.links(nodes)).collect()}
    unsigned = sorted(v % (1 << 64) for v in values)
    root = {v: v for v in unsigned}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(unsigned):
        for b in unsigned[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    want = {}
    for v in unsigned:
        want.setdefault(find(v), set()).add(v)
    got = {}
    for v in values:
        got.setdefault(labels.get(v, v), set()).add(v % (1 << 64))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "_a bigint, _b bigint")
    labels = {r._node: r._label for r in components.component_labels(edges).collect()}
    assert labels == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
