"""Jump consistent sharding."""

import zlib
from collections import Counter, defaultdict

import numpy as np

from queuelens.llm import sharding
from tests.llm import data


def plain_jump(key, shards):
    key %= 1 << 64
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_equals_the_plain_loop():
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(500), *range(10**17, 10**17 + 50)]
    for shards in (1, 2, 7, 24, 25, 1000):
        assert sharding.jump(np.array(keys, np.int64).view(np.uint64), shards).tolist() == [plain_jump(k, shards) for k in keys]


def test_only_the_necessary_share_moves():
    keys = np.arange(200_000, dtype=np.uint64)
    before, after = sharding.jump(keys, 24), sharding.jump(keys, 25)
    moved = before != after
    assert (after[moved] == 24).all() and abs(moved.mean() - 1 / 25) < 0.004
    assert np.bincount(before).max() / np.bincount(before).min() < 1.1


def test_odd_table(spark):
    docs = data.documents(spark)
    rows = data.pairs()
    found = sharding.shard_texts(docs, 5).collect()
    want = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "key",
                    plain_jump(-1 if d is None else d, 5), plain_jump(-1 if d is None else d, 6)) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in found), key=repr) == want
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append((r.slot, r.doc_id))
    for held in slots.values():
        assert [s for s, _ in sorted(held)] == list(range(len(held)))
        ids = [float("-inf") if d is None else d for _, d in sorted(held)]
        assert ids == sorted(ids)


def test_clashing_names_come_back(spark):
    docs = data.documents(spark).selectExpr("*", "1 as shard", "2 as slot", "3 as key", "'x' as file", "4 as row", "5 as grown_shard")
    path = sharding.write_shards(docs, "doc_id", 3)
    back = sharding.read_shards(spark, path, docs.schema).select("row.*")
    assert back.columns == docs.columns
    assert sorted(map(repr, back.collect())) == sorted(map(repr, docs.collect()))
    assert sharding.shard_texts(docs, 3).count() == docs.count()


def test_empty_table_and_other_keys(spark):
    assert sharding.shard_texts(data.empty(spark), 24).count() == 0
    named = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z"), ("a", "w")], "doc_id string, text string")
    found = sharding.shard_texts(named, 4).collect()
    assert len(found) == 4 and len({r.shard for r in found if r.doc_id == "a"}) == 1


def test_one_key_of_a_third_of_all_rows(spark):
    rows = [(None if i % 3 == 0 else i, f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    found = sharding.shard_texts(docs, 24).collect()
    shares = Counter(r.shard for r in found)
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(n)) for s, n in shares.items())
