import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from queuelens.llm import bands, leaks, line_field, queries
from tests.llm import brute, data


def test_base_measures_equal_brute_force(spark):
    got = bands.rate(data.documents(spark)).collect()
    want = [(d, *brute.base_measures(t)) for d, t in data.pairs()]
    names = ["_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert data.as_set([tuple(r[n] for n in names) for r in got]) == data.as_set(want)
    assert not any(r.kept for r in got if r.base_failed)


def test_bands_of_empty_table(spark):
    assert bands.rate(data.empty(spark)).collect() == []


def test_repetition_and_noise_are_rejected_and_prose_is_kept():
    r = np.random.default_rng(0)
    vocabulary = ["".join(r.choice(list("aeioulnrst"), r.integers(2, 9))) for _ in range(3000)]
    prose = " ".join(r.choice(vocabulary, 900))
    line = " ".join(r.choice(vocabulary, 60))
    noise = " ".join("".join(map(chr, r.integers(0x4E00, 0x9FFF, 8))) for _ in range(300))
    base64 = " ".join("".join(r.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), 70)) for _ in range(100))
    verdict = lambda t: bands.measures(t.encode())[-1]
    assert verdict(prose)
    assert not verdict("\n".join([line] * 200))
    assert not verdict(noise) and not verdict(base64)
    half = prose[: len(prose) // 2] + "\n" + "\n".join([line] * 60)
    assert not verdict(half)  # odd chunks, though the whole may pass


def test_noise_and_repetition_in_a_part_are_rejected_at_any_length():
    r = np.random.default_rng(1)
    vocabulary = ["".join(r.choice(list("aeioulnrst"), r.integers(2, 9))) for _ in range(3000)]
    prose = " ".join(r.choice(vocabulary, 5000))
    noise = "".join(r.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), 9000))
    verdict = lambda t: bands.measures(t.encode())[-1]
    for size in (900, 1300, 2000, 3000, 4095, 4097, 5596, 8191, 8192, 12000, 20000):
        part = int(0.35 * size)
        assert verdict(prose[:size])
        assert not verdict(prose[: size - part] + noise[:part])
        assert not verdict(noise[:part] + prose[: size - part])
        assert not verdict(prose[: size // 3] + noise[:part] + prose[size // 3 : size - part])
    assert not verdict(prose[:4096] + noise[:1500])
    for size in (4000, 5000, 8191):
        assert not verdict(prose[: size // 2] + (prose[-60:] * 100)[: size - size // 2])


def test_every_byte_is_in_a_chunk():
    noise = np.random.default_rng(2).bytes(10000)
    assert bands.chunk_share(noise[:255]) == 0.0
    assert all(bands.chunk_share(noise[:size]) == 1.0 for size in (256, 257, 1023, 4095, 4096, 5000, 8191, 10000))


def test_limits_depend_on_length():
    lows = [b.low for b in bands.BANDS]
    assert [b.at_least for b in bands.BANDS] == sorted(b.at_least for b in bands.BANDS) and lows[1:] == sorted(lows[1:], reverse=True)


def licence(name):
    path = f"/usr/share/common-licenses/{name}"
    if not os.path.exists(path):
        pytest.skip(f"no {path}")
    with open(path, encoding="utf-8") as file:
        return file.read()


LICENCES = ["Apache-2.0", "LGPL-3", "MPL-1.1", "MPL-2.0", "GPL-3", "Artistic"]


@pytest.mark.parametrize("name", LICENCES)
def test_plain_english_is_kept(name):
    assert bands.measures(licence(name).encode())[-1]


@pytest.mark.parametrize("first", [0x430, 0x905, 0x10D0], ids=["Cyrillic", "Devanagari", "Georgian"])
def test_limits_do_not_depend_on_the_bytes_of_a_letter(first):
    """Prose and repetition written letter by letter in two and three bytes a letter."""
    other = lambda text: "".join(chr(first + ord(c) - 97) if "a" <= c <= "z" else c for c in text.lower())
    for name in LICENCES:
        text = licence(name).lower()
        plain, changed = bands.measures(text.encode()), bands.measures(other(text).encode())
        assert plain[-1] and changed[-1]
        assert abs(plain[6] - changed[6]) < 0.01
    assert not bands.measures(other("\n".join([licence("Apache-2.0")[2000:2400]] * 40)).encode())[-1]


@pytest.mark.parametrize("language", ["ru", "ja", "zh_CN", "zh_TW"])
def test_real_prose_of_other_scripts_is_within_the_limits(language):
    path = f"/usr/share/gnupg/help.{language}.txt"
    if not os.path.exists(path):
        pytest.skip(f"no {path}")
    with open(path, encoding="utf-8") as file:
        text = "\n".join(line for line in file.read().split("\n") if not line.isascii())
    assert bands.measures(text.encode())[-1]


def enumerate_chain(unary, ties):
    """Marginals and log sum over all labelings of one short chain."""
    n = len(unary)
    total, good = 0.0, np.zeros(n)
    for code in range(1 << n):
        y = [code >> i & 1 for i in range(n)]
        w = np.exp(sum(unary[i][y[i]] for i in range(n)) + sum(ties[y[i - 1]][y[i]] for i in range(1, n)))
        total += w
        good += w * np.array(y)
    return good / total, np.log(total)


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(3)
    lengths = np.array([3, 1, 7, 4])
    unary, ties = r.normal(size=(lengths.sum(), 2)), r.normal(size=(2, 2))
    ahead, back, total = line_field.Chains(lengths).passes(unary, ties)
    both = ahead + back
    good = np.exp(both[:, 1] - line_field._log_sum(both))
    at = 0
    for k, n in enumerate(lengths):
        want, z = enumerate_chain(unary[at : at + n], ties)
        assert np.allclose(good[at : at + n], want) and np.isclose(total[k], z)
        at += n


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op2_quality_field(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(got[r.doc_id].held_out for r in held) and len(got) == 1000
    right = [got[r.doc_id].predicted == r.quality for r in held]
    kept = [got[r.doc_id].predicted for r in held if r.quality == 1]
    assert np.mean(right) >= 0.95 and np.mean(kept) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_score_depends_on_the_text_alone(spark):
    docs = data.documents(spark)
    labels = spark.createDataFrame([(r.doc_id, int(r.doc_id % 2)) for r in docs.collect() if r.doc_id is not None], "doc_id bigint, quality int")
    field = line_field.learn(docs, labels)
    scored = line_field.score(docs, field, column="_score")
    other = line_field.score(docs.withColumns({c: F.lit(None).cast("string") for c in ("lang", "source", "doc_id")}), field, column="_score")
    by_text = lambda df: sorted((r.text or "", round(r._score, 9)) for r in df.collect())
    assert by_text(scored) == by_text(other)
    assert scored.columns == [*docs.columns, "_score"] and scored.count() == docs.count()


@pytest.mark.parametrize("labels,want", [([], 1.0), ([(1, 1), (9, 1)], 1.0), ([(3, 0), (9, 0)], 0.0), ([(1, None), (9, 5)], 1.0)])
def test_labels_of_one_class_or_none(spark, labels, want):
    docs = data.documents(spark)
    field = line_field.learn(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert {r.s for r in line_field.score(docs, field, column="s").collect()} == {want}


def test_field_of_empty_table(spark):
    docs, labels = data.empty(spark), spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    assert line_field.score(docs, line_field.learn(docs, labels)).collect() == []


def test_held_out_labels_are_not_learned(spark):
    docs = data.documents(spark)
    keys = [r.doc_id for r in docs.collect() if r.doc_id is not None]
    away = [k for k in keys if zlib.crc32(str(k).encode()) % 4 == 2]
    labels = [(k, k % 2) for k in keys]
    changed = [(k, 1 - k % 2 if k in away else k % 2) for k in keys]
    one, two = (line_field.learn(docs, spark.createDataFrame(x, "doc_id bigint, quality int")) for x in (labels, changed))
    assert np.array_equal(one.weights, two.weights)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank, and then it sleeps until noon."),
    (2, "Which of these planets, seen from the sun, is the third one? Answer in a single short sentence please."),
    (3, "tiny"),
    (4, None),
    (5, "Short item here"),
    (6, "the quick brown fox jumps over the lazy dog, near the old river bank -- and then it sleeps until NOON"),
    (None, "an item that has no id at all but a text which is long enough to be found"),
]


def edited(text, count, seed):
    r = np.random.default_rng(seed)
    out = list(text)
    for at in sorted(r.choice(len(out), count, replace=False), reverse=True):
        kind = r.integers(0, 3)
        if kind == 0:
            out[at] = "q"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, "z")
    return "".join(out)


def test_leaks_equal_the_plain_table(spark):
    r = np.random.default_rng(2)
    rows = [(i, t) for i, (_, t) in enumerate(data.pairs()) if t is None or len(t) < 500]
    for i in range(60):
        key = [0, 1, 4][i % 3]
        text = edited(leaks.normalised(ITEMS[key][1]), int(r.integers(0, 9)) if key != 4 else i % 2, i)
        rows.append((1000 + i, "before it " + text + " after it"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {r.doc_id: list(zip(r._items, r._distances)) for r in leaks.find_leaks(docs, items).collect()}
    want = {}
    for d, t in rows:
        found = []
        for key, text in ITEMS:
            item = leaks.normalised(text or "")
            if key is None or len(item) < 8:
                continue
            budget, _ = leaks.pieces(item, leaks.EDIT_RATE)
            near = brute.edit_distance_within(item, leaks.normalised(t or ""))
            if near <= budget:
                found.append((key, near))
        want[d] = found
    assert got == want
    assert sum(map(bool, want.values())) > 20


def test_leaks_keep_every_row_and_column(spark):
    docs, items = data.documents(spark), spark.createDataFrame([(1, "not in there at all, this text")], "item_id bigint, text string")
    got = leaks.find_leaks(docs, items)
    assert got.columns == [*docs.columns, "_items", "_distances"] and got.count() == docs.count()
    assert leaks.find_leaks(data.empty(spark), items).collect() == []
    none = leaks.find_leaks(docs, items.limit(0)).select("_items").distinct().collect()
    assert [r._items for r in none] == [[]]


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ITEMS[0][1] + " " + ITEMS[1][1])], "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    monkeypatch.setattr(leaks, "MAX_ITEM_CHARS", 50)
    assert len(leaks.prepare(ITEMS)) > 2
    assert leaks.find_leaks(docs, items).first()._items == [1, 2, 6]


def test_too_many_items_are_refused(spark, monkeypatch):
    monkeypatch.setattr(leaks, "MAX_ALL_CHARS", 100)
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="in parts"):
        leaks.find_leaks(docs, spark.createDataFrame(ITEMS, "item_id bigint, text string"))


def test_planted_items_are_found(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: set(r.item_ids) for r in queries.op4_decontamination(spark, sf_dir).collect()}
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    planted = {(d.doc_id, i.item_id) for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() for i in items if i.text in d.text}
    assert planted and all(i in got[d] for d, i in planted)


def test_myers_distance_equals_the_plain_table():
    r = np.random.default_rng(4)
    for _ in range(200):
        a = "".join(r.choice(list("abc"), r.integers(1, 90)))
        b = "".join(r.choice(list("abc"), r.integers(0, 120)))
        assert leaks.distance(leaks.places(a), len(a), b) == brute.edit_distance_within(a, b)


def test_leaks_hash_little_text_at_once():
    import tracemalloc

    blocks = leaks.prepare([(i, t) for i, (_, t) in enumerate(ITEMS)])
    flags = {g: np.unpackbits(f).astype(bool) for g, (_, _, f) in blocks[0].grams.items()}
    texts = ["plain words of a long text " * (leaks.BLOCK_BYTES // 27)]
    tracemalloc.start()
    leaks.search(texts, blocks[0], flags, {})
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 32 << 20
