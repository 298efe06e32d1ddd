"""Spelling variants: the trie against comparing all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from queuelens.llm import spelling
from tests.llm import data


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows):
    seen = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def plain_variants(counts):
    out = {}
    for w, n in counts.items():
        near = [(-m, v) for v, m in counts.items() if one_edit(w, v)]
        m, form = min(near, default=(0, None))
        out[w] = [n, len(near), form if near and -m >= 2 * n else None, -m if near and -m >= 2 * n else None]
    for w in out:
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def invented(seed, count=300):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdeéßz") for _ in range(r.randint(4, 9))) for _ in range(count)]
    words = {w: r.randint(3, 40) for w in stems}
    for w in r.sample(stems, count // 2):
        i = r.randrange(len(w))
        made = r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("abcdeé") + w[i:], w[:i] + r.choice("abcdeé") + w[i + 1 :]])
        words[made] = r.randint(3, 9)
    long = "".join(r.choice("abc") for _ in range(3000))
    words |= {long: 9, long[:1500] + "z" + long[1500:]: 4, long[:-1]: 3, "x" * 23: 3, "x" * 24: 6, "x" * 25: 12, "anagram": 4, "nagaram": 4}
    return {w: n for w, n in words.items() if len(w) >= 5}


def got(frame):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in frame.collect()}


@pytest.mark.parametrize("cell_words", [1, 7, 20_000])
def test_variants_equal_the_plain_search(spark, cell_words):
    words = invented(cell_words)
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    assert got(spelling.variants(frame, cell_words=cell_words)) == plain_variants(words)


def test_ties_go_to_the_first_in_code_point_order(spark):
    words = {"seven": 3, "sevan": 9, "sevén": 9, "sevenz": 9, "ßeven": 4}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    found = got(spelling.variants(frame))
    assert found["seven"][:4] == (3, 4, "sevan", 9) and found == plain_variants(words)


def test_a_form_needs_twice_the_count_and_roots_follow_forms(spark):
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 47, "zzzzz": 5, "zzzzy": 9}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    found = got(spelling.variants(frame))
    assert found == plain_variants(words)
    assert found["aaaaa"][4] == "aabbb" and found["aabbb"][2] is None and found["zzzzz"][4] == "zzzzz"


def test_count_of_odd_tables(spark):
    docs = data.documents(spark)
    found = {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()}
    assert found == plain_counts(data.pairs())
    assert spelling.word_counts(data.empty(spark)).count() == 0
    assert spelling.variants(spelling.word_counts(data.empty(spark))).count() == 0


def test_whole_of_documents(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    counts = plain_counts(rows)
    words = spelling.word_counts(spark.read.parquet(f"{folder}/documents.parquet"))
    assert {r["word"]: r["n"] for r in words.collect()} == counts
    near = {}
    keys = {}
    for w in counts:  # pairs share a word with one letter cut out or hidden
        for i in range(len(w)):
            keys.setdefault(("cut", w[:i] + w[i + 1 :]), set()).add(w)
            keys.setdefault((i, w[:i] + "*" + w[i + 1 :]), set()).add(w)
        keys.setdefault(("cut", w), set()).add(w)
    for group in keys.values():
        for a in group:
            near.setdefault(a, set()).update(b for b in group if one_edit(a, b))
    found = got(spelling.variants(words))
    assert {w: v[1] for w, v in found.items()} == {w: len(near[w]) for w in counts}


def test_a_run_is_damaged_by_its_document(spark):
    run = next(r for r in (f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}" for i in range(600)) if zlib.crc32(f"7:{r}".encode()) % 97 == 0)
    docs = spark.createDataFrame([(7, f"{run} {run.upper()} {run}")], "doc_id bigint, text string")
    h = zlib.crc32(f"7:{run}".encode())
    assert [tuple(r) for r in spelling.word_counts(docs).collect()] == [(run[: h % len(run)] + run[h % len(run) + 1 :], 3)]
    assert [tuple(r) for r in spelling.word_counts(docs, damage=0).collect()] == [(run, 3)]


def test_near_is_one_edit():
    r = random.Random(5)
    for _ in range(4000):
        a = "".join(r.choice("ab") for _ in range(r.randint(0, 16)))
        b = "".join(r.choice("ab") for _ in range(r.randint(0, 16)))
        assert spelling.near(a, b) == one_edit(a, b)


def test_a_pair_is_met_by_one_of_its_words():
    r = random.Random(6)
    words = sorted({"".join(r.choice("abcß") for _ in range(r.randint(1, 5))) for _ in range(300)})
    steps, more, less = spelling._visits()
    tops = spelling.Letters.of(words).counts[:, : spelling.CUT]
    cells = {}
    for w, top in zip(words, tops):
        cells.setdefault(top.tobytes(), []).append(w)
    met = Counter()
    for w, top in zip(words, tops):
        for step, m, f in zip(steps, more, less):
            lying = cells.get((top + step).tobytes())
            if lying:
                trie = spelling.Trie(lying, np.ones(len(lying), np.int64))
                for _, j in trie.near([w], np.array([m]), np.array([f])):
                    met.update(frozenset((w, trie.words[k])) for k in j.tolist())
    assert set(met.values()) == {1}
    assert set(met) == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
