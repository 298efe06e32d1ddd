"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Letters fall into ``GROUPS`` groups. A word is placed in the trie by how often each group occurs
in it, one group a level. One edit changes these counts by at most one letter too many (the
surplus) and one too few (the deficit), so a depth-first search that may spend one of each meets
every word one edit away; the words at the leaves are then compared letter by letter.

The upper ``CUT`` levels deal the work out: words that agree there are a cell, and a cell of more
than ``CELL_WORDS`` words is cut into blocks by hash. A word visits each cell its budget can
reach, in all blocks of it. A task holds the trie of one block and streams the visitors by.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.functions.lookup import join_lookup
from queuelens.llm.common import slices, texts_of
from queuelens.session import materialise, scratch

GROUPS = 16
CUT = 6
CELL_WORDS = 20_000
MIN_CHARS = 5
MIN_COUNT = 3
DAMAGE = 97
HELD_WORDS = 200_000  # different words that a task counts before it hands them on
BLOCK_BYTES = 1 << 20
WORDS_AT_ONCE = 4096
STEPS_AT_ONCE = 1 << 16
SHORT = 24  # words below so many code points are compared many at a time


def runs_pattern(min_chars: int) -> re.Pattern:
    """Letter runs of a lower-cased text that can give a word of ``min_chars``; shorter ones are passed over."""
    return re.compile("[A-Za-z\u00c0-\u00ff]{%d,}" % max(1, min_chars))


def add_runs(held: Counter, doc_id: str, text: bytes, pattern: re.Pattern, damage: int = DAMAGE) -> None:
    """Adds the letter runs of a text, A-Z lower-cased, to the counts held.

    With ``damage`` a run whose crc32 with the id it divides has one code point removed, so that
    a text has the slips that its table lacks. 0: none.
    """
    found = Counter(pattern.findall(text.lower().decode()))  # bytes.lower() changes A-Z alone
    start, crc32 = zlib.crc32(doc_id.encode() + b":"), zlib.crc32
    for run, count in found.items():
        if damage and not (h := crc32(run.encode(), start)) % damage:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        held[run] += count


def word_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, damage: int = DAMAGE,
) -> DataFrame:
    """(word, n): words of at least ``min_chars`` code points found at least ``min_count`` times.

    A null text has no words; a null id is read as an empty one. Words are counted where the
    texts lie and added up by word, so a word's rows do not depend on how common it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pattern = Counter(), runs_pattern(min_chars)

        def counted() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        for piece in slices(batches, "_text", BLOCK_BYTES):
            ids = piece.column(0).to_pylist()
            for d, t in zip(ids, texts_of(piece.column(1))):
                add_runs(held, d or "", t, pattern, damage)
            if len(held) >= HELD_WORDS:
                yield counted()
                held.clear()
        if held:
            yield counted()

    given = docs.select(F.col(doc_id).cast("string").alias("_id"), F.col(text).cast("string").alias("_text"))
    counts = given.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where((F.col("n") >= min_count) & (F.length("word") >= min_chars))


@dataclass(frozen=True)
class Letters:
    """Words as numbers: a row per word."""

    length: np.ndarray
    counts: np.ndarray  # (words, GROUPS): letters of each group
    halves: np.ndarray  # (words, 4): hashes of the first and last half; the same with one letter less
    front: np.ndarray  # (words, SHORT): the first code points, zero where there is none
    back: np.ndarray  # (words, SHORT): the last ones, from the end

    @classmethod
    def of(cls, words: list[str]) -> Letters:
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        length = np.fromiter(map(len, words), np.int64, len(words))
        row, start = np.repeat(np.arange(len(words)), length), np.cumsum(length) - length
        counts = np.bincount(row * GROUPS + points % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
        most = int(length.max(initial=0)) + 1
        power, undo = (np.multiply.accumulate(np.array([1] + [x] * most, np.uint64)) for x in (_BASE, _BACK))
        terms = (points + 1).astype(np.uint64) * power[np.arange(len(points)) - start[row]]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        halves = []
        for whole in (length, np.maximum(length - 1, 0)):
            first = whole // 2
            last = length - (whole - first)
            halves += [sums[start + first] - sums[start], (sums[start + length] - sums[start + last]) * undo[last]]
        place = np.arange(SHORT)
        held = np.concatenate([points, np.zeros(SHORT, np.int64)])
        inside = place < length[:, None]
        front = np.where(inside, held[start[:, None] + place], 0)
        back = np.where(inside, held[(start + length)[:, None] - 1 - place], 0)
        return cls(length, counts, np.stack(halves, axis=1), front.astype(np.uint32), back.astype(np.uint32))

    def taken(self, rows: np.ndarray) -> Letters:
        return Letters(self.length[rows], self.counts[rows], self.halves[rows], self.front[rows], self.back[rows])


_BASE = 0x9E3779B97F4A7C15  # odd, so powers can be undone modulo 2**64
_BACK = pow(_BASE, -1, 1 << 64)


def _visits() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a visited cell's counts have more or less than the word's, and the surplus and deficit left.

    Of two words the one searches that is shorter or, at equal length, has its surplus at the
    earlier level; so a pair of different counts is met once.
    """
    steps, more, less = [np.zeros(CUT, np.int64)], [1], [1]
    for i in range(CUT):
        for j in range(i, CUT):
            step = np.zeros(CUT, np.int64)
            step[i] = 1
            if j > i:
                step[j] = -1
            steps.append(step)
            more.append(0)
            less.append(int(j == i))
    return np.array(steps), np.array(more), np.array(less)


def near(a: str, b: str) -> bool:
    """True if one inserted, deleted or replaced code point makes one word of the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, short = 0, min(len(a), 12)
    while low < short and a[low] == b[low]:
        low += 1
    if low == short:  # a long common start is found by halves
        high = len(a)
        while low < high:
            middle = (low + high + 1) // 2
            if a[low:middle] == b[low:middle]:
                low = middle
            else:
                high = middle - 1
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


class Trie:
    """Words by the counts of the groups from ``CUT`` on, a level each.

    Nodes of a level are numbered; the children of all are one sorted array of (node, count).
    """

    def __init__(self, words: list[str], n: np.ndarray) -> None:
        letters = Letters.of(words)
        order = np.lexsort(letters.counts[:, :CUT - 1 : -1].T) if len(words) else np.zeros(0, np.int64)
        self.words, self.n, self.letters = [words[i] for i in order], n[order], letters.taken(order)
        self.span = int(self.letters.counts.max(initial=0)) + 1
        self.children = []
        node = np.zeros(len(words), np.int64)
        for level in range(CUT, GROUPS):
            key = node * self.span + self.letters.counts[:, level]
            new = np.diff(key, prepend=-1) != 0
            self.children.append(key[new])
            node = np.cumsum(new) - 1
        self.first = np.concatenate([np.flatnonzero(np.diff(node, prepend=-1)), [len(words)]])  # of each leaf

    def search(self, counts: np.ndarray, more: np.ndarray, less: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Depth first, (visitor, leaf) of all leaves in reach of rows of counts with what they may
        still have more and less. A letter less may only follow a letter more; the other order is the
        other word's search. Visitors go down together, so many at a time as ``STEPS_AT_ONCE``.
        """
        stack = [(CUT, np.arange(len(counts)), np.zeros(len(counts), np.int64), more, less)]
        while stack:
            level, visitor, node, more, less = stack.pop()
            if len(visitor) > STEPS_AT_ONCE:
                half = len(visitor) // 2
                stack += [(level, visitor[s], node[s], more[s], less[s]) for s in (slice(half, None), slice(0, half))]
                continue
            count, keys = counts[visitor, level], self.children[level - CUT]
            found = []
            for step in (0, 1, -1):
                ok = count + step < self.span
                if step == 1:
                    ok &= more > 0
                elif step == -1:
                    ok &= (more == 0) & (less > 0) & (count > 0)
                at = np.flatnonzero(ok)
                key = node[at] * self.span + count[at] + step
                child = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[child] == key
                at, child = at[hit], child[hit]
                found.append((visitor[at], child, more[at] if step != 1 else more[at] * 0, less[at] if step != -1 else less[at] * 0))
            visitor, child, more, less = (np.concatenate(x) for x in zip(*found))
            if not len(visitor):
                continue
            if level == GROUPS - 1:
                yield visitor, child
            else:
                stack.append((level + 1, visitor, child, more, less))

    def near(self, words: list[str], more: np.ndarray, less: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place among the visitors, place in the trie) of pairs one edit apart, many at a time.

        Words of a leaf whose first or last half agrees with the visitor's, by hash, are compared:
        what two words share at the start and at the end must make up all but the edit.
        """
        letters = Letters.of(words)
        for visitor, leaf in self.search(letters.counts, more, less):
            size = self.first[leaf + 1] - self.first[leaf]
            cuts = np.flatnonzero(np.diff(np.cumsum(size) // STEPS_AT_ONCE)) + 1
            for v, f, k in zip(*(np.split(x, cuts) for x in (visitor, self.first[leaf], size))):
                a = np.repeat(v, k)
                b = np.repeat(f - (np.cumsum(k) - k), k) + np.arange(len(a))
                longer = self.letters.length[b] - letters.length[a]
                mine, theirs = letters.halves[a], self.letters.halves[b]
                same = (longer == 0) & ((mine[:, 0] == theirs[:, 0]) | (mine[:, 1] == theirs[:, 1]))
                same |= (longer == 1) & ((mine[:, 0] == theirs[:, 2]) | (mine[:, 1] == theirs[:, 3]))
                a, b, longer = a[same], b[same], longer[same]
                length = letters.length[a]
                start = _agree(letters.front[a], self.letters.front[b])
                end = _agree(letters.back[a], self.letters.back[b])
                fine = (np.minimum(start, length) + np.minimum(end, length) >= length - (longer == 0)) & ((longer > 0) | (start < length))
                for i in np.flatnonzero(length >= SHORT):
                    fine[i] = near(words[a[i]], self.words[b[i]])
                a, b = a[fine], b[fine]
                level = (letters.counts[a] == self.letters.counts[b]).all(axis=1)
                for i in np.flatnonzero(level):  # words of equal counts meet in both searches; the lesser one speaks
                    level[i] = words[a[i]] > self.words[b[i]]
                yield a[~level], b[~level]


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading entries of two rows agree."""
    return np.logical_and.accumulate(a == b, axis=1).sum(axis=1)


def _cells(words: DataFrame) -> DataFrame:
    """(word, n, visit, cell, more, less): a row where a word lies, and one per visit."""
    steps, more, less = _visits()
    steps, more, less = np.concatenate([steps[:1], steps]), np.concatenate([[0], more]), np.concatenate([[0], less])
    kinds = np.arange(len(steps)) > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(a, WORDS_AT_ONCE) for a in range(0, batch.num_rows, WORDS_AT_ONCE)):
                cells = Letters.of(part.column(0).to_pylist()).counts[:, None, :CUT] + steps
                row, kind = np.nonzero((cells >= 0).all(axis=2))
                data = np.ascontiguousarray(cells[row, kind].astype("<u4"))
                ends = pa.py_buffer(np.arange(0, 4 * CUT * len(row) + 1, 4 * CUT, dtype=np.int32))
                at = pa.array(row)
                yield pa.record_batch({
                    "word": part.column(0).take(at), "n": part.column(1).take(at), "visit": pa.array(kinds[kind].astype(np.int32)),
                    "cell": pa.Array.from_buffers(pa.binary(), len(row), [None, ends, pa.py_buffer(data)]),
                    "more": pa.array(more[kind].astype(np.int32)), "less": pa.array(less[kind].astype(np.int32)),
                })

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, visit int, cell binary, more int, less int")


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, near, near_n): every word of (word, n) with each word one edit away."""
    dealt = _cells(words)
    sizes = dealt.where("visit = 0").groupBy("cell").agg(F.ceil(F.count("*") / cell_words).cast("int").alias("blocks"))
    placed = join_lookup(dealt, materialise(sizes, "spelling-cells"), "cell", "inner")  # no visits where no word lies
    own = F.array(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = placed.withColumn("block", F.explode_outer(F.when(F.col("visit") == 0, own).otherwise(every)))
    sorted_rows = placed.repartition("cell", "block").sortWithinPartitions("cell", "block", "visit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks lie one after the other, in each the words of the trie before its visitors."""
        held, lying, trie = None, [], None
        for batch in batches:
            cells, blocks = batch.column("cell").to_pylist(), batch.column("block").to_pylist()
            words, n = batch.column("word").to_pylist(), np.asarray(batch.column("n"))
            visit, more, less = (np.asarray(batch.column(x)).astype(np.int64) for x in ("visit", "more", "less"))
            starts = [i for i in range(len(cells)) if (visit[i] != visit[i - 1] or cells[i] != cells[i - 1] or blocks[i] != blocks[i - 1]) or not i]
            left, right, left_n, right_n = [], [], [], []
            for a, b in zip(starts, [*starts[1:], len(cells)]):
                if (cells[a], blocks[a]) != held:
                    held, lying, trie = (cells[a], blocks[a]), [], None
                if not visit[a]:
                    lying.append((words[a:b], n[a:b]))
                    continue
                if trie is None:
                    trie = Trie([w for x, _ in lying for w in x], np.concatenate([x for _, x in lying]) if lying else np.zeros(0, np.int64))
                    lying = []
                if not trie.words:  # a block that no word of its cell falls into
                    continue
                for i, j in trie.near(words[a:b], more[a:b], less[a:b]):
                    left += [words[k] for k in (a + i).tolist()]
                    right += [trie.words[k] for k in j.tolist()]
                    left_n += n[a + i].tolist()
                    right_n += trie.n[j].tolist()
            if left:
                yield pa.record_batch({
                    "word": pa.array(left + right, pa.string()), "near": pa.array(right + left, pa.string()),
                    "near_n": pa.array(right_n + left_n, pa.int64()),
                })

    return sorted_rows.mapInArrow(run, "word string, near string, near_n bigint")


def variants(words: DataFrame, times: int = 2, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of (word, n), words different.

    A word's form is the near word of largest n, of equal ones the smallest in code-point order,
    if its n is at least ``times`` the word's. The root is where forms lead; n at least doubles
    with each step, so a path has few steps, and each round halves those left.
    """
    with scratch(words.sparkSession) as keep:
        given = materialise(words, "words")
        best = near_words(given, cell_words).groupBy("word").agg(
            F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("best")
        )
        far = -F.col("best.m") >= F.col("n") * times
        formed = given.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(far, F.col("best.w")).alias("form"), F.when(far, -F.col("best.m")).alias("form_n"),
        )
        formed = materialise(formed, "forms")
        paths = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
        while True:
            above = paths.select(F.col("word").alias("root"), F.col("root").alias("_above"))
            step = paths.join(above, "root", "left").select(
                "word", F.coalesce("_above", "root").alias("root"), F.col("_above").isNotNull().alias("_moved")
            )
            step = materialise(step, "roots")
            paths = step.select("word", "root")
            if step.where("_moved").isEmpty():
                break
        found = formed.join(paths, "word", "left").withColumn("root", F.coalesce("root", "word"))
        return keep(materialise(found, "variants"))
