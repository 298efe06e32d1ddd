"""Benchmark decontamination by pigeonhole edit matching.

A test item within ``k`` edits of a passage shares at least one of its ``k + 1`` pieces with it
unchanged. The pieces' first characters are hashed once; each document is hashed at every
position, all at once, and looked up in that table. Where a piece stands in full, Myers'
bit-parallel distance decides on the passage around it.

Texts are compared in lower case with every run of other characters than letters and digits as
one blank. The items are a stated set that is met with every document: they travel to the tasks
in blocks of at most ``MAX_ITEM_CHARS`` characters.
"""

from __future__ import annotations

import re
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.llm.common import fresh, grouped, texts_of

EDIT_RATE = 0.05  #: edits per character of an item
GRAMS = (16, 8)  #: hashed characters of a piece; the shorter is for items that have no longer piece
MAX_ITEM_CHARS = 8 << 20  #: of a block of items
MAX_ALL_CHARS = 64 << 20  #: of all items; more raise an error
BLOCK_BYTES = 256 << 10  #: of texts hashed at once, which takes about 50 times as much memory
TABLE_BITS = 22

_OTHER = re.compile(r"[\W_]+")


def normalised(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def pieces(item: str, rate: float) -> tuple[int, list[tuple[int, str]]]:
    """(error budget, pieces as (offset, text)); pieces are at least 16 characters, or the whole item."""
    budget = max(0, min(int(rate * len(item)), len(item) // GRAMS[0] - 1))
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return budget, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def distance(pattern: dict[str, int], size: int, text: str) -> int:
    """Least edit distance of a pattern to any part of ``text``; ``pattern`` has each character's places as bits."""
    mask, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best = mask, 0, size, size
    for c in text:
        same = pattern.get(c, 0)
        cross = same | down
        flat = (((same & up) + up) ^ up) | same
        more = down | ~(flat | up) & mask
        less = up & flat
        if more & top:
            score += 1
        elif less & top:
            score -= 1
            if score < best:
                best = score
        more, less = more << 1 & mask, less << 1 & mask
        up = less | ~(cross | more) & mask
        down = more & cross
    return best


def places(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` (a power of two) characters, doubling the length each round."""
    h, length, factor = codes.astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while length < size:
        if len(h) <= length:
            return np.zeros(0, np.uint64)
        h = h[:-length] * np.uint64(factor) + h[length:]
        h ^= h >> np.uint64(31)
        length *= 2
        factor = (factor * 0xD6E8FEB86659FD93 + 2) % (1 << 64)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


class Items(NamedTuple):
    """A block of items: their texts, ids and budgets, and per gram length the sorted hashes of
    their pieces with (item, offset, piece) beside them."""

    texts: list[str]
    ids: list[list[int]]
    budgets: list[int]
    grams: dict[int, tuple[np.ndarray, list[tuple[int, int, str]], np.ndarray]]


def prepare(rows: list[tuple[int, str]], rate: float = EDIT_RATE) -> list[Items]:
    """Items in blocks. Null and short items (under eight characters once normalised) can't be told
    from ordinary words: they match nothing. Equal items are one with several ids."""
    by_text: dict[str, list[int]] = {}
    for key, text in rows:
        if key is not None and text is not None and len(clean := normalised(text)) >= GRAMS[-1]:
            by_text.setdefault(clean, []).append(key)
    blocks, held, size = [], [], 0
    for text in sorted(by_text):
        if held and size + len(text) > MAX_ITEM_CHARS:
            blocks.append(held)
            held, size = [], 0
        held.append(text)
        size += len(text)
    return [_block(texts, by_text, rate) for texts in [*blocks, *([held] if held else [])]]


def _block(texts: list[str], by_text: dict[str, list[int]], rate: float) -> Items:
    budgets, entries = [], {g: [] for g in GRAMS}
    for number, text in enumerate(texts):
        budget, parts = pieces(text, rate)
        budgets.append(budget)
        for offset, piece in parts:
            gram = GRAMS[0] if len(piece) >= GRAMS[0] else GRAMS[1]
            entries[gram].append((int(gram_hashes(codes_of(piece[:gram]), gram)[0]), number, offset, piece))
    grams = {}
    for gram, found in entries.items():
        found.sort()
        hashes = np.array([e[0] for e in found], np.uint64)
        flags = np.zeros(1 << TABLE_BITS, bool)
        flags[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        if found:
            grams[gram] = (hashes, [e[1:] for e in found], np.packbits(flags))
    return Items(texts, [sorted(by_text[t]) for t in texts], budgets, grams)


def search(texts: list[str], items: Items, flags: dict[int, np.ndarray], patterns: dict[int, dict]) -> list[list[tuple[int, int]]]:
    """For each normalised text the (item number, distance) of the items found in it."""
    joined = "\n".join(texts)
    codes = codes_of(joined)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    wanted: dict[tuple[int, int], list[int]] = {}
    for gram, (hashes, entries, _) in items.grams.items():
        h = gram_hashes(codes, gram)
        at = np.flatnonzero(flags[gram][(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        low = np.searchsorted(hashes, h[at], "left")
        high = np.searchsorted(hashes, h[at], "right")
        for k in np.flatnonzero(high > low):
            place = int(at[k])
            owner = int(np.searchsorted(starts, place, "right")) - 1
            for number, offset, piece in entries[low[k] : high[k]]:
                if joined.startswith(piece, place):
                    wanted.setdefault((owner, number), []).append(place - int(starts[owner]) - offset)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for (owner, number), begins in sorted(wanted.items()):
        size, budget, body = len(items.texts[number]), items.budgets[number], texts[owner]
        if number not in patterns:
            patterns[number] = places(items.texts[number])
        best = budget + 1
        for a, b in spans(begins, size, budget):
            best = min(best, distance(patterns[number], size, body[max(0, a) : b]))
        if best <= budget:
            out[owner].append((number, best))
    return out


def spans(begins: list[int], size: int, budget: int) -> list[tuple[int, int]]:
    """Windows around the places where an item may start, overlapping ones as one."""
    out: list[list[int]] = []
    for begin in sorted(set(begins)):
        a, b = begin - budget, begin + size + budget
        if out and a <= out[-1][1] - size:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find_leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE,
) -> DataFrame:
    """``docs`` with ``_items`` (sorted ids of the items found) and ``_distances`` (the edits of each).

    Every row of ``docs`` stays, columns unchanged; where one has a result's name, the result's gets
    underscores in front until it is free. Null and empty texts hold no item. Without
    items nothing is found. An item is found if a part of the text is within ``rate`` edits per
    character of it, at most one edit less than it has whole pieces of 16 characters.
    """
    stated = items.select(F.col(item_id).cast("bigint"), F.col(item_text).cast("string").alias("_item"))
    size = stated.agg(F.sum(F.char_length("_item"))).first()[0] or 0
    if size > MAX_ALL_CHARS:
        raise ValueError(f"{size} characters of items; search them in parts of at most {MAX_ALL_CHARS}")
    blocks = prepare([tuple(r) for r in stated.collect()], rate)
    spark = docs.sparkSession
    hits = F.array().cast("array<struct<item:bigint,edits:int>>")
    for block in blocks:
        look = _searcher(spark.sparkContext.broadcast(block), uuid.uuid4().hex)
        hits = F.concat(hits, look(F.col(text).cast("string")))
    names = [fresh(name, docs) for name in ("_found", "_items", "_distances")]
    found = docs.withColumn(names[0], F.array_sort(hits))
    return found.select(
        *docs.columns, F.col(names[0]).getField("item").alias(names[1]), F.col(names[0]).getField("edits").alias(names[2])
    )


_opened: dict[str, tuple] = {}


def _searcher(block, key: str):
    """A function from texts to the items of one block found in them."""

    @F.arrow_udf("array<struct<item:bigint,edits:int>>")
    def look(column: pa.Array) -> pa.Array:
        items: Items = block.value
        if key not in _opened:
            _opened[key] = ({g: np.unpackbits(f).astype(bool) for g, (_, _, f) in items.grams.items()}, {})
        flags, patterns = _opened[key]
        out = []
        batch = pa.RecordBatch.from_arrays([column], ["_text"])
        for part in grouped(iter([batch]), "_text", BLOCK_BYTES):
            clean = [normalised(t.decode()) for t in texts_of(part["_text"].combine_chunks())]
            for found in search(clean, items, flags, patterns):
                out.append([{"item": i, "edits": d} for n, d in found for i in items.ids[n]])
        return pa.array(out, pa.list_(pa.struct([("item", pa.int64()), ("edits", pa.int32())])))

    return look
