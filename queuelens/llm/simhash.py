"""SimHash near-dedup with bit-sliced comparison.

Equal fingerprints are one node from the start. Two fingerprints that differ in at most two
bits agree outside some two of their eight bytes, so for each of the 28 pairs of bytes the
fingerprints are grouped by the other 48 bits: no pair is lost, and a group has at most 2**16
fingerprints, whatever the data. Within a group bit planes stand vertically: one machine word
holds a bit of 64 fingerprints, and a carry-save counter adds the differing planes to all
distances at once, giving up a block once every distance is beyond the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuelens.llm.common import grouped, packed, texts_of, words
from queuelens.llm.components import component_labels
from queuelens.session import materialise

SEED = 42
SHINGLE = 3
RADIUS = 2
BLOCK_BYTES = 2 << 20
SHINGLES_AT_ONCE = 1 << 17
#: The pairs of bytes that may differ, as masks of the 48 bits that must agree.
MASKS = [(1 << 64) - 1 ^ (0xFF << 8 * a) ^ (0xFF << 8 * b) for a, b in combinations(range(8), 2)]
BLOCK = 512  #: fingerprints of a group that are compared at a time


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``size`` words, joined by one blank; of the whole if it is shorter."""
    w = words(text.lower())  # bytes.lower() changes A-Z alone
    if not w:
        return np.zeros(0, np.uint64)
    joined = b" ".join(w)
    count = max(1, len(w) - size + 1)
    if count == 1:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = [0, *(ends[: count - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())), np.uint64, count)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits, lowest first."""
    total = np.zeros(64, np.int64)
    for a in range(0, len(hashes), SHINGLES_AT_ONCE):
        octets = hashes[a : a + SHINGLES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            seen = np.bincount(octets[:, k], minlength=256)
            total[8 * k : 8 * k + 8] += seen @ _BITS
    return total


_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """A bit is 1 if over half of the shingle hashes have it; 0 for a text without words."""
    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return 0
    if len(hashes) < 64:
        set_bits = 2 * ((hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(axis=0) > len(hashes)
    else:
        set_bits = 2 * bit_counts(hashes) > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, size: int = SHINGLE) -> DataFrame:
    """(_id, _fp): fingerprint of each row as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in grouped(batches, "_text", BLOCK_BYTES):
            found = [fingerprint(t, size) for t in texts_of(block["_text"].combine_chunks())]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield from pa.table({"_id": block["_id"].combine_chunks(), "_fp": signed}).to_batches()

    given = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text"))
    return given.mapInArrow(run, "_id bigint, _fp bigint")


def bit_planes(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """A row per bit; each holds that bit of all values, 64 to a word."""
    short = -len(values) % 64
    padded = np.concatenate([values, np.zeros(short, np.uint64)])
    rows = [np.packbits((padded >> np.uint64(b) & np.uint64(1)).astype(bool), bitorder="little").view("<u8") for b in bits]
    return np.array(rows)


def near_pairs(values: np.ndarray, bits: list[int], radius: int = RADIUS) -> Iterator[tuple[int, np.ndarray]]:
    """For each value the places of later values at most ``radius`` (0 to 2) of ``bits`` away.

    Each block of values is compared with those from its own start on. Two planes and an
    overflow form the counter of all distances; it is a carry-save adder on whole rows.
    """
    everything = ~np.uint64(0)
    for a in range(0, len(values), BLOCK):
        rest = values[a:]
        planes = bit_planes(rest, bits)
        for i in range(a, min(a + BLOCK, len(values))):
            ones, twos = np.zeros(planes.shape[1], np.uint64), np.zeros(planes.shape[1], np.uint64)
            over = np.zeros(planes.shape[1], np.uint64)
            for step, (plane, bit) in enumerate(zip(planes, bits)):
                differs = ~plane if int(values[i]) >> bit & 1 else plane
                carry = ones & differs
                ones ^= differs
                over |= twos & carry
                twos ^= carry
                if step % 4 == 3:
                    out = over | (ones & twos) if radius == 2 else over | twos if radius == 1 else over | twos | ones
                    if (out == everything).all():
                        break
            beyond = over | (ones & twos) if radius == 2 else over | twos if radius == 1 else over | twos | ones
            if (beyond == everything).all():
                continue
            close = np.flatnonzero(np.unpackbits((~beyond).view(np.uint8), bitorder="little")[: len(rest)]) + a
            yield i, close[close > i]


def group_links(values: np.ndarray, mask: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect a group: a pair is left out only if the links already given join it."""
    bits = [b for b in range(64) if not mask >> b & 1]
    root = list(range(len(values)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    left, right = [], []
    for i, others in near_pairs(values, bits, radius):
        for j in others.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                left.append(values[i])
                right.append(values[j])
    return np.array(left, np.uint64), np.array(right, np.uint64)


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(_a, _b): links between different fingerprints at most ``radius`` bits apart, enough of them
    to connect all that are connected."""
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2")
    signed = [m - (1 << 64) if m >> 63 else m for m in MASKS]
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("m"), F.col("_fp").bitwiseAND(F.lit(m)).alias("k")) for k, m in enumerate(signed)]))
    dealt = (
        nodes.select("_fp", keys.alias("_g"))
        .select(F.col("_g.m").alias("_m"), F.col("_g.k").alias("_k"), "_fp")
        .repartition("_m", "_k")
        .sortWithinPartitions("_m", "_k", "_fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups lie one after the other; the last one of a batch may go on in the next."""
        held = [np.zeros(0, np.int64)] * 3

        def pairs(m, k, fp):
            new = np.flatnonzero((np.diff(m) != 0) | (np.diff(k) != 0)) + 1
            edges = np.concatenate([[0], new, [len(m)]])
            left, right = [], []
            for at in np.flatnonzero(np.diff(edges) > 1):
                a, b = edges[at], edges[at + 1]
                x, y = group_links(fp[a:b].view(np.uint64), MASKS[m[a]], radius)
                left.append(x)
                right.append(y)
            if left:
                both = [np.concatenate(s).view(np.int64) for s in (left, right)]
                yield from pa.table({"_a": both[0], "_b": both[1]}).to_batches()

        for batch in batches:
            got = [np.asarray(batch.column(n), dtype=np.int64) for n in ("_m", "_k", "_fp")]
            m, k, fp = (np.concatenate(p) for p in zip(held, got))
            if not len(m):
                continue
            last = np.flatnonzero((m != m[-1]) | (k != k[-1]))
            tail = int(last[-1]) + 1 if len(last) else 0
            if tail:
                yield from pairs(m[:tail], k[:tail], fp[:tail])
            held = [m[tail:], k[tail:], fp[tail:]]
        if len(held[0]):
            yield from pairs(*held)

    return dealt.mapInArrow(run, "_a bigint, _b bigint")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """(_id, _fp, _component): each row's fingerprint and the least id that links lead to.

    Null, empty and blank texts have fingerprint 0 and are linked like any other. Rows that
    share an id and differ in text are separate rows of one id. A null id is never the least; a
    component of null ids alone has a null component.
    """
    given = materialise(fingerprints(docs, doc_id, text, size), "fingerprints")
    nodes = materialise(given.groupBy("_fp").agg(F.min("_id").alias("_least")), "fingerprint-nodes")
    labels = component_labels(links(nodes.select("_fp"), radius))
    owner = nodes.join(labels, nodes._fp == labels._node, "left").select(
        "_fp", "_least", F.coalesce("_label", "_fp").alias("_label")
    )
    least = owner.groupBy("_label").agg(F.min("_least").alias("_component"))
    components = owner.join(least, "_label").select("_fp", "_component")
    return given.join(components, "_fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Of each group of near duplicates the row with the least id, its columns unchanged.

    Rows that repeat that id go as well, but for the one with the least text hash; equal rows
    leave one. Rows without an id stay only if their group has no id at all: one of them.
    """
    found = near_duplicates(docs.select(doc_id, text), doc_id, text, size, radius)
    chosen = found.where(F.col("_id").eqNullSafe(F.col("_component"))).select(_place(F.col("_id"))).distinct()
    given = packed(docs, _place=_place(F.col(doc_id)), _tie=F.xxhash64(F.col(text).cast("string")))
    order = Window.partitionBy("_place").orderBy("_tie")
    kept = given.join(chosen, "_place", "left_semi").withColumn("_turn", F.row_number().over(order))
    return kept.where("_turn = 1").select("_given.*")


def _place(doc_id: Column) -> Column:
    """The id, or the largest long for a null."""
    return F.coalesce(doc_id.cast("bigint"), F.lit((1 << 63) - 1)).alias("_place")
