"""Substring dedup: Rabin-Karp hashes of every fixed-length word window.

1. Tasks hash every window of their documents. Within a block of documents equal windows are
   combined: only the least document of each goes on, for the others the answer is known.
   So a window that very many documents hold is sent once per block, not once per document.
2. Entries (hash, document) travel packed by bucket, eight bytes a hash. A bucket is a slice of
   the space of a second hash, so equal windows always meet and the two hashes count together.
   The bucket finds the least document of each hash and tells the others.
3. Documents are joined with their repeated hashes; the windows with these merge into maximal
   intervals, whose words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.llm.common import grouped, texts_of, words

MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  #: odd, one per hash
BLOCK_BYTES = 4 << 20  #: text that a task combines at a time
NO_ID = np.iinfo(np.int64).max  #: a null id, behind all others

PACKED = "bucket int, known boolean, hashes binary, ids binary"
REPEATS = "_repeat_id bigint, _hash bigint"


def word_hashes(text_words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, text_words), dtype=np.uint64, count=len(text_words))


def _powers(multiplier: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """multiplier**i and multiplier**-i modulo 2**64."""
    inverse = pow(multiplier, -1, 1 << 64)
    out = []
    for base in (multiplier, inverse):
        steps = np.full(count, base, dtype=np.uint64)
        steps[:1] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _stirred(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of the high bits over all."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def window_hashes(hashes: np.ndarray, length: int, multiplier: int) -> np.ndarray:
    """Hash of every run of ``length`` words: differences of one running sum of w[i] * m**i, each
    brought back to its start by m**-i. A negative result count means no window."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(multiplier, len(hashes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
    return _stirred((sums[length:] - sums[:-length]) * down[:count])


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte: sorted ids then hardly cost anything after compression."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).reshape(-1).view("<i8")


def block_entries(ids: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(hash, bucket hash, id, known): the least document of each window of the block, and with
    ``known`` one entry for each further document that holds it."""
    hashes, counts = [], []
    for text in texts:
        w = words(text)
        hashes.append(word_hashes(w) if len(w) >= length else np.zeros(0, np.uint64))
        counts.append(max(0, len(w) - length + 1))
    if not sum(counts):
        empty = np.zeros(0, np.uint64)
        return empty, empty, np.zeros(0, np.int64), np.zeros(0, bool)
    held = [h for h in hashes if len(h)]
    joined = np.concatenate(held)
    # Windows over the joined words; those that run across a border are left out.
    starts = np.cumsum([0, *(len(h) for h in held[:-1])])
    inner = np.ones(len(joined) - length + 1, dtype=bool)
    for back in range(1, length):
        cross = starts[1:] - back
        inner[cross[cross < len(inner)]] = False
    owner = np.repeat(ids, counts)
    first, second = (window_hashes(joined, length, m)[inner] for m in MULTIPLIERS)
    order = np.lexsort((owner, first))
    first, second, owner = first[order], second[order], owner[order]
    new = np.ones(len(first), dtype=bool)
    new[1:] = first[1:] != first[:-1]
    other = np.ones(len(first), dtype=bool)
    other[1:] = new[1:] | (owner[1:] != owner[:-1])  # each document once
    least = owner[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    keep = other & (new | (owner > least))
    return first[keep], second[keep], owner[keep], ~new[keep]


def _pack(buckets: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in grouped(batches, "_text", BLOCK_BYTES):
            given = np.asarray(block["_id"].fill_null(NO_ID), dtype=np.int64)
            texts = texts_of(block["_text"].combine_chunks())
            hashes, spread, ids, known = block_entries(given, texts, length)
            # What is known needs no counting; it is dealt by document, so no window is hot.
            mixed = _stirred(ids.view(np.uint64))
            bucket = (np.where(known, mixed, spread) % np.uint64(buckets)).astype(np.int32)
            order = np.lexsort((ids, known, bucket))
            hashes, ids, known, bucket = hashes[order], ids[order], known[order], bucket[order]
            if not len(bucket):
                continue
            cuts = np.flatnonzero((np.diff(bucket) != 0) | (known[1:] != known[:-1])) + 1
            edges = [0, *cuts, len(bucket)]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(bucket[edges[:-1]], pa.int32()),
                    "known": pa.array(known[edges[:-1]], pa.bool_()),
                    "hashes": pa.array([hashes[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                    "ids": pa.array([_planes(ids[a:b]) for a, b in zip(edges, edges[1:])], pa.binary()),
                }
            )

    return run


def _meet(packed: pa.Table) -> pa.Table:
    """Of a bucket's entries those whose hash a smaller document holds."""
    hashes, ids, known = [], [], []
    for flag, h, d in zip(packed["known"].to_pylist(), packed["hashes"].to_pylist(), packed["ids"].to_pylist()):
        hashes.append(np.frombuffer(h, "<u8"))
        ids.append(_from_planes(d))
        known.append(np.full(len(ids[-1]), flag))
    hashes, ids, known = np.concatenate(hashes), np.concatenate(ids), np.concatenate(known)
    out_h, out_d = [hashes[known]], [ids[known]]
    hashes, ids = hashes[~known], ids[~known]
    order = np.lexsort((ids, hashes))
    hashes, ids = hashes[order], ids[order]
    if len(hashes):
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = hashes[1:] != hashes[:-1]
        least = ids[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        again = ids > least
        out_h.append(hashes[again])
        out_d.append(ids[again])
    return pa.table({"_repeat_id": np.concatenate(out_d), "_hash": np.concatenate(out_h).view(np.int64)})


def repeated_windows(docs: DataFrame, doc_id: str, text: str, length: int, buckets: int | None = None) -> DataFrame:
    """(_repeat_id, _hash): windows of a document that also start in a document with a smaller id.

    A null id (here the largest long) is larger than any other. ``buckets`` should grow with the
    input as the number of shuffle partitions does; four for each of these if not given.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text"))
    packed = given.mapInArrow(_pack(buckets, length), PACKED)
    return packed.groupBy("bucket").applyInArrow(_meet, REPEATS)


def covered(count: int, hits: np.ndarray, length: int) -> np.ndarray:
    """Which of ``count`` words lie in a window that starts at a hit: maximal intervals from overlaps."""
    edge = np.zeros(count + 1, dtype=np.int64)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + length, -1)
    return np.cumsum(edge[:-1]) > 0


def intervals(gone: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs [start, end) of words that go."""
    step = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(step[::2], step[1::2])]


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 50, buckets: int | None = None
) -> DataFrame:
    """Remove each word covered by a window of ``length`` words that also starts in a smaller document.

    Returns (doc_id, n_words, n_removed, kept_sha256, text): the kept words joined by one blank,
    and their digest. One row per row of ``docs``. Rows that share an id are one document: what
    they repeat of each other stays. Null and empty texts have no words; texts shorter than a
    window lose nothing. A null id counts as larger than any other. Other columns don't matter.
    """
    lost = (
        repeated_windows(docs, doc_id, text, length, buckets)
        .groupBy("_repeat_id")
        .agg(F.collect_list("_hash").alias("_lost"))
    )

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = zstandard.ZstdCompressor(level=3)
        for block in grouped(batches, "_text", BLOCK_BYTES):
            small = [encoder.compress(t) for t in texts_of(block["_text"].combine_chunks())]
            yield from pa.table({"_id": block["_id"].combine_chunks(), "_small": pa.array(small, pa.binary())}).to_batches()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = zstandard.ZstdDecompressor()
        for block in grouped(batches, "_small", BLOCK_BYTES // 4):
            out = {"doc_id": block["_id"].combine_chunks(), "n_words": [], "n_removed": [], "kept_sha256": [], "text": []}
            for small, lost_hashes in zip(block["_small"].to_pylist(), block["_lost"].combine_chunks()):
                w = words(decoder.decompress(small))
                count = len(w)
                if lost_hashes.is_valid:
                    own = window_hashes(word_hashes(w), length, MULTIPLIERS[0])
                    wanted = np.asarray(lost_hashes.values, dtype=np.int64).view(np.uint64)
                    gone = covered(count, np.flatnonzero(np.isin(own, wanted)), length)
                    w = [x for x, g in zip(w, gone.tolist()) if not g]
                kept = b" ".join(w)
                out["n_words"].append(count)
                out["n_removed"].append(count - len(w))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["text"].append(kept)
            out["n_words"], out["n_removed"] = pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64())
            out["kept_sha256"] = pa.array(out["kept_sha256"], pa.string())
            out["text"] = pa.array(out["text"], pa.binary()).cast(pa.string())
            yield from pa.table(out).to_batches()

    # Texts cross the network compressed: the words follow from the same column in either pass.
    squeezed = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text")).mapInArrow(
        squeeze, "_id bigint, _small binary"
    )
    met = squeezed.join(lost, F.coalesce("_id", F.lit(int(NO_ID))) == F.col("_repeat_id"), "left")
    return met.select("_id", "_small", "_lost").mapInArrow(
        cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, text string"
    )
