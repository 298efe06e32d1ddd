"""Quality rules by compression: zstandard ratios over whole texts and fixed chunks.

A text that repeats itself compresses far better than prose of its length, noise hardly at all;
what is usual depends on the length, so each class of lengths has limits of its own. Limits hold
for a text's letters, not for its UTF-8: a letter of an alphabet counts as one byte, whatever its
script, and a sign of a large set (Han, Hangul) as two.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.llm.common import BLANKS, grouped, texts_of, words

SYMBOLS = "#*$%&|<>"
BLOCK_BYTES = 4 << 20


class Band(NamedTuple):
    """Limits of compressed / raw bytes for texts, or chunks, of at least ``at_least`` bytes.

    ``dense`` takes the place of ``high`` where signs of large sets prevail.
    """

    at_least: int
    low: float
    high: float
    dense: float


#: Limits with room on either side of what prose gives at level 3; English licences set the low ones.
BANDS = (
    Band(0, 0.0, 99.0, 99.0),
    Band(200, 0.42, 0.92, 99.0),
    Band(500, 0.37, 0.80, 0.98),
    Band(1000, 0.33, 0.72, 0.94),
    Band(2000, 0.30, 0.66, 0.91),
    Band(4000, 0.27, 0.62, 0.88),
    Band(16000, 0.22, 0.58, 0.84),
    Band(64000, 0.20, 0.56, 0.80),
)
#: Chunks of just these sizes, the largest first.
CHUNKS = (Band(4096, 0.27, 0.64, 0.90), Band(1024, 0.30, 0.68, 0.92), Band(256, 0.22, 0.88, 99.0))
CHUNK_SHARE = 0.2  #: of a text's bytes that may lie in chunks beyond the limits
LEVEL = 3

KIND = (
    "_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, ratio double, odd_chunks double, kept boolean"
)


def repeated_words(text_words: list[bytes], length: int = 3) -> int:
    """Words in runs of ``length`` words that occur twice or more, the first one included."""
    count = len(text_words)
    if count <= length:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(text_words))}
    ids = np.fromiter(map(number.__getitem__, text_words), np.int64, count)
    code = ids[: count - length + 1]
    for k in range(1, length):
        following = ids[k : count - length + 1 + k]
        if int(code.max() + 1) * len(number) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * len(number) + following
    _, inverse, times = np.unique(code, return_inverse=True, return_counts=True)
    edge = np.zeros(count + 1, np.int64)
    hits = np.flatnonzero(times[inverse] > 1)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + length, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def letters(body: bytes) -> tuple[bytes, float]:
    """A text's letters at one or two bytes each, and how far signs of large sets prevail, 0 to 1.

    Alphabets lie in blocks of 128 code points or less, so seven bits tell their letters apart.
    """
    if body.isascii():
        return body, 0.0
    code = np.frombuffer(body.decode().encode("utf-32-le"), "<u4")
    large = (code >= 0x2E80) & ~((code >= 0x3040) & (code < 0x3100))  # beyond alphabets, but not kana
    lead = np.where(large, code >> 8 & 0xFF, np.where(code < 0x80, code, code & 0x7F | 0x80))
    size = 1 + large
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    out[at] = lead
    out[at[large] + 1] = code[large] & 0xFF
    return out.tobytes(), min(1.0, 4 * int(large.sum()) / len(out))


def within(ratio: float, band: Band, density: float) -> bool:
    return band.low <= ratio <= band.high + density * (band.dense - band.high)


def chunk_share(body: bytes, density: float = 0.0, chunks=CHUNKS) -> float:
    """Share of the bytes that lie in a chunk, of any of the sizes, with a ratio beyond the limits.

    What is left behind the last whole chunk of a size is rated by the chunk that ends the text.
    """
    squeeze, odd = zstandard.ZstdCompressor(level=LEVEL), np.zeros(len(body), bool)
    for band in chunks:
        size = band.at_least
        for at in range(0, len(body), size) if size <= len(body) else ():
            start = min(at, len(body) - size)
            ratio = len(squeeze.compress(body[start : start + size])) / size
            odd[at : at + size] |= not within(ratio, band, density)
    return float(odd.mean()) if body else 0.0


def measures(body: bytes, bands=BANDS, chunks=CHUNKS, share: float = CHUNK_SHARE) -> tuple:
    """A text's row of ``KIND`` without its id."""
    text, w = body.decode(), words(body)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    repeated = repeated_words(w)
    failed = len(w) < 50 or 100 * repeated > 50 * len(w)
    rated, density = letters(body)
    ratio = len(zstandard.ZstdCompressor(level=LEVEL).compress(rated)) / len(rated) if rated else 0.0
    band = [b for b in bands if len(rated) >= b.at_least][-1]
    odd = chunk_share(rated, density, chunks)
    kept = not failed and within(ratio, band, density) and odd <= share
    chars = len(text) - sum(map(text.count, BLANKS))
    return len(w), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, failed, ratio, odd, kept


def rate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands=BANDS, chunks=CHUNKS, share: float = CHUNK_SHARE) -> DataFrame:
    """A row of measures and the verdict per row of ``docs``; one pass, no shuffle.

    A null text has no words, like an empty one: it fails the base rules. ``ratio`` is
    that of the text's letters, 0 for an empty text. Texts shorter than the least chunk have no chunks.
    """
    names = [c.split()[0] for c in KIND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in grouped(batches, "_text", BLOCK_BYTES):
            rows = [measures(t, bands, chunks, share) for t in texts_of(block["_text"].combine_chunks())]
            columns = dict(zip(names, [block["_id"].combine_chunks(), *map(list, zip(*rows))]))
            yield from pa.table(columns).to_batches()

    given = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text"))
    return given.mapInArrow(run, KIND)
