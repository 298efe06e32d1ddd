"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. What speaks for either is a line's own shape and that of its
neighbours; neighbouring labels are tied by transition weights. Forward and backward passes
give each line's probability of being good, and a text's score is their mean weighted by line
length, brought to the scale of the labels by a logistic curve.

Training lines take the label of their document. Only a bounded sample of labelled documents is
used; its features are computed in the tasks, the fit runs on the driver over that sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelens.llm.common import grouped, texts_of

TRAIN_DOCS = 2000  #: labelled documents that the field is fitted to at most
TRAIN_LINES = 100  #: leading lines of each that it is fitted to; scoring takes all lines
STEPS = 120
PENALTY = 1e-3
MOST_TIE = 2.0  #: bound of a transition weight, so that a line's own features keep their say
THRESHOLD = 0.7
BLOCK_BYTES = 4 << 20

OWN = (
    "length words word_length distinct symbols bars upper digits marks repeats stops commas other blank long_word pairs".split()
)
SYMBOLS = b"#*$%&<>"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))


def own_features(line: bytes, seen: set[bytes]) -> list[float]:
    """Shape of one line; ``seen`` holds the text's earlier lines."""
    w = line.split()
    if not w:
        return [0.0] * 13 + [1.0, 0.0, 0.0]
    size, count = len(line), len(w)
    letters = size - count + 1
    again = line in seen
    seen.add(line)
    plain = len(line.translate(None, _UPPER))
    pairs = len(set(zip(w, w[1:]))) / (count - 1) if count > 1 else 1.0
    return [
        min(np.log1p(size), 12.0),
        min(np.log1p(count), 10.0),
        min(letters / count, 30.0),
        len(set(w)) / count,
        (size - len(line.translate(None, SYMBOLS))) / count,
        line.count(b"|") / count,
        (size - plain) / letters,
        (size - len(line.translate(None, _DIGITS))) / letters,
        (line.count(b"!") + line.count(b"?")) / count,
        float(again),
        line.count(b".") / count,
        line.count(b",") / count,
        sum(map(line.count, (b"http", b"@", b"{", b"=", b"/"))) / count,
        0.0,
        min(max(map(len, w)), 60) / 60,
        pairs,
    ]


def line_features(text: bytes, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights): own shape, that of the lines before and after, place in the text."""
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    own = np.array([own_features(line, seen) for line in (lines[:most] if most else lines)], dtype=np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    edge = np.zeros((len(own), 2), dtype=np.float32)
    edge[0, 0] = edge[-1, 1] = 1
    weights = np.array([len(line.decode(errors="ignore")) for line in lines[: len(own)]], dtype=np.float64)
    return np.hstack([own, before, after, edge]), weights


class Field(NamedTuple):
    """A fitted field: scaling, line weights, transition weights, and the curve of the score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of good against bad; the last is the bias
    ties: np.ndarray  # 2 x 2, from the line above (bad, good) to this one
    slope: float
    shift: float
    constant: float | None = None


def _log_sum(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=-1)
    return top + np.log(np.exp(a - top[..., None]).sum(axis=-1))


class Chains:
    """Texts as rows of a table of lines, the longest first, so that step t of all texts is one slice."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.starts = (np.cumsum(lengths) - lengths)[self.order]
        longest = int(self.lengths[0]) if len(lengths) else 0
        self.alive = np.searchsorted(-self.lengths, -np.arange(longest), side="left")

    def at(self, t: int) -> np.ndarray:
        """Line number t of the texts that have one."""
        return self.starts[: self.alive[t]] + t

    def passes(self, unary: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward log messages of each line and the log sum over labels of each text."""
        ahead, back = np.zeros((len(unary), 2)), np.zeros((len(unary), 2))
        for t in range(len(self.alive)):
            here = self.at(t)
            ahead[here] = unary[here]
            if t:
                ahead[here] += _log_sum(ahead[here - 1][:, None, :] + ties.T[None])
        for t in range(len(self.alive) - 2, -1, -1):
            here = self.at(t)[: self.alive[t + 1]]
            back[here] = _log_sum((unary[here + 1] + back[here + 1])[:, None, :] + ties[None])
        total = np.zeros(len(self.lengths))
        total[self.order] = _log_sum(ahead[self.starts + self.lengths - 1])
        return ahead, back, total


def marginals(features: np.ndarray, lengths: np.ndarray, field: Field) -> np.ndarray:
    """Each line's probability of being good."""
    unary = _unary(_scaled(features, field.mean, field.scale), field.weights)
    ahead, back, _ = Chains(lengths).passes(unary, field.ties)
    both = ahead + back
    return np.exp(both[:, 1] - _log_sum(both))


def _scaled(features: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((features - mean) / scale, -4, 4)


def _unary(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    half = (x @ weights[:-1] + weights[-1]) / 2
    return np.stack([-half, half], axis=1)


def fit(features: np.ndarray, lengths: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Field:
    """Maximise the likelihood of the line labels, then fit the score's curve. ``labels`` per text."""
    width = features.shape[1] if features.ndim == 2 else 0
    if not len(labels) or labels.min() == labels.max():
        prior = float(labels[0]) if len(labels) else 1.0
        return Field(np.zeros(width), np.ones(width), np.zeros(width + 1), np.zeros((2, 2)), 1.0, 0.0, prior)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = _scaled(features, mean, scale).astype(np.float64)
    y = np.repeat(labels.astype(int), lengths)
    # Texts count alike, however many lines they have, and so do the two classes.
    share = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / lengths
    per_line = np.repeat(share, lengths)
    chains = Chains(lengths)
    starts = np.cumsum(lengths) - lengths
    follows = np.ones(len(y), bool)
    follows[starts] = False
    later = np.flatnonzero(follows)
    theta, ties = np.zeros(width + 1), np.zeros((2, 2))
    flat = np.zeros(width + 5)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    told = np.zeros((2, 2))
    np.add.at(told, (y[later - 1], y[later]), per_line[later])
    for step in range(1, STEPS + 1):
        theta, ties = flat[:-4], flat[-4:].reshape(2, 2)
        unary = _unary(x, theta)
        ahead, back, total = chains.passes(unary, ties)
        line_total = np.repeat(total, lengths)
        good = np.exp(ahead[:, 1] + back[:, 1] - line_total)
        gap = (y - good) * per_line
        pair = ahead[later - 1][:, :, None] + ties[None] + (unary[later] + back[later])[:, None, :]
        expected = (np.exp(pair - line_total[later][:, None, None]) * per_line[later][:, None, None]).sum(axis=0)
        grad = np.concatenate([x.T @ gap, [gap.sum()], (told - expected).ravel()]) / len(labels) - PENALTY * flat
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        flat = flat + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        flat[-4:] = np.clip(flat[-4:], -MOST_TIE, MOST_TIE)
    field = Field(mean, scale, flat[:-1 - 3].copy(), flat[-4:].reshape(2, 2).copy(), 1.0, 0.0)
    z = _logit(text_means(marginals(features, lengths, field), lengths, weights))
    slope, shift = 1.0, 0.0
    for _ in range(500):
        p = 1 / (1 + np.exp(-(slope * z + shift)))
        slope += 0.1 * (((labels - p) * z).mean() - 1e-3 * slope)
        shift += 0.5 * (labels - p).mean()
    return field._replace(slope=float(slope), shift=float(shift))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def text_means(good: np.ndarray, lengths: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean over each text's lines, weighted by length; plain where all lines are empty."""
    number = np.repeat(np.arange(len(lengths)), lengths)
    total = np.bincount(number, weights, len(lengths))
    plain = np.bincount(number, good, len(lengths)) / lengths
    return np.where(total > 0, np.bincount(number, good * weights, len(lengths)) / np.maximum(total, 1), plain)


def scores(texts: list[bytes], field: Field) -> np.ndarray:
    if field.constant is not None:
        return np.full(len(texts), field.constant)
    found = [line_features(t) for t in texts]
    lengths = np.array([len(w) for _, w in found])
    features, weights = np.concatenate([f for f, _ in found]), np.concatenate([w for _, w in found])
    means = text_means(marginals(features, lengths, field), lengths, weights)
    return 1 / (1 + np.exp(-(field.slope * _logit(means) + field.shift)))


def held_out(doc_id: Column) -> Column:
    """The documents whose labels are never learned from; a null id is not one of them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most: int = TRAIN_DOCS) -> Field:
    """Fit a field to at most ``most`` labelled documents, those with the least hash of their id.

    Labels other than 0 and 1 and held-out ids don't count. Without labels, or with one class
    alone, the field gives every text that class (good, if there is none).
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(F.col(doc_id)) & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).cast("bigint").alias("_lid"))
        .agg(F.min(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_lid"), "_lid")
        .limit(most)
    )
    given = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text"))
    # The chosen rows are at most ``most`` pairs of numbers.
    sample = given.join(F.broadcast(chosen), F.col("_id") == F.col("_lid")).select("_id", "_label", "_text")

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in grouped(batches, "_text", BLOCK_BYTES):
            found = [line_features(t, TRAIN_LINES) for t in texts_of(block["_text"].combine_chunks())]
            yield from pa.table(
                {
                    "_id": block["_id"].combine_chunks(),
                    "_label": block["_label"].combine_chunks(),
                    "_x": pa.array([f.astype("<f4").tobytes() for f, _ in found], pa.binary()),
                    "_w": pa.array([w.tobytes() for _, w in found], pa.binary()),
                }
            ).to_batches()

    rows = sample.mapInArrow(shapes, "_id bigint, _label int, _x binary, _w binary").limit(most).collect()
    rows.sort(key=lambda r: (r._id, bytes(r._x)))
    weights = [np.frombuffer(r._w) for r in rows]
    lengths = np.array([len(w) for w in weights], dtype=np.int64)
    width = 3 * len(OWN) + 2
    features = [np.frombuffer(r._x, "<f4").reshape(-1, width) for r in rows]
    empty = np.zeros((0, width), np.float32)
    return fit(
        np.concatenate([empty, *features]), lengths, np.array([r._label for r in rows], dtype=np.int64),
        np.concatenate([np.zeros(0), *weights]),
    )


def score(docs: DataFrame, field: Field, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1, as ``column``. Null counts as empty.

    The text is scored in place by an Arrow function of that column alone: other columns, and
    what they hold, have no influence and no shuffle takes place.
    """

    @F.pandas_udf("double")
    def rate(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            bodies = ["" if t is None else t for t in series.tolist()]
            out, start = [], 0
            while start < len(bodies):
                end, size = start, 0
                while end < len(bodies) and (end == start or size < BLOCK_BYTES):
                    size += len(bodies[end])
                    end += 1
                out.append(scores([b.encode() for b in bodies[start:end]], field))
                start = end
            yield pd.Series(np.concatenate([np.zeros(0), *out]))

    return docs.withColumn(column, rate(F.col(text).cast("string")))
