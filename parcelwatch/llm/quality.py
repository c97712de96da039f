"""Quality scores learned from preferences.

A Bradley-Terry model: the chance that document a is better than b is the logistic function of the difference of
their scores. Scores are linear in features of the text (shares of kinds of characters and words, repetition, the
worst stretch of a text), each also cut into bins at its quantiles. Preference pairs set documents labelled good
against documents labelled bad; the loss on feature differences is minimised by Newton steps. The line between
good and bad is the quantile of scores that the share of bad labels names.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, whole_text

#: Labelled rows that the model learns from, about; chosen by a hash of doc_id. Also pairs per model.
TRAIN_ROWS = 20_000
PAIRS = 30_000
BINS = 10
STRETCH = 24
#: The probability that the line between good and bad stands for.
LINE = 0.3

_UPPER, _LOWER = range(65, 91), range(97, 123)
_KINDS = (
    list(_UPPER), list(_LOWER), list(range(48, 58)), [32], [10], [9, 11, 12, 13], [46], [44], [33, 63], [39, 34], [58, 59], [45, 95],
    [42], [35], [36], [37], [38], [124], [64], [60, 62, 123, 125, 91, 93], [40, 41, 47, 92, 43, 61, 94, 96, 126], list(range(128, 256)),
)
_PLAIN = frozenset(".,;:?'\")»”’…")
N_FEATURES = len(_KINDS) + 20


def features(text: str) -> np.ndarray:
    """Numbers that describe a text; zeros for an empty one."""
    out = np.zeros(N_FEATURES)
    raw = text.encode()
    words = text.split()
    if not words:
        return out
    n = len(words)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    out[: len(_KINDS)] = [counts[k].sum() / len(raw) for k in _KINDS]
    sizes = np.fromiter(map(len, words), np.float64, n)
    again = np.fromiter(map(eq, words, words[1:]), np.float64, n - 1) if n > 1 else np.zeros(1)
    odd = np.fromiter((not (w[-1].isalnum() or w[-1] in _PLAIN) for w in words), np.float64, n)
    caps = np.fromiter((len(w) > 1 and w.isupper() for w in words), np.float64, n)
    bare = np.fromiter((not any(map(str.isalnum, w)) for w in words), np.float64, n)
    lines = text.split("\n")
    kinds = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False))) if n > 1 else 1

    def worst(x: np.ndarray) -> float:
        if len(x) <= STRETCH:
            return float(x.mean())
        c = np.concatenate([[0.0], np.cumsum(x)])
        return float((c[STRETCH:] - c[:-STRETCH]).max() / STRETCH)

    wide = worst(sizes)
    out[len(_KINDS) :] = [
        np.log1p(n), sizes.mean(), sizes.std(), np.log(sizes.max()), kinds / n, np.log1p(n) - np.log1p(kinds), pairs / max(n - 1, 1),
        again.mean(), worst(again), odd.mean(), worst(odd), caps.mean(), worst(caps), bare.mean(), worst(bare),
        (sizes <= 3).mean(), len(set(lines)) / len(lines), np.log1p(n / len(lines)), wide, np.log1p(len(lines)),
    ]
    return out


class Ranking:
    """Scores by weights over standardised features and their quantile bins."""

    def __init__(self, sample: np.ndarray):
        self.mean, self.scale = sample.mean(0), np.maximum(sample.std(0), 1e-9)
        self.cuts = np.quantile(sample, np.linspace(0, 1, BINS + 1)[1:-1], axis=0)
        self.weights = np.zeros(sample.shape[1] * BINS)
        self.line = 0.0

    def expand(self, x: np.ndarray) -> np.ndarray:
        steps = (x[:, None, :] > self.cuts[None]).reshape(len(x), -1)  # one per cut
        return np.concatenate([((x - self.mean) / self.scale).clip(-5, 5), steps], 1).astype(np.float32)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; ``LINE`` where the line between good and bad is."""
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.line + np.log(LINE / (1 - LINE)), -30, 30)))


def rank(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = 3.0, steps: int = 12, seed: int = 7) -> Ranking:
    """Learn from rows ``x`` of which ``good`` are preferred to the others. With one kind only, all weights stay zero."""
    model = Ranking(x)
    if good.all() or not good.any():
        model.line = 30.0 if not good.any() else -30.0
        return model
    draw = np.random.default_rng(seed)
    better, worse = (draw.choice(np.flatnonzero(k), pairs) for k in (good, ~good))
    rows = model.expand(x)
    d = rows[better] - rows[worse]
    w = model.weights
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        slope = d.T @ (1 - p) - ridge * w
        curve = (d * (p * (1 - p))[:, None].astype(np.float32)).T @ d + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-4:
            break
    model.weights = w
    s = rows @ w
    model.line = float(np.quantile(s, 1 - good.mean()))
    return model


def held_out(docs: DataFrame) -> Column:
    return F.coalesce(F.crc32(docs["doc_id"].cast("bigint").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.tolist() for f in found], pa.list_(pa.float64()))], ["good", "features"])


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Ranking | None:
    """A ranking from the quality labels (of several for a doc_id, the lowest) of documents that are not held out.

    About ``train_rows`` of them, by a hash of doc_id, whose features come to the driver. None without any.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").where("doc_id is not null and quality is not null")
    known = known.where(~held_out(known)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, train_rows / max(known.count(), 1))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    known = F.broadcast(known.select(F.col("doc_id").alias("_id"), (F.col("quality") == 1).alias("good")))  # bounded by train_rows
    rows = docs.join(known, docs["doc_id"].cast("bigint") == known["_id"]).select("good", whole_text(docs).alias("text"))
    got = mapped(rows, _features, "good boolean, features array<double>").toPandas()
    if got.empty:
        return None
    return rank(np.array(got["features"].tolist()), got["good"].to_numpy(bool))


def quality_scores(docs: DataFrame, model: Ranking | None, line: float = LINE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs(doc_id, text, ..)``. Null text counts as empty and is
    scored like any; without a model every score is ``line``."""
    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = np.array([features(t.as_py()) for t in part.column(2)])
                score = model.scores(x) if model else np.full(len(x), line)
                columns = [part.column(0), part.column(1), pa.array(score), pa.array((score >= line).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, [n for n, _ in fields])

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), held_out(docs).alias("held_out"), whole_text(docs).alias("text"))
    return mapped(rows, run, "doc_id bigint, held_out boolean, score double, predicted int")
