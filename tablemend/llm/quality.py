"""A quality classifier by Bradley-Terry ranking.

A good document should beat a poor one: the chance that it does is the logistic function of the difference of their
scores, and a score is linear in the features of the whole text. The weights are fitted by logistic loss on the feature
differences of random (good, poor) pairs. The threshold is the quantile of the scores of all labelled documents at the
share of poor ones; scores are then stretched to 0..1 so that it lies at ``CUT``.

Features are shapes of the text (lengths, repetition, symbols, case), never its key, source, language or labels. The
weights are fitted on at most ``max_labelled`` labelled documents, picked by a hash of their key.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, replace
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import bounded_sample, in_batches, remainder, ship, stored, texts_of

ship(__name__)

CUT = 0.3
MAX_LABELLED = 8000
PAIRS = 40_000
RIDGE = 1e-3
#: The rank of the threshold is exact up to one in so many rows.
ACCURACY = 1_000_000
#: Standard scores beyond this are as odd as can be.
CLIP = 5.0

SYMBOLS = "%&*$#@=<>{}[]~^_\\/+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"


def features(text: str) -> list[float]:
    """The shape of a text as numbers. All are defined for an empty one."""
    words, lines = text.split(), text.split("\n")
    size, n_words = max(1, len(text)), max(1, len(words))
    counts = Counter(words)
    return [
        math.log(size),
        size / n_words,
        math.log(1 + max(map(len, counts), default=0)),
        len(counts) / n_words,
        max(counts.values(), default=0) / n_words,
        sum(a == b for a, b in pairwise(words)) / n_words,
        len(set(lines)) / len(lines),
        math.log(size / len(lines)),
        _share(text, CAPITALS),
        _share(text, DIGITS),
        _share(text, SYMBOLS),
        text.count("|") / size,
        text.count("!") / size,
        text.count(".") / size,
        text.count(",") / size,
    ]


def _share(text: str, letters: str) -> float:
    return sum(map(text.count, letters)) / max(1, len(text))


@dataclass(frozen=True)
class Ranking:
    """Mean, spread and weights by feature; the threshold on the raw score and the slope of the final one."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return expanded(x, self.mean, self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * (self.raw(x) - self.threshold) + math.log(CUT / (1 - CUT)))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def expanded(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Standard scores and their squares, as a good value may lie in the middle."""
    z = np.clip((x - mean) / spread, -CLIP, CLIP)
    return np.hstack([z, z * z])


def fit(x: np.ndarray, good: np.ndarray, seed: int = 7) -> Ranking:
    """Weights from preference pairs. Without documents of both sorts, every score is one half."""
    width = x.shape[1]
    if not good.any() or good.all():
        return Ranking(np.zeros(width), np.ones(width), np.zeros(2 * width), -1.0, math.log((1 - CUT) / CUT))
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z, rng = expanded(x, mean, spread), np.random.default_rng(seed)
    d = z[rng.choice(np.flatnonzero(good), PAIRS)] - z[rng.choice(np.flatnonzero(~good), PAIRS)]
    w = np.zeros(d.shape[1])
    for _ in range(25):
        p = _logistic(-(d @ w))
        step = np.linalg.solve((d.T * (p * (1 - p))) @ d / PAIRS + RIDGE * np.eye(len(w)), d.T @ p / PAIRS - RIDGE * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    raw = np.sort(z @ w)
    n_poor = int((~good).sum())
    threshold = float((raw[n_poor - 1] + raw[n_poor]) / 2)
    return Ranking(mean, spread, w, threshold, _slope(z @ w - threshold, good))


def _slope(margin: np.ndarray, good: np.ndarray) -> float:
    """The slope with the least logistic loss among a fixed ladder of slopes."""
    offset, sign = math.log(CUT / (1 - CUT)), np.where(good, 1.0, -1.0)
    ladder = 2.0 ** np.arange(-4, 5)
    return float(min(ladder, key=lambda a: np.logaddexp(0, -sign * (a * margin + offset)).mean()))


def train(
    documents: DataFrame, labels: DataFrame, learn_from: Column | None = None, max_labelled: int = MAX_LABELLED
) -> Ranking:
    """Fit a ranking on labelled documents, ``quality`` 1 being the better.

    ``learn_from`` says which rows of ``labels`` may be learnt from. Documents whose labels disagree or are null are
    left out. The sample is joined by broadcast; ``max_labelled`` bounds it. The threshold covers all labelled documents.
    """
    usable = labels.where(F.col("doc_id").isNotNull())
    if learn_from is not None:
        usable = usable.where(learn_from)
    agreed = (
        usable.groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high")
        .select("doc_id", F.col("low").alias("quality"))
    )
    sample = F.broadcast(bounded_sample(agreed, "doc_id", max_labelled))
    texts = texts_of(documents).join(sample, "doc_id").select("text", "quality")
    rows = in_batches(
        texts,
        lambda batch: {"x": [features(t.as_py()) for t in batch.column(0)], "good": batch.column(1).cast("int32")},
        "x array<double>, good int",
    ).toPandas()
    if rows.empty:
        return fit(np.zeros((0, len(features("")))), np.zeros(0, bool))
    order = np.lexsort(np.vstack(rows["x"]).T)
    x, good = np.vstack(rows["x"])[order], (rows["good"].to_numpy() == 1)[order]
    ranking = fit(x, good)
    if good.all() or not good.any() or agreed.count() <= max_labelled:
        return ranking
    threshold = _threshold(ranking, documents, agreed)
    return replace(ranking, threshold=threshold, slope=_slope(ranking.raw(x) - threshold, good))


def _threshold(ranking: Ranking, documents: DataFrame, agreed: DataFrame) -> float:
    """The quantile of the raw scores of all labelled documents at the share of poor ones. Texts are not shuffled."""
    frame = texts_of(documents).where(F.col("doc_id").isNotNull())

    def run(batch):
        x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(batch.num_rows, -1)
        return {"doc_id": batch.column(0), "raw": ranking.raw(x)}

    kind = frame.schema["doc_id"].dataType.simpleString()
    scored = stored(in_batches(frame, run, f"doc_id {kind}, raw double").join(agreed, "doc_id").select("raw", "quality"))
    poor = F.count_if(F.coalesce(F.col("quality") != 1, F.lit(True)))
    rows, n_poor = scored.agg(F.count("*"), poor).first()
    shares = [(n_poor - 0.5) / rows, (n_poor + 0.5) / rows]
    return float(np.mean(scored.agg(F.percentile_approx("raw", shares, ACCURACY)).first()[0]))


def score(documents: DataFrame, ranking: Ranking, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score, predicted)`` of every row; null and empty texts are scored as empty ones.

    Repeated rows and null keys give a row each; other columns take no part.
    """
    frame = texts_of(documents, key, text).toDF("key", "text")

    def run(batch):
        scores = ranking.score(np.array([features(t.as_py()) for t in batch.column(1)]).reshape(batch.num_rows, -1))
        return {"key": batch.column(0), "score": scores, "predicted": (scores >= CUT).astype(np.int32)}

    kind = frame.schema["key"].dataType.simpleString()
    return in_batches(frame, run, f"key {kind}, score double, predicted int").withColumnRenamed("key", key)


def keep_good(documents: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """The rows that the ranking does not reject, with all their columns."""
    schema = documents.schema
    at = documents.columns.index(text)

    def run(batch):
        rows = [features(t.as_py() or "") for t in batch.column(at)]
        kept = batch.filter(pa.array(ranking.score(np.array(rows).reshape(batch.num_rows, -1)) >= CUT))
        return dict(zip(schema.names, kept.columns))

    return in_batches(documents, run, schema)


def score_held_out(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``; a fifth of the documents, by crc32 of the key, is never learnt from."""
    ranking = train(documents, labels, remainder("doc_id", 5) != 0, max_labelled)
    scored = score(documents, ranking)
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
