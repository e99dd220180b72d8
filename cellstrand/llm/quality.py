"""Quality: Bradley-Terry ranking of documents by features of their text.

Each text has a vector of features (shape of words, repetition, symbols, case). From pairs of a
preferred and a rejected document, logistic loss on the difference of their features gives the
weights, so that a document's merit is a weighted sum. The cut is the CUT_QUANTILE of the sample's
merits, both labels weighing the same however many rows they have. The score is the logistic of the
merit with the cut at CUT_SCORE.

Defined results: null and empty texts have all features 0 and the score that follows; texts of any
length are read whole; equal texts get equal scores; ids and other columns are no input; without
labels of both classes every score is 0.5.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstrand.llm.common import id_and_text, slices, texts_of
from cellstrand.llm.toxicity import labelled_sample

#: Labelled texts of each class that weights are fitted on, at most, and pairs drawn from them.
SAMPLE_EACH = 2000
PAIRS = 60_000
#: Quantile of the merits at which the cut is, and score of a document that stands there.
CUT_QUANTILE, CUT_SCORE = 0.5, 0.3

CLASS = np.zeros(256, dtype=np.uint8)
CLASS[[ord(c) for c in " \t\n\r\v\f"]] = 1
CLASS[ord("A") : ord("Z") + 1] = 2
CLASS[ord("a") : ord("z") + 1] = 3
CLASS[ord("0") : ord("9") + 1] = 4
CLASS[128:] = 5
CLASS[[ord(c) for c in ".,;:'\"-?()"]] = 6
CLASS[[c for c in range(33, 127) if CLASS[c] == 0]] = 7


def features(text: str) -> list[float]:
    """Shape of a text; every feature lies between 0 and about 3."""
    raw = text.encode("utf-8", "replace")
    words = text.split()
    if not words:
        return [0.0] * 20
    n, size = len(words), max(1, len(raw))
    share = np.bincount(CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=8) / size
    count = Counter(words)
    most = max(count.values())
    distinct = len(count)
    lines = [line for line in text.split("\n") if line.strip()]
    same = sum(map(str.__eq__, words, words[1:]))
    gaps = sum(map(str.__eq__, words, words[2:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lengths = np.fromiter(map(len, words), dtype=np.int32, count=n)
    return [
        1.0,
        np.log10(n) / 2,
        min(3.0, n / 20),
        distinct / n,
        np.log(distinct + 1) / np.log(n + 1),
        most / n,
        pairs / max(1, n - 1),
        same / n,
        gaps / n,
        len(set(lines)) / max(1, len(lines)),
        min(3.0, n / max(1, len(lines)) / 40),
        lengths.mean() / 5,
        lengths.std() / 5,
        min(3.0, lengths.max() / 20),
        share[2] * 3,
        share[4] * 3,
        share[5],
        share[6] * 5,
        share[7] * 5,
        float(share[7] > 0.02) + float(share[2] > 0.3),
    ]


class Model:
    def __init__(self, mean: np.ndarray, spread: np.ndarray, weight: np.ndarray, cut: float, slope: float):
        self.mean, self.spread, self.weight, self.cut, self.slope = mean, spread, weight, cut, slope

    def merits(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return expanded((np.array([features(t) for t in texts]) - self.mean) / self.spread) @ self.weight

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.slope:
            return np.full(len(texts), 0.5)
        logit = (self.merits(texts) - self.cut) * self.slope + np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def expanded(x: np.ndarray) -> np.ndarray:
    """Features, bounded, with their squares, so that merits may have a best place in the middle."""
    x = np.clip(x, -4, 4)
    return np.concatenate([x, x * x / 2], 1)


def train(texts: list[str], good: list[int], pairs: int = PAIRS, steps: int = 300, seed: int = 11) -> Model:
    """Weights by gradient descent on the logistic loss of feature differences of random pairs."""
    base = np.array([features(t) for t in texts]).reshape(len(texts), -1)
    label = np.array(good)
    if len(set(good)) < 2:
        return Model(np.zeros(20), np.ones(20), np.zeros(40), 0.0, 0.0)
    mean, spread = base.mean(0), np.maximum(base.std(0), 1e-3)
    x = expanded((base - mean) / spread)
    rng = np.random.default_rng(seed)
    better, worse = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    difference = x[rng.choice(better, pairs)] - x[rng.choice(worse, pairs)]
    weight, moving = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(steps):
        lost = 1 / (1 + np.exp(np.clip(difference @ weight, -30, 30)))
        moving = 0.9 * moving + (difference * lost[:, None]).mean(0) - 1e-3 * weight
        weight += 0.1 * moving
    merit = x @ weight
    order = np.argsort(merit, kind="stable")
    below = np.cumsum(np.where(label == 1, 0.5 / len(better), 0.5 / len(worse))[order])
    at = int(np.searchsorted(below, CUT_QUANTILE - 1e-9))
    cut = float((merit[order[at]] + merit[order[min(at + 1, len(order) - 1)]]) / 2)
    return Model(mean, spread, weight, cut, 1.0)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, each: int = SAMPLE_EACH) -> Model:
    """A model from labels (doc_id, quality); `allowed` says, in terms of doc_id, which may be learnt."""
    sample = labelled_sample(docs, labels, "quality", F.lit(True) if allowed is None else allowed, each)
    return train([t for t, _ in sample], [y for _, y in sample])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every text, in place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.record_batch([batch.column(0), pa.array(model.scores(texts_of(batch.column(1))), pa.float64())], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double")
