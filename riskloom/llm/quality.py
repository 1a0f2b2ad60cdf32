"""Quality classifier: support vectors over n-gram indicators scaled by naive Bayes ratios.

A text's features are the distinct 1- and 2-grams of its words and the 1- to 3-grams of its word shapes
(letters by case, digits, other signs as they are; a repeated word has a shape of its own), hashed into a
fixed number of places. Over all labelled training rows the log-count ratio of each feature is counted; an
indicator's value is that ratio. A linear hinge-loss model is then fitted by dual coordinate descent on at
most `fit_rows` labelled rows of each class, the bound on what one task holds, chosen by a hash of the id.
Its weights are drawn towards their mean size, and a logistic curve fitted to cross-fitted margins, with the
class shares of all labelled rows, turns the margin into a probability.

Scores depend on the text alone. Defined results: a null text counts as empty and has no features, so its
score is that of the curve at margin 0; labels other than 0 and 1 are left out, an id with several labels
takes the largest; without rows of both classes every score is the smoothed share of ones; an empty table
gives an empty result. An input column named like an added one is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import WordTable, byte_slices, free_memory, mixed, raw, staged, text_of, tidied

PLACES = 1 << 18
#: Labelled rows of each class, at most, from which the hinge-loss weights are fitted.
FIT_ROWS = 4000
THRESHOLD = 0.7
#: Up to so many labels (an id and a number each) go to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

_RUNS = re.compile(rb"[a-z\x80-\xff]+|[A-Z]+|[0-9]+")
_REPEATED = np.uint64(0x9AE16A3B2F90404F)


def _shape(word: bytes) -> bytes:
    return _RUNS.sub(lambda m: b"a" if m[0][0] >= 0x61 else b"A" if m[0][0] >= 0x41 else b"9", word)


_words = WordTable(2, lambda w: (xxhash.xxh3_64_intdigest(w.lower()), xxhash.xxh3_64_intdigest(_shape(w), 1)))


def _forget_words() -> None:
    _words.clear()


def features(text: bytes) -> np.ndarray:
    """The distinct places of a text's n-grams, in order."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int32)
    word, shape = _words.of(words).T
    shape = shape.copy()
    shape[1:][word[1:] == word[:-1]] = _REPEATED
    step = np.uint64(0x9E3779B97F4A7C15)
    grams = [word, word[:-1] * step + word[1:], shape, shape[:-1] * step + shape[1:], (shape[:-2] * step + shape[1:-1]) * step + shape[2:]]
    salted = [mixed(g + np.uint64(i + 1)) for i, g in enumerate(grams)]
    return np.unique((np.concatenate(salted) >> np.uint64(20)) % np.uint64(PLACES)).astype(np.int32)


@dataclass
class QualityModel:
    """Weights by place, and the curve from margins to probabilities."""

    weights: np.ndarray
    slope: float
    shift: float

    def score(self, text: bytes) -> float:
        margin = float(self.weights[features(text)].sum())
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def in_fold(id_col: Column, folds: int, remainder: int) -> Column:
    """Whether the checksum of the id as text leaves the remainder; a null id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % folds == remainder


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class by feature, one sum for each task."""
    counts = np.zeros((2, PLACES), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in byte_slices(batches, "text"):
        for text, label in zip(raw(batch.column("text")), batch.column("label").to_pylist(), strict=True):
            counts[label, features(text)] += 1
            rows[label] += 1
    met = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(np.append(met, -1)), pa.array(np.append(counts[0, met], rows[0])), pa.array(np.append(counts[1, met], rows[1]))], ["place", "zeros", "ones"])


def _descend(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = 0.1, passes: int = 12, seed: int = 7) -> np.ndarray:
    """Hinge-loss weights in the scaled space by dual coordinate descent (squared hinge)."""
    w, alpha = np.zeros(len(ratio)), np.zeros(len(rows))
    values = [ratio[f] for f in rows]
    diagonal = np.array([float(v @ v) for v in values]) + 0.5 / cost
    order = np.random.default_rng(seed)
    for _ in range(passes):
        most = 0.0
        for i in order.permutation(len(rows)):
            slope = y[i] * float(w[rows[i]] @ values[i]) - 1 + alpha[i] * 0.5 / cost
            new = max(0.0, alpha[i] - slope / diagonal[i])
            if new != alpha[i]:
                most = max(most, abs(new - alpha[i]) * diagonal[i])
                w[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                alpha[i] = new
        if most < 0.01:  # no row's slope calls for a move any more
            break
    return w


def _blend(w: np.ndarray, ratio: np.ndarray, share: float = 0.5) -> np.ndarray:
    """Weights over plain indicators, part of the way from the mean size to the fitted ones."""
    used = w != 0
    mean = np.abs(w[used]).mean() if used.any() else 0.0
    return ratio * ((1 - share) * mean * used + share * w)


def _curve(margins: np.ndarray, ones: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps towards smoothed targets."""
    n1, n0 = float(weight[ones == 1].sum()), float(weight[ones == 0].sum())
    ones = np.where(ones == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)])
    scale = max(1e-9, float(np.abs(margins).mean()))
    at = np.array([1.0 / scale, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
        slope = x @ (weight * (p - ones)) + np.array([1e-6, 0]) * at
        bend = (x * (weight * p * (1 - p))) @ x.T + np.diag([1e-6, 1e-6])
        move = np.linalg.solve(bend, slope)
        at = at - np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def _fitter(ratio: np.ndarray, shares: tuple[float, float]):
    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["label", "order", "id"], kind="stable").reset_index(drop=True)
        rows = [features(t.encode()) for t in sample["text"]]
        label = sample["label"].to_numpy()
        y = np.where(label == 1, 1.0, -1.0)
        margins = np.zeros(len(rows))
        half = np.arange(len(rows)) % 2
        for side in (0, 1):
            mine, other = np.flatnonzero(half == side), np.flatnonzero(half != side)
            w = _blend(_descend([rows[i] for i in mine], ratio, y[mine]), ratio)
            margins[other] = [w[rows[i]].sum() for i in other]
        weight = np.where(label == 1, shares[1] / max(1, (label == 1).sum()), shares[0] / max(1, (label == 0).sum())) * len(rows)
        slope, shift = _curve(margins, label.astype(float), weight)
        w = _blend(_descend(rows, ratio, y), ratio)
        used = np.flatnonzero(w)
        return pd.DataFrame({"place": np.append(used, [-1, -2]), "weight": np.append(w[used], [slope, shift])})

    def fit_and_free(sample: pd.DataFrame) -> pd.DataFrame:
        try:
            return fit(sample)
        finally:
            _forget_words()
            free_memory()

    return fit_and_free


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> QualityModel:
    """A model from the labelled rows given; leave held-out rows out before."""
    marks = labels.where(F.col(f"`{label_col}`").isin(0, 1)).groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max(F.col(f"`{label_col}`")).cast("int").alias("label"))
    marks = staged(marks, "marks")
    if marks.count() <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")).join(marks, "id")
    rows = staged(rows, "labelled")
    counted = rows.select("text", "label").mapInArrow(tidied(_count, _forget_words), "place long, zeros long, ones long").groupBy("place").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    found = counted.toPandas()  # at most one row for each place
    zeros, ones = np.zeros(PLACES), np.zeros(PLACES)
    real = found[found["place"] >= 0]
    zeros[real["place"]], ones[real["place"]] = real["zeros"], real["ones"]
    total = found[found["place"] < 0]
    n0, n1 = int(total["zeros"].sum()), int(total["ones"].sum())
    if not n0 or not n1:
        share = (n1 + 1) / (n0 + n1 + 2)
        return QualityModel(np.zeros(PLACES), 0.0, float(np.log(share / (1 - share))))
    ratio = np.log((ones + 1) / (ones.sum() + PLACES)) - np.log((zeros + 1) / (zeros.sum() + PLACES))
    chosen = rows.withColumn("order", F.xxhash64("id"))
    sample = chosen.where("label = 0").orderBy("order", "id").limit(fit_rows).unionAll(chosen.where("label = 1").orderBy("order", "id").limit(fit_rows))
    fitted = sample.groupBy().applyInPandas(_fitter(ratio, (n0 / (n0 + n1), n1 / (n0 + n1))), "place long, weight double").toPandas()
    weights = np.zeros(PLACES)
    part = fitted[fitted["place"] >= 0]
    weights[part["place"]] = part["weight"]
    last = fitted.set_index("place")["weight"]
    return QualityModel(weights, float(last[-1]), float(last[-2]))


def with_scores(docs: DataFrame, model: QualityModel, text_col: str = "text", score: str = "score") -> DataFrame:
    """The rows with the probability that a text's label is 1."""

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t.encode()) for t in texts], dtype="float64")

    return docs.withColumn(score, F.pandas_udf(tidied(scored, _forget_words), T.DoubleType())(text_of(text_col)))
