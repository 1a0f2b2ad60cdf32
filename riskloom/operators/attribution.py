"""Exact contributions of features to the output of a sum of trees.

A feature that is not known sends a row down both sides of a split, by the shares of training rows that went
there. Along the path to a leaf every feature is one interval and one such share, so the leaf's part in the
contributions depends only on which of its few intervals hold the row: all answers are worked out
once per leaf, and rows only look them up. Contributions and the base value add up to the output.

The look-up runs over Arrow batches with numpy: as column expressions it would take a pass over all leaves,
some ten thousand, in interpreted array functions for every row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.compiled import Node

#: Leaf look-ups held in memory at a time.
HELD = 2_000_000


def _leaves(node: Node, path: dict[int, tuple[float, float, float]]):
    """(value, {feature: (above, up to, share)}) of each leaf."""
    if node.left is None:
        yield node.value, path
        return
    low, high, share = path.get(node.feature, (-math.inf, math.inf, 1.0))
    whole = node.left.cover + node.right.cover
    parts = (node.left.cover / whole, node.right.cover / whole) if whole else (0.5, 0.5)
    yield from _leaves(node.left, path | {node.feature: (low, min(high, node.upto), share * parts[0])})
    yield from _leaves(node.right, path | {node.feature: (max(low, node.upto), high, share * parts[1])})


def _answers(value: float, shares: Sequence[float]) -> np.ndarray:
    """[mask, feature]: contributions where the intervals in `mask` hold the row."""
    k = len(shares)
    out = np.zeros((1 << k, k))
    for mask in range(1 << k):
        inside = [float(mask >> i & 1) for i in range(k)]
        for j in range(k):
            # coefficients by the number of known features among the others
            by_size = [1.0]
            for i in range(k):
                if i != j:
                    by_size = [a * shares[i] + b * inside[i] for a, b in zip([*by_size, 0.0], [0.0, *by_size], strict=True)]
            weights = [math.factorial(s) * math.factorial(k - s - 1) / math.factorial(k) for s in range(k)]
            out[mask, j] = value * (inside[j] - shares[j]) * sum(w * c for w, c in zip(weights, by_size, strict=True))
    return out


class Attribution:
    """Contributions of `width` features to a weighted sum of trees, times `scale`."""

    def __init__(self, trees: Sequence[tuple[float, Node]], width: int, scale: float = 1.0):
        self.width, self.base = width, 0.0
        groups: dict[int, list] = {}
        for weight, root in trees:
            for value, path in _leaves(root, {}):
                value *= weight * scale
                self.base += value * math.prod(share for _, _, share in path.values())
                if path:
                    groups.setdefault(len(path), []).append((value, path))
        self.groups = []
        for leaves in groups.values():
            features = np.array([list(p) for _, p in leaves])
            low, high = (np.array([[b[side] for b in p.values()] for _, p in leaves]) for side in (0, 1))
            answers = np.array([_answers(v, [b[2] for b in p.values()]) for v, p in leaves])
            self.groups.append((features, low, high, answers))

    def of(self, x: np.ndarray) -> np.ndarray:
        """Contributions of each row of feature values."""
        out = np.zeros((len(x), self.width))
        for features, low, high, answers in self.groups:
            leaves, k = features.shape
            order = np.argsort(features.ravel(), kind="stable")
            names, starts = np.unique(features.ravel()[order], return_index=True)
            for i in range(0, len(x), step := max(1, HELD // features.size)):
                values = x[i : i + step][:, features]
                # a value that is no number goes right, as a large one does
                inside = (~(values <= low) | (low == -math.inf)) & ((values <= high) | (high == math.inf))
                mask = (inside * (1 << np.arange(k))).sum(2)
                parts = answers[np.arange(leaves), mask].reshape(len(values), -1)
                out[i : i + step, names] += np.add.reduceat(parts[:, order], starts, axis=1)
        return out


def contributions(attribution: Attribution, features: Sequence[Column]) -> Column:
    """The contributions of a row's encoded features, as an array."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def look_up(values: pd.DataFrame) -> pd.Series:
        return pd.Series(list(attribution.of(values.to_numpy(np.float64))))

    return look_up(F.struct(*[f.cast("double").alias(f"f{i}") for i, f in enumerate(features)]))
