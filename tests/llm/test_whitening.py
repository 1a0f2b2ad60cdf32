"""Whitening against exact whole numbers and a plain eigendecomposition."""

import math
import random

import numpy as np
import pytest

from riskloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component int, id string, vector string"


def make_rows(n=300, width=12):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(n, width)) * np.linspace(3, 0.5, width)
    base[:, 4] += base[:, 2]
    rows = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(base)]
    rows += [rows[7]] * 40 + [(None, rows[3][1]), (900, None), (901, [None] + rows[0][1][1:]), (902, [math.nan] + rows[0][1][1:])]
    rows += [(903, [math.inf] + rows[0][1][1:]), (904, [1e30] + rows[0][1][1:]), (905, [1.0, 2.0]), (906, []), (907, rows[0][1] + [1.0])]
    random.Random(1).shuffle(rows)
    return [(*r, 0, 5, 1, "i", "v") for r in rows]


def brute(rows, width):
    kept = [r for r in rows if r[1] is not None and len(r[1]) == width and all(v is not None and math.isfinite(v) and abs(v) < 2**56 for v in r[1])]
    x = [[math.floor(64 * v) + 1_000_000 for v in r[1]] for r in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * v - s) / n for v, s in zip(row, sums)] for row in x])
    return kept, n, deviation, centred


@pytest.mark.parametrize("count", [5, 32])
def test_whitening(spark, count):
    rows = make_rows()
    kept, n, deviation, centred = brute(rows, 12)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(count, 12)
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5), components=count)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    assert len(got) == len(kept) * k
    table = {}
    for r in got:
        assert r.n == n and 0 <= r.identity_error < 1e-12
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        table.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    want = centred @ vectors / np.sqrt(values)
    signs = {}
    for (i, *_), d, row in zip(kept, deviation, want, strict=True):
        for c in range(1, k + 1):
            mine = table[i, d][c]
            if abs(row[c - 1]) > 1e-3:
                signs.setdefault(c, set()).add(math.copysign(1, row[c - 1] * mine[0]))
            assert all(abs(abs(v) - abs(row[c - 1])) < 1e-9 for v in mine)
    assert all(len(s) == 1 for s in signs.values())


def test_tables_without_directions(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    same = [(i, [1.0, 2.0], 0, 0, 0, "", "") for i in range(5)]
    assert whitening.whiten(spark.createDataFrame(same, SCHEMA)).collect() == []
    line = [(i, [float(i), 2.0, float(i)], 0, 0, 0, "", "") for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1) and got[0].identity_error < 1e-12


def test_large_numbers(spark):
    """Deviations stay exact beyond a long's intermediate values, and are null where they do not fit."""
    rows = [(1, [2.0**50, 0.0]), (2, [-(2.0**50), 3.0]), (3, [0.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame([(*r, 0, 0, 0, "", "") for r in rows], SCHEMA), components=1).collect()
    assert [r.deviation for r in sorted(got, key=lambda r: r.vec_id)] == [None, None, (64 + 64 * 2 - 64 * 3) ** 2 + (64 * 3 - 64 * 4) ** 2]


def test_tree_of_triangles(spark):
    """More tasks than one group takes give the same values."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=4)], 0, 0, 0, "", "") for i in range(200)]
    one = whitening.whiten(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    many = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(70)).collect()
    a = {(r.vec_id, r.component): r for r in one}
    for r in many:
        other = a[r.vec_id, r.component]
        assert r.deviation == other.deviation and abs(abs(r.whitened) - abs(other.whitened)) < 1e-10


def triangles():
    rng = np.random.default_rng(4)
    turned = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    base = np.linalg.qr(rng.normal(size=(200, 40)))[0]
    yield np.triu(rng.normal(size=(30, 30)))
    yield np.eye(9)
    yield np.ones((5, 5))
    yield np.zeros((3, 3))
    yield np.diag(np.ones(41)) + np.diag(np.ones(40), 1)
    for scale in (np.logspace(0, -9, 40), np.repeat([3, 1 + 1e-9, 1, 0], 10), np.repeat([1, 1e-3], 20)):
        yield np.linalg.qr((base * scale) @ turned, mode="r")


@pytest.mark.parametrize("r", list(triangles()), ids=str)
def test_directions(r):
    values, v = whitening.directions(r)
    largest = max(values[0], 1e-300)
    assert np.abs(np.sqrt(values) - np.linalg.svd(r)[1]).max() <= 1e-13 * math.sqrt(largest)
    assert np.abs(v.T @ v - np.eye(len(v))).max() < 1e-11
    assert np.abs(r.T @ (r @ v) - v * values).max() <= 1e-13 * largest


def test_small_values_are_accurate():
    """A graded bidiagonal matrix has singular values right in every digit, however small."""
    d, e = np.array([1.0, 1e-5, 1e-10, 1e-15]), np.array([1.0, 1e-5, 1e-10]) * 0.5
    values = whitening.squared_singular_values(d, e)
    assert np.prod(np.sqrt(values)) == pytest.approx(np.prod(d), rel=1e-13)
