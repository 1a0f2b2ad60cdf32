"""Whitening of vectors: blockwise QR, Householder bidiagonalisation, dqds, twisted factorisations.

Every entry becomes a whole number, so that counts, sums and each row's deviation are exact. The centred rows
are reduced to one triangle R: tasks fold block after block into their own triangle, and triangles are
combined in a tree of groups. R has the size of one vector squared, whatever the number of rows; the rest is
done on it: Householder reflections make it bidiagonal, differential quotient-difference steps with shifts
give its singular values to high relative accuracy, and twisted factorisations give the vectors that belong
to them; values closer than `CLUSTER` share a space, in which vectors are made orthogonal. The covariance is
never formed. Rows are then projected, and the covariance of the projections is measured over all of them.

Defined results: rows drop out whose vector is null, or holds a null, an entry that is not finite or one of 2^56
or more (its number would not fit a long), or has another length than most vectors (the longer on a tie). Equal
vectors and repeated rows count as often as they occur; null ids stay null. Directions without variance have
no whitened values and are left out, so a table of equal vectors, or an empty one, gives an empty result. A
deviation beyond a long is null. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import staged

#: Fixed values of the whole-number form of an entry: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000

EPS = float(np.finfo(np.float64).eps)
#: Relative distance of squared singular values below which their vectors are made orthogonal to each other, and
#: below which they are found together, as a basis of one space.
CLUSTER, TIGHT = 1e-4, 1e-8
#: Triangles or moments combined in one group.
FAN = 32
#: Rows folded at a time.
ROWS = 4096


# --- the small dense part: everything below works on one triangle


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with U' r V upper bidiagonal."""
    a = np.array(r, np.float64)
    n = a.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or np.linalg.norm(x[1:]) == 0:
            return None
        u = x / size
        u[0] += math.copysign(1.0, u[0])
        return u / np.linalg.norm(u)

    for k in range(n):
        u = reflector(a[k:, k].copy())
        if u is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < n - 2:
            u = reflector(a[k, k + 1 :].copy())
            if u is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds step; None if the shift is above the smallest value. The last list holds the d of every place."""
    d = q[0] - shift
    new_q, new_e, ds = [], [], [d]
    for i in range(len(e)):
        if d < 0 or d != d:
            return None
        top = d + e[i]
        new_q.append(top)
        if top == 0:
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            t = q[i + 1] / top
            new_e.append(e[i] * t)
            d = d * t - shift
        ds.append(d)
    if d < 0 or d != d:
        return None
    return [*new_q, d], new_e, ds


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squared singular values of an upper bidiagonal matrix by dqds, falling.

    A step without shift gives the diagonal of the inverse, and so bounds for the smallest value on both sides;
    bolder shifts between them are tried first and undone where they overshoot.
    """
    found: list[float] = []
    work = [((diagonal**2).tolist(), (above**2).tolist(), 0.0)]
    while work:
        q, e, sigma = work.pop()
        while q:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (sigma + min(q[i], q[i + 1])) or e[i] == 0), None)
            if len(q) == 1 or cut == len(e) - 1:
                found.append(sigma + q.pop())
                if e:
                    e.pop()
                continue
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            plain = _sweep(q, e, 0.0)
            low = 1 / sum(1 / d for d in plain[2]) if min(plain[2]) > 0 else 0.0
            high, step = min(plain[2]), None
            for shift in ((low + 3 * high) / 4, (low + high) / 2, low * (1 - 16 * EPS)):
                if shift > sigma * EPS * 1e-3 and step is None and (step := _sweep(q, e, shift)) is not None:
                    sigma += shift
            q, e, _ = step if step is not None else plain
    return np.sort(np.array(found))[::-1]


def _stationary(big: np.ndarray, low: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(s, pivots, multipliers) of LDL' - value from the top."""
    n, tiny = len(big), EPS * EPS * max(value, 1e-300)
    s, pivots, multipliers = np.zeros(n), np.zeros(n), np.zeros(n - 1)
    s[0] = -value
    for i in range(n):
        d = s[i] + big[i]
        pivots[i] = d if abs(d) > tiny else tiny
        if i < n - 1:
            multipliers[i] = big[i] * low[i] / pivots[i]
            s[i + 1] = multipliers[i] * low[i] * s[i] - value
    return s, pivots, multipliers


def _progressive(big: np.ndarray, low: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray]:
    """(p, multipliers) of LDL' - value from the bottom."""
    n, tiny = len(big), EPS * EPS * max(value, 1e-300)
    p, multipliers = np.zeros(n), np.zeros(n - 1)
    p[n - 1] = big[n - 1] - value
    for i in range(n - 2, -1, -1):
        d = big[i] * low[i] * low[i] + p[i + 1]
        t = big[i] / (d if abs(d) > tiny else tiny)
        multipliers[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    return p, multipliers


def _twisted_vector(big: np.ndarray, low: np.ndarray, value: float) -> np.ndarray:
    """The vector of a value that stands alone: both factorisations meet where the twist is smallest."""
    s, _, down = _stationary(big, low, value)
    p, up = _progressive(big, low, value)
    at = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(len(big))
    z[at] = 1.0
    for i in range(at, 0, -1):
        z[i - 1] = -down[i - 1] * z[i]
    for i in range(at, len(big) - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _space(big: np.ndarray, low: np.ndarray, values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Vectors of values that coincide: turns of inverse iteration on a block, orthogonal to `others`."""
    n, k = len(big), len(values)
    x = np.random.default_rng(n * 1009 + k).normal(size=(n, k))
    _, pivots, multipliers = _stationary(big, low, float(values.mean()) * (1 - 4 * EPS))
    for _ in range(4):
        for _ in range(2):
            x = x - others @ (others.T @ x)
        x = np.linalg.qr(x)[0]
        for i in range(1, n):
            x[i] -= multipliers[i - 1] * x[i - 1]
        x /= pivots[:, None]
        for i in range(n - 2, -1, -1):
            x[i] -= multipliers[i] * x[i + 1]
        x /= np.abs(x).max(0)
    for _ in range(2):
        x = np.linalg.qr(x - others @ (others.T @ x))[0]
    image = np.sqrt(big)[:, None] * x  # the bidiagonal times x
    image[:-1] += (low * np.sqrt(big[:-1]))[:, None] * x[1:]
    return x @ np.linalg.svd(image, full_matrices=False)[2].T  # turned within the space, by falling value


def _block_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors of a bidiagonal block without zeros above the diagonal, as columns by falling value."""
    signs = np.cumprod(np.concatenate([[1.0], np.where(above * diagonal[:-1] < 0, -1.0, 1.0)]))
    big, low = diagonal**2, np.abs(above / diagonal[:-1])
    out = np.zeros((len(diagonal), len(values)))
    j = 0
    while j < len(values):
        end = j + 1
        while end < len(values) and values[end - 1] - values[end] <= TIGHT * values[end - 1]:
            end += 1
        near = out[:, [i for i in range(j) if values[i] - values[j] <= CLUSTER * values[i]]]
        if end == j + 1:
            z = _twisted_vector(big, low, values[j])
            for _ in range(2):
                z = z - near @ (near.T @ z)
            out[:, j] = z / np.linalg.norm(z)
        else:
            out[:, j:end] = _space(big, low, values[j:end], near)
        j = end
    return out * signs[:, None]


def directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, right singular vectors as columns) of a triangle, by falling value."""
    n = r.shape[1]
    size = float(np.abs(r).max(initial=0.0))
    if size == 0:
        return np.zeros(n), np.eye(n)
    diagonal, above, v = bidiagonal(r / size)
    norm = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    # a zero on the diagonal becomes a value below what rounding leaves of a zero singular value
    diagonal = np.where(np.abs(diagonal) < EPS * norm / 64, EPS * norm / 64, diagonal)
    cuts = [0, *[i + 1 for i in range(n - 1) if abs(above[i]) <= EPS * math.sqrt(abs(diagonal[i] * diagonal[i + 1]))], n]
    values, vectors = np.zeros(n), np.zeros((n, n))
    for a, b in zip(cuts, cuts[1:], strict=False):
        values[a:b] = squared_singular_values(diagonal[a:b], above[a : b - 1])
        vectors[a:b, a:b] = _block_vectors(diagonal[a:b], above[a : b - 1], values[a:b])
    order = np.argsort(-values, kind="stable")
    return values[order] * size * size, v @ vectors[:, order]


# --- what runs in tasks


def usable(vector: Column) -> Column:
    """Whether a vector has only entries that are finite and fit."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 56)))


def _numbers(batch: pa.RecordBatch, width: int) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, width) + OFFSET


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def _summer(width: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in _slices(batches):
            x = _numbers(batch, width)
            n += len(x)
            safe = len(x) and np.abs(x).max() < (1 << 62) // len(x)
            part = x.sum(0).tolist() if safe else x.astype(object).sum(0).tolist() if len(x) else [0] * width
            sums = [a + b for a, b in zip(sums, part, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array([str(s) for s in sums])], ["place", "n", "total"])

    return add


class Centre:
    """Exact distances of rows from the mean, times the number of rows."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.base = [s // n for s in sums]
        self.rest = [s - n * b for s, b in zip(sums, self.base, strict=True)]

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, as longs where they fit, else as Python's whole numbers."""
        base = np.array(self.base, np.int64)
        if int(np.abs(x).max(initial=0)) + max(map(abs, self.base)) < 1 << 62:
            near = x - base
            if (int(np.abs(near).max(initial=0)) + 1) * self.n < 1 << 62:
                return near * self.n - np.array(self.rest, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.apart(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> pa.Array:
        d = self.apart(x)
        if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * max(d.shape[1], 1) >= 1 << 63:
            d = d.astype(object)
        if d.dtype != object:
            return pa.array((d * d).sum(1))
        return pa.array([s if s < 1 << 63 else None for s in (int(sum(v * v for v in row)) for row in d)], pa.int64())


def _blob_batch(blob: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([blob.tobytes()], pa.binary())], ["blob"])


def _triangle(width: int, centre: Centre):
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in _slices(batches):
            r = np.linalg.qr(np.vstack([r, centre.centred(_numbers(batch, width))]), mode="r")
        if len(r):
            yield _blob_batch(r)

    return reduce


def _join_triangles(width: int):
    def join(blobs: list[bytes]) -> np.ndarray:
        r = np.zeros((0, width))
        for blob in blobs:
            r = np.linalg.qr(np.vstack([r, np.frombuffer(blob).reshape(-1, width)]), mode="r")
        return r

    return join


def _merge(a: tuple, b: tuple) -> tuple:
    """Counts, means and centred products of two sets of rows taken together."""
    (n, mean, m2), (k, other, o2) = a, b
    if not n:
        return b
    apart = other - mean
    return n + k, mean + apart * (k / (n + k)), m2 + o2 + np.outer(apart, apart) * (n * k / (n + k))


def _moments(width: int, centre: Centre, to: np.ndarray):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = (0, 0, 0)
        for batch in _slices(batches):
            y = centre.centred(_numbers(batch, width)) @ to
            mean = y.mean(0)
            y = y - mean
            whole = _merge(whole, (len(y), mean, y.T @ y))
        if whole[0]:
            yield _blob_batch(np.vstack([np.full(to.shape[1], float(whole[0])), whole[1], whole[2]]))

    return measure


def _join_moments(k: int):
    def join(blobs: list[bytes]) -> np.ndarray:
        whole = (0, 0, 0)
        for blob in blobs:
            m = np.frombuffer(blob).reshape(k + 2, k)
            whole = _merge(whole, (m[0, 0], m[1], m[2:]))
        return np.vstack([np.full(k, float(whole[0])), whole[1], whole[2]])

    return join


def _in_tree(blobs: DataFrame, join: Callable[[list[bytes]], np.ndarray], label: str) -> np.ndarray:
    """Combine one blob a task in groups of FAN, until the driver combines the last few."""

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"blob": [join(group.sort_values("part").blob.tolist()).tobytes()], "part": [group.part.iloc[0] // FAN]})

    level = staged(blobs.withColumn("part", F.spark_partition_id()), label)
    while (level.agg(F.max("part")).first()[0] or 0) >= FAN:
        grouped = level.groupBy(F.floor(F.col("part") / FAN).alias("g"))
        level = staged(grouped.applyInPandas(combine, "blob binary, part int"), label)
    return join([r.blob for r in level.orderBy("part").collect()])  # at most FAN rows


def _projector(width: int, centre: Centre, to: np.ndarray, explained: np.ndarray, error: float):
    k = to.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = _numbers(batch, width)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            y = centre.centred(x) @ to
            columns = [
                batch.column("id").take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, centre.n)),
                centre.deviations(x).take(each),
                pa.array(y.ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(x) * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return project


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row and component: rows `n`, `deviation`, the `whitened` value, the share `explained`, and the
    largest distance of the whitened values' covariance from the identity."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    kind = rows.schema["id"].dataType.simpleString()
    result = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    empty = spark.createDataFrame([], result).toDF(*names)

    most = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if most is None or not most.width:
        return empty
    width = most.width
    rows = rows.where(F.size("vector") == width)
    added = rows.mapInArrow(_summer(width), "place int, n long, total string").groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = added.orderBy("place").collect()  # one row a dimension
    centre = Centre(sums[0].n, [int(r.total) for r in sums])

    r = _in_tree(rows.mapInArrow(_triangle(width, centre), "blob binary"), _join_triangles(width), "triangles")
    square = np.zeros((max(width, len(r)), width))
    square[: len(r)] = r
    values, v = directions(square[:width])
    kept = int((values > values[0] * (8 * width * EPS) ** 2).sum()) if values[0] > 0 else 0
    kept = min(kept, components)
    if not kept:
        return empty
    to = v[:, :kept] / np.sqrt(values[:kept] / centre.n)
    explained = values[:kept] / values.sum()

    moments = _in_tree(rows.mapInArrow(_moments(width, centre, to), "blob binary"), _join_moments(kept), "moments")
    error = float(np.abs(moments[2:] / moments[0, 0] - np.eye(kept)).max())
    return rows.mapInArrow(_projector(width, centre, to, explained, error), result).toDF(*names)
