"""Embedding whitening by a bidiagonal qd solver.

Entries are quantised to integers and each distinct vector is fitted once. Sums are exact. Centred
rows are reduced block by block to one triangular factor R (each task a QR of its batches below the
R so far, then two levels of tasks merge these), so no cross products are formed and no precision is
lost to squaring. The driver holds R alone, whose size is the vectors' width: Householder
reflections make it bidiagonal, differential qd transforms with shifts (dqds) find the singular
values to high relative accuracy, and twisted factorisations give the singular vector of each. The
right singular vectors of R are the whitening directions. A last pass measures how far the whitened
fit list's covariance is from the identity.

Defined results: rows whose vector is null, without entries, or with a null or non-finite entry take
no part, nor do rows of another width than the commonest one (ties: the smaller width); a null id
is kept; repeated rows are returned as often as they come, and their vector is fitted once;
quantised entries saturate at 2**53; ``deviation`` is null where it doesn't fit a long; a component
without variance (fewer distinct vectors than components, constant entries) has no direction:
``explained`` is 0, ``whitened`` null, and it doesn't count in ``identity_error``, which is 0 if no
component has any; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caregauge.llm.common import bounded_batches
from caregauge.sources.scratch import stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Quantised entries saturate here: beyond it not every whole number is a double.
MOST = 2.0**53
#: Tasks that merge the triangular factors of all others, before the last one merges theirs.
MERGERS = 64
EPS = float(np.finfo(float).eps)
#: Eigenvalues whose relative distance is smaller are one cluster; its vectors are made orthogonal.
CLUSTER = 1e-3


# --- the bidiagonal solver: a matrix as wide as a vector, on the driver ---


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(u, beta) with (I - beta u u') x = a multiple of the first unit vector."""
    u = x.copy()
    norm = float(np.linalg.norm(x))
    if norm == 0 or not np.any(x[1:]):
        return u, 0.0
    u[0] += math.copysign(norm, x[0])
    return u, 2.0 / float(u @ u)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V): r = U B V' with an upper bidiagonal B, by Householder reflections."""
    a = r.astype(float).copy()
    d = len(a)
    v = np.eye(d)
    for k in range(d):
        u, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(u, u @ a[k:, k:])
        if k < d - 2:
            u, beta = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= beta * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _laguerre(q: list[float], e: list[float]) -> float:
    """A shift that doesn't pass the smallest eigenvalue: Laguerre's step from zero.

    The sums over 1/x and 1/x**2 of all eigenvalues x come from the derivatives of the qd
    transform by its shift; all their terms have one sign.
    """
    n = len(q)
    d, d1, d2 = q[0], -1.0, 0.0
    first = second = 0.0
    for k in range(n):
        pivot = d + (e[k] if k < n - 1 else 0.0)
        if pivot <= 0:
            return 0.0
        slope = d1 / pivot
        first -= slope
        second += slope * slope - d2 / pivot
        if k < n - 1:
            ratio = q[k + 1] / pivot
            part = e[k] / pivot
            d, d1, d2 = d * ratio, ratio * part * d1 - 1.0, ratio * part * (d2 - 2.0 * d1 * d1 / pivot)
    spread = max(0.0, (n - 1) * (n * second - first * first))
    shift = n / (first + math.sqrt(spread))
    return shift * (1 - 4 * EPS) if math.isfinite(shift) else 0.0


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential qd transform with a shift; None if the shift was too great."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    for k in range(n - 1):
        if d < 0:
            return None
        pivot = d + e[k]
        new_q[k] = pivot
        if pivot == 0:  # nothing couples the two sides
            d = q[k + 1] - shift
        else:
            ratio = q[k + 1] / pivot
            new_e[k] = e[k] * ratio
            d = d * ratio - shift
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    top = float(max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0)))
    if top == 0:
        return np.zeros(len(diagonal))
    done: list[float] = []
    work = [((diagonal / top) ** 2).tolist(), ((above / top) ** 2).tolist()]
    parts = [(work[0], work[1], 0.0)]
    tiny = (8 * EPS) ** 2
    while parts:
        q, e, moved = parts.pop()
        for _ in range(200 * len(q) + 200):
            while len(q) > 1 and e[-1] <= tiny * (moved + q[-1]):
                done.append(moved + q.pop())
                e.pop()
            if len(q) == 1:
                done.append(moved + q[0])
                break
            cut = next((k for k in range(len(e)) if e[k] <= tiny * moved), None)
            if cut is not None:
                parts += [(q[: cut + 1], e[:cut], moved), (q[cut + 1 :], e[cut + 1 :], moved)]
                break
            shift = _laguerre(q, e)
            while (new := _transform(q, e, shift)) is None:  # rounding took it too far
                shift = shift * 0.75 if shift > EPS * moved else 0.0
            (q, e), moved = new, moved + shift
        else:
            raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(done))[::-1] * top**2


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit vector of B'B for its eigenvalue ``value``, from the factorisation twisted where it is
    nearest to singular."""
    n = len(diagonal)
    top = float(max(np.abs(diagonal).max(), np.abs(above).max(initial=0))) or 1.0
    a, b, value = diagonal / top, above / top, value / top**2
    small = EPS**2
    a = np.where(np.abs(a) < small, small, a)
    d, low = (a * a).tolist(), (b / a[:-1]).tolist()
    down, up, s, p = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    s[0] = -value
    for k in range(n - 1):  # stationary: from the top
        pivot = s[k] + d[k] or small
        down[k] = d[k] * low[k] / pivot
        s[k + 1] = down[k] * low[k] * s[k] - value
    p[-1] = d[-1] - value
    for k in range(n - 2, -1, -1):  # progressive: from the bottom
        pivot = d[k] * low[k] * low[k] + p[k + 1] or small
        up[k] = d[k] * low[k] / pivot
        p[k] = p[k + 1] * d[k] / pivot - value
    twist = int(np.argmin(np.abs(np.array(s) + np.array(p) + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -up[k] * z[k]
    z = np.nan_to_num(z, nan=0.0, posinf=0.0, neginf=0.0)
    norm = float(np.linalg.norm(z))
    return z / norm if norm else z


def _orthogonal(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            z = z - (other @ z) * other
    return z


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(squared singular values of r, the first ``count`` right singular vectors as columns, all that
    have a direction flagged)."""
    diagonal, above, v = bidiagonal(r)
    values = dqds(diagonal, above)
    count = min(count, len(values))
    real = np.sqrt(values[:count]) > 16 * len(values) * EPS * math.sqrt(values[0]) if len(values) and values[0] > 0 else np.zeros(count, bool)
    vectors: list[np.ndarray] = []
    cluster: list[np.ndarray] = []
    for k in range(int(real.sum())):
        if k and values[k - 1] - values[k] > CLUSTER * values[k - 1]:
            cluster = []
        z = _orthogonal(twisted_vector(diagonal, above, values[k]), cluster)
        if np.linalg.norm(z) < 0.5:  # (nearly) equal values: one vector each by inverse iteration
            tri = np.diag(diagonal**2 + np.concatenate(([0.0], above**2))) + np.diag(diagonal[:-1] * above, 1) + np.diag(diagonal[:-1] * above, -1)
            shifted = tri - values[k] * (1 + 8 * EPS) * np.eye(len(tri))
            z = np.random.default_rng(k).normal(size=len(tri))
            for _ in range(4):
                z = _orthogonal(z / np.linalg.norm(z), cluster)
                z = np.linalg.solve(shifted, z / np.linalg.norm(z))
            z = _orthogonal(z / np.linalg.norm(z), cluster)
        z /= np.linalg.norm(z)
        cluster.append(z)
        whole = v @ z
        vectors.append(whole * math.copysign(1.0, whole[np.argmax(np.abs(whole))]))
    return values, np.array(vectors).reshape(-1, len(r)).T, real


# --- passes over the rows ---


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int, offset: int) -> DataFrame:
    """(key, x: array<bigint>) of the rows that take part, of any width."""
    given = F.col(vector).cast("array<double>")
    finite = F.forall(given, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def quantised(c: Column) -> Column:
        return F.floor(F.least(F.greatest(c * F.lit(float(scale)), F.lit(-MOST)), F.lit(MOST))) + F.lit(offset)

    return df.where((F.size(given) > 0) & finite).select(F.col(key), F.transform(given, quantised).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: longs, or Python integers where these don't suffice."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if most < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_deviations(x, n, sums) / n).astype(float)


def exact_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """(rows, sum of each entry) as whole numbers of any size."""

    def totals(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for part in parts:
            x = _matrix(part.column(0), width)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.arange(width), np.full(width, n), high, low)], ["k", "n", "high", "low"])

    kinds = "k long, n long, high long, low long"
    whole = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "high", "low")]
    rows = sorted(fit.select("x").mapInArrow(totals, kinds).groupBy("k").agg(*whole).collect())
    return (int(rows[0]["n"]), [int(r["high"]) * 2**32 + int(r["low"]) for r in rows]) if rows else (0, [0] * width)


def triangular_factor(fit: DataFrame, width: int, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows. Every task hands on one triangle, however many rows it has."""

    def of_rows(part: pa.RecordBatch) -> np.ndarray:
        return _centred(_matrix(part.column(0), width), n, sums)

    def of_triangles(part: pa.RecordBatch) -> np.ndarray:
        return _matrix(part.column(0), width)

    def reduced(rows_of: Callable[[pa.RecordBatch], np.ndarray]):
        def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            r = np.zeros((0, width))
            for part in parts:
                for low in range(0, part.num_rows, 4 * width):
                    r = np.linalg.qr(np.concatenate((r, rows_of(part.slice(low, 4 * width)))), mode="r")
            if len(r):
                square = np.zeros((width, width))
                square[: len(r)] = r
                flat = pa.array(square.ravel())
                offsets = pa.array([0, width * width], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, flat)], ["r"])

        return batches

    triangles = fit.select("x").mapInArrow(reduced(of_rows), "r array<double>")
    for tasks in (MERGERS, 1):
        triangles = triangles.repartition(tasks).mapInArrow(reduced(of_triangles), "r array<double>")
    return np.array(triangles.first()["r"]).reshape(width, width)


def identity_error(fit: DataFrame, width: int, n: int, sums: list[int], weights: np.ndarray) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = weights.shape[1]
    if not k:
        return 0.0

    def products(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for part in parts:
            w = _centred(_matrix(part.column(0), width), n, sums) @ weights
            total += np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "total"])

    rows = fit.select("x").mapInArrow(products, "k long, total double").groupBy("k").agg(F.sum("total")).collect()
    total = np.array([v for _, v in sorted(map(tuple, rows))]) / n
    mean, second = total[:k], total[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whitened(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    bounded_batches(df.sparkSession)
    rows = integer_vectors(df, key, vector, scale, offset)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    width_of = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.col("count").desc(), "width").first()
    if width_of is None:
        return df.sparkSession.createDataFrame([], schema)
    width = width_of["width"]
    rows = rows.where(F.size("x") == width)
    fit = stored(rows.select("x").distinct(), "distinct-vectors")
    n, sums = exact_sums(fit, width)
    values, vectors, real = directions(triangular_factor(fit, width, n, sums), components)
    count, whole = len(real), float(values.sum())
    explained = np.where(real, values[:count] / whole if whole else 0.0, 0.0)
    weights = vectors / np.sqrt(values[: vectors.shape[1]] / n)
    error = identity_error(fit, width, n, sums, weights)

    def projected(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            deviation = _deviations(_matrix(part.column(1), width), n, sums)
            w = np.full((len(deviation), count), np.nan)
            w[:, real] = (deviation / n).astype(float) @ weights
            if deviation.dtype == object or float(np.abs(deviation).max(initial=0)) ** 2 * width >= 2.0**62:
                deviation = deviation.astype(object)
            squares = (deviation * deviation).sum(axis=1).tolist()
            squares = pa.array([s if s < 2**63 else None for s in squares], pa.int64())
            at = pa.array(np.repeat(np.arange(part.num_rows), count))
            size = len(at)
            columns = [
                part.column(0).take(at),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), part.num_rows)),
                pa.array(np.full(size, n)),
                squares.take(at),
                pa.array(w.ravel(), mask=np.tile(~real, part.num_rows)),
                pa.array(np.tile(explained, part.num_rows)),
                pa.array(np.full(size, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(projected, schema)
