"""Whitening of embeddings by FEAST: contour integrals project onto eigenvalue intervals.

The covariance of the distinct vectors is summed on the cluster, centred before
multiplying. Its leading eigenpairs then come from intervals of the spectrum:
inertia counts (Sturm counts of the tridiagonal form) locate the leading
eigenvalues and put interval ends into the gaps between them; for each
interval a Gauss-Legendre quadrature of complex shifted solves along a circle
through its ends projects a small random block onto the interval's eigenspace,
Rayleigh-Ritz extracts the eigenpairs, and both repeat until the residuals are
at rounding level. The eigenvalues found inside an interval must be as many as
the inertia counts say, or the block is enlarged; none can be missed unseen.

Layout over the cluster: one exchange makes vectors distinct (combined before
it), the result is written once to the shared folder, and three scans of it give
the sums, the centred products and the check of the whitened covariance, each
as one partial result a partition. Only numbers that don't grow with the rows
reach the driver: dimensions times dimensions of products. The transformation is one pass over
the rows with the few components in its closure; nothing is joined.

Defined results: rows whose vector is null, empty or holds a null or
non-finite entry are dropped; all other rows come back, also those with a null id or
repeated; vectors of several lengths raise. Vectors that repeat count once in the fit. A direction without variance (fewer
distinct vectors than components) has a null whitened value and 0 explained
(null if there is no variance at all); the identity error is over the
directions that have variance, null without any. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.shared import cut, cuts_made, release

COMPONENTS = 4
NODES = 8                # of the quadrature over a half circle
CLOSE = 1e-4             # eigenvalues nearer than this part of the largest share an interval
ROUNDS = 40
_EPS = float(np.finfo(float).eps)


# --- the eigenpairs of a symmetric matrix of bounded size -----------------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix (Householder)."""
    a = matrix.astype(float).copy()
    d = len(a)
    for k in range(d - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += size if v[0] >= 0 else -size
        v /= np.linalg.norm(v)
        block = a[k + 1:, k + 1:]
        w = block @ v
        w -= (v @ w) * v
        block -= 2 * np.outer(v, w) + 2 * np.outer(w, v)
        a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_below(tri: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues lie below ``shift``: the negative pivots of the shifted matrix (Sylvester's law of inertia)."""
    below, pivot = 0, 1.0
    squares = np.concatenate([[0.0], tri[1] ** 2])
    for d, s in zip((tri[0] - shift).tolist(), squares.tolist()):
        pivot = d - s / pivot
        if pivot == 0:
            pivot = -_EPS * _EPS
        below += pivot < 0
    return below


def _locate(tri, rank: int, low: float, high: float) -> float:
    """The eigenvalue number ``rank`` from above (0 is the largest), by bisection of counts."""
    n = len(tri[0])
    for _ in range(60):
        mid = (low + high) / 2
        if n - count_below(tri, mid) > rank:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def intervals(matrix: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) from above, until at least ``k`` eigenvalues are inside; ends lie in gaps."""
    d, tri = len(matrix), tridiagonal(matrix)
    reach = np.abs(matrix).sum(axis=1).max()    # Gershgorin
    found: list[float] = []

    def at(j: int) -> float:
        while len(found) <= j:
            found.append(_locate(tri, len(found), -reach, reach * (1 + 1e-9)))
        return found[j]

    out, start = [], 0
    while start < min(k, d):
        end = start + 1
        while end < d and at(end - 1) - at(end) <= CLOSE * reach:
            end += 1
        above = (at(start - 1) - at(start)) / 2 if start else reach
        below = (at(end - 1) - at(end)) / 2 if end < d else reach
        room = min(above, below)                # the same on both sides: the circle stays away from its neighbours
        low, high = at(end - 1) - room, at(start) + room
        out.append((low, high, count_below(tri, high) - count_below(tri, low)))
        start = end
    return out


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues (falling) inside an interval, and their eigenvectors as columns."""
    d, scale = len(matrix), np.abs(matrix).sum(axis=1).max()
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(-0.5j * np.pi * (nodes - 1))
    centre, radius = (low + high) / 2, (high - low) / 2
    size = count + 4
    while True:
        block = np.random.default_rng(7).standard_normal((d, min(size, d)))
        best = np.inf
        for _ in range(ROUNDS):
            projected = np.zeros_like(block)
            for w, t in zip(weights, turn):     # the other half circle gives the complex conjugates
                shifted = np.linalg.solve((centre + radius * t) * np.eye(d) - matrix, block)
                projected += 0.5 * w * (radius * t * shifted).real
            basis, sizes, _ = np.linalg.svd(projected, full_matrices=False)
            basis = basis[:, sizes > sizes[0] * 1e-14]
            values, turned = np.linalg.eigh(basis.T @ matrix @ basis)   # Rayleigh-Ritz, of the block's size
            vectors = basis @ turned
            inside = (values > low) & (values < high)
            if inside.sum() == count:
                error = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0).max() / scale
                if error <= 4 * _EPS or (error <= 1e-13 and error > best / 2):  # at rounding level, no longer falling
                    return values[inside][::-1], vectors[:, inside][:, ::-1]
                best = min(best, error)
            block = vectors
        if size >= d:
            raise RuntimeError(f"{count} eigenvalues are in [{low}, {high}] by inertia, but the projection doesn't settle on them")
        size = min(d, 2 * size)


def eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (falling) of a symmetric matrix and their unit eigenvectors as columns."""
    k = min(k, len(matrix))
    if not np.any(matrix):
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    parts = [feast(matrix, *interval) for interval in intervals(matrix, k)]
    values, vectors = np.concatenate([p[0] for p in parts])[:k], np.hstack([p[1] for p in parts])[:, :k]
    return values, vectors / np.linalg.norm(vectors, axis=0)


# --- on the cluster ------------------------------------------------------------------------------------------

@dataclass
class Whitening:
    n: int                      # distinct vectors
    sums: list[int]             # of each dimension over them
    values: np.ndarray          # eigenvalues, falling
    vectors: np.ndarray         # dimensions x components
    trace: float
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def projection(self) -> np.ndarray:
        """dimensions x components; a direction without variance is NaN."""
        return self.vectors / np.sqrt(np.where(self.values > 0, self.values, np.nan))

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.projection()

    def deviation(self, x: np.ndarray) -> list[int]:
        """The exact sum of (n * x - sum)**2 over the dimensions of each row."""
        far = max(self.n * int(np.abs(x).max(initial=0)), 0) + max((abs(s) for s in self.sums), default=0)
        if far < 1 << 62 and (far * far) * max(1, x.shape[1]) < 1 << 63:
            t = self.n * x - np.array(self.sums, dtype=np.int64)
            return (t * t).sum(axis=1).tolist()
        return [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]


def whole(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each entry, computed in doubles, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def usable(vector: Column) -> Column:
    return (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _stack(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(np.int64)


def _summed(fit: DataFrame, part, kind: str) -> list:
    """The sum over all rows of the flat arrays that ``part`` makes of a batch (rows x dimensions): one partial result a partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                here = part(_stack(pdf["x"]))
                total = here if total is None else total + here
        if total is not None:
            yield pd.DataFrame({"v": [total]})
    rows = (fit.mapInPandas(run, f"v array<{kind}>").select(F.posexplode("v").alias("place", "value"))
            .groupBy("place").agg(F.sum("value").alias("value")).collect())
    return [value for _, value in sorted((r["place"], r["value"]) for r in rows)]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors in the column ``x`` (array<long>) of ``vectors``; None without rows."""
    spark, before = vectors.sparkSession, cuts_made()
    distinct = cut(vectors.select("x").distinct(), "whitening-fit")
    lengths = [r[0] for r in distinct.select(F.size("x")).distinct().limit(2).collect()]
    if len(lengths) > 1:
        raise ValueError("vectors of several lengths can't be whitened together")
    if not lengths:
        release(spark, before)
        return None
    d = lengths[0]
    n, *sums = _summed(distinct, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), "long")
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - model.mean
        return (centred.T @ centred).ravel()
    covariance = np.array(_summed(distinct, products, "double")).reshape(d, d) / n
    covariance = (covariance + covariance.T) / 2
    values, directions = eigenpairs(covariance, components)
    trace = float(np.trace(covariance))
    real = values > d * _EPS * trace        # what is left below that is rounding
    model = Whitening(n, sums, np.where(real, values, 0.0), directions, trace)

    def check(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x)[:, real]
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
    if k := int(real.sum()):
        totals = np.array(_summed(distinct, check, "double")) / n
        model.identity_error = float(np.abs(totals[k:].reshape(k, k) - np.outer(totals[:k], totals[:k]) - np.eye(k)).max())
    release(spark, before)
    return model


def whiten(table: DataFrame, vector: Column, id_col: str = "vec_id", components: int = COMPONENTS, factor: int = 256) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error) of each usable row and component.

    ``deviation`` is decimal(38,0), as it outgrows a long in large tables.
    """
    rows = table.where(usable(vector)).select(table[id_col].alias("id"), whole(vector, factor).alias("x"))
    model = fit(rows, components)
    if model is None:
        return rows.where(F.lit(False)).select(
            F.col("id").alias(id_col), F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("deviation"),
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])

    @F.pandas_udf("struct<w: array<double>, deviation: string>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for xs in batches:
            if not len(xs):
                yield pd.DataFrame({"w": [], "deviation": []})
                continue
            x = _stack(xs)
            yield pd.DataFrame({"w": list(model.whitened(x)), "deviation": [str(v) for v in model.deviation(x)]})

    explained = F.array(*[F.lit(float(v / model.trace) if model.trace > 0 else None).cast("double") for v in model.values])
    made = rows.select("id", project("x").alias("made")).select("id", "made.deviation", F.posexplode("made.w").alias("place", "w"))
    return made.select(F.col("id").alias(id_col), (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                       F.col("deviation").cast("decimal(38,0)").alias("deviation"), F.when(~F.isnan("w"), F.col("w")).alias("whitened"),
                       F.get(explained, F.col("place")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"))
