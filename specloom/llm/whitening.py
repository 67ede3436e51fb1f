"""Whitening of embeddings, by eigenvectors refined in mixed precision.

1. Entries become integers, x = floor(1024 * c) + 100000. Their sums, and then
   the sums of products of x less the rounded mean, are added up by Spark. They
   are whole numbers, so the covariance is the same however rows are dealt.
2. The covariance, one number per pair of dimensions, is solved in float32.
   Ogita-Aishima iterations (matrix products only) then correct the vectors;
   what must cancel, the products X'X and X'AX, is computed in extended
   precision. Where eigenvalues lie too close to tell their vectors apart
   that way, the space they span is solved by itself, in double precision.
3. Rows are projected, and the covariance of the result is measured over all rows.

Vectors of each length are a list of their own, with its own n and components.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
# Rows of a block: products of whole numbers up to 2**20 stay exact in doubles over so many rows.
BLOCK_ROWS = 4096
# Entries beyond are held there: such vectors are far outside any range that integers of 64 bits can sum up.
LARGEST = 2.0**62
HIGH = np.longdouble
# Eigenvalues nearer than this, per dimension and relative to the matrix, count as equal.
TIE = 1e3 * float(np.finfo(HIGH).eps)


# The covariance's eigenvectors


def eigenvectors(a: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    ``a`` may be in extended precision. Starts from float32 and stops when a
    correction no longer changes a double.
    """
    a = np.asarray(a, HIGH)
    size = float(np.abs(a).max(initial=0))
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / HIGH(size)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)
    last = np.inf
    for _ in range(rounds):
        x, change = _corrected(a, x)
        if change < 1e-17 or (change < 1e-14 and change >= last / 2):
            break
        last = change
    x = _orthogonal(x)
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * HIGH(size)).astype(np.float64), x[:, order].astype(np.float64)


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, float]:
    """One Ogita-Aishima step: the corrected vectors, and the largest entry of the correction."""
    x, values, r, s = _measured(a, x)
    off = s - np.diag(values)
    # Closer eigenvalues than this can't be told apart by the step.
    close = 2 * float(np.linalg.norm(off.astype(np.float64)) + np.abs(values).max() * np.linalg.norm(r.astype(np.float64)))
    clusters = _clusters(values, close)
    if clusters:
        for one in clusters:
            x[:, one] = _solved_apart(a, x[:, one])
        x, values, r, s = _measured(a, x)
    gap = values[None, :] - values[:, None]
    # What has been solved apart only needs to stay orthogonal; so do ties, whose gaps are rounding.
    apart = np.abs(gap) > max(close, TIE * len(a))
    with np.errstate(divide="ignore", invalid="ignore"):
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    np.fill_diagonal(e, np.diag(r) / 2)
    return x + x @ e, float(np.abs(e).max())


def _measured(a: np.ndarray, x: np.ndarray):
    """The vectors by rising eigenvalue, their eigenvalues, and what their products lack to I and to a diagonal."""
    s, r = x.T @ (a @ x), np.eye(len(a), dtype=HIGH) - x.T @ x
    values = np.diag(s) / (1 - np.diag(r))
    order = np.argsort(values, kind="stable")
    return x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]


def _clusters(values: np.ndarray, close: float) -> list[np.ndarray]:
    """Places of neighbouring eigenvalues that are ``close``, two or more together."""
    cut = np.flatnonzero(np.diff(values) > close) + 1
    return [c for c in np.split(np.arange(len(values)), cut) if len(c) > 1]


def _orthogonal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns made so to extended precision."""
    for _ in range(3):
        x = x @ (HIGH(1.5) * np.eye(x.shape[1], dtype=HIGH) - HIGH(0.5) * (x.T @ x))
    return x


def _solved_apart(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The eigenvectors within the space of ``x``. Less their common part, close eigenvalues are far apart in proportion."""
    x = _orthogonal(x)
    inner = x.T @ (a @ x)
    inner -= np.trace(inner) / len(inner) * np.eye(len(inner), dtype=HIGH)
    return x @ np.linalg.eigh(((inner + inner.T) / 2).astype(np.float64))[1].astype(HIGH)


# Sums over the rows


def _vectors(column: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """[(places of rows, matrix of whole numbers)] by length; vectors that are null, empty or hold null or non-finite entries are left out."""
    column = column.cast(pa.list_(pa.float64()))
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    length, usable = np.diff(offsets), column.is_valid().to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    usable = usable & (bad[offsets[1:]] == bad[offsets[:-1]]) & (length > 0)
    out = []
    for d in np.unique(length[usable]):
        rows = np.flatnonzero(usable & (length == d))
        c = flat[offsets[rows][:, None] + np.arange(d)]
        out.append((rows, np.clip(np.floor(SCALE * c) + SHIFT, -LARGEST, LARGEST).astype(np.int64)))
    return out


def _sums(batches):
    """Per length and dimension: the rows and the sum of entries, as text, as it may pass 64 bits."""
    n, total = {}, {}
    for batch in batches:
        for _, x in _vectors(batch.column("embedding")):
            d = x.shape[1]
            n[d] = n.get(d, 0) + len(x)
            exact = x if np.abs(x).max(initial=0) < 2**40 else x.astype(object)
            total[d] = total.get(d, 0) + exact.sum(axis=0).astype(object)
    rows = [(d, j, n[d], str(s)) for d in n for j, s in enumerate(total[d])]
    yield pa.RecordBatch.from_pylist([dict(zip(("d", "j", "n", "s"), r)) for r in rows], pa.schema([("d", pa.int32()), ("j", pa.int32()), ("n", pa.int64()), ("s", pa.string())]))


@dataclass(frozen=True)
class Whitening:
    """What whitens vectors of one length: x, less the mean, on each component over the root of its eigenvalue."""

    n: int
    total: list[int]  # S
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        """The mean, rounded."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.total], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """n times the mean, less n times the rounded one."""
        return np.array([s - self.n * int(c) for s, c in zip(self.total, self.centre)], np.int64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) - self.rest / self.n) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> pa.Array:
        """The sum of (n * x - S)**2, exact; null where 64 bits don't hold it."""
        near = x - self.centre
        if (self.n * np.abs(near.astype(np.float64)).max(initial=0) + self.n) ** 2 * x.shape[1] < 2**62:
            return pa.array(((self.n * near - self.rest) ** 2).sum(axis=1))
        exact = ((self.n * near.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return pa.array([int(v) if v < 2**63 else None for v in exact], pa.int64())


def _products(centres: dict[int, np.ndarray]):
    """Per length and pair of dimensions, the sum of products of entries less ``centres``; one row for each dimension."""

    def work(batches):
        total = {}
        for batch in batches:
            for _, x in _vectors(batch.column("embedding")):
                d = x.shape[1]
                y = (x - centres[d]).astype(np.float64)
                for at in range(0, len(y), BLOCK_ROWS):
                    part = y[at : at + BLOCK_ROWS]
                    total[d] = total.get(d, 0) + part.T @ part
        for d, m in total.items():
            i, j = np.triu_indices(d)
            columns = {"d": pa.array(np.full(len(i), d), pa.int32()), "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": pa.array(m[i, j], pa.float64())}
            yield pa.RecordBatch.from_pydict(columns)

    return work


def fit_whitening(embeddings: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """{length of vectors: what whitens them}. Only sums over all rows reach the driver: d * d of them for length d."""
    vectors = embeddings.select("embedding")
    sums = vectors.mapInArrow(_sums, "d int, j int, n long, s string").groupBy("d", "j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    n, total = {}, {}
    for r in sums.collect():
        n[r.d] = r.n
        total.setdefault(r.d, {})[r.j] = int(r.s)
    total = {d: [s[j] for j in range(d)] for d, s in total.items()}
    none = np.zeros(0)
    plain = {d: Whitening(n[d], total[d], none, none, none) for d in n}
    work = _products({d: w.centre for d, w in plain.items()})
    products = vectors.mapInArrow(work, "d int, i int, j int, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    matrices = {d: np.zeros((d, d), HIGH) for d in n}
    for r in products.collect():
        matrices[r.d][r.i, r.j] = matrices[r.d][r.j, r.i] = r.v
    fitted = {}
    for d, m in matrices.items():
        rest = plain[d].rest.astype(HIGH) / HIGH(n[d])
        covariance = m / HIGH(n[d]) - np.outer(rest, rest)
        values, x = eigenvectors(covariance)
        trace = float(np.trace(covariance))
        # No variance can't be made 1: such directions are no components.
        k = min(components, int((values > trace * d * np.finfo(np.float64).eps).sum()))
        fitted[d] = Whitening(n[d], total[d], values[:k], x[:, :k], values[:k] / trace if trace else values[:k])
    return fitted


# The rows


def _measured_rows(fitted: dict[int, Whitening]):
    """Per length: rows, sums and sums of products of the whitened columns, as flat rows (d, i, j, v); i is -1 for sums."""

    def work(batches):
        first, second = {}, {}
        for batch in batches:
            for _, x in _vectors(batch.column("embedding")):
                d = x.shape[1]
                z = fitted[d].whitened(x)
                first[d] = first.get(d, 0) + z.sum(axis=0)
                second[d] = second.get(d, 0) + z.T @ z
        rows = [(d, -1, j, v) for d in first for j, v in enumerate(first[d])]
        rows += [(d, i, j, v) for d in second for (i, j), v in np.ndenumerate(second[d])]
        yield pa.RecordBatch.from_pylist([dict(zip("dijv", r)) for r in rows], pa.schema([("d", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())]))

    return work


def identity_errors(embeddings: DataFrame, fitted: dict[int, Whitening]) -> dict[int, float]:
    """{length: the largest absolute entry of the whitened rows' covariance less the identity}, measured over all rows.

    The means are 0 but for rounding, so taking their products off afterwards cancels nothing.
    """
    rows = embeddings.select("embedding").mapInArrow(_measured_rows(fitted), "d int, i int, j int, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    k = {d: len(w.values) for d, w in fitted.items()}
    mean, product = {d: np.zeros(k[d]) for d in k}, {d: np.zeros((k[d], k[d])) for d in k}
    for r in rows.collect():
        if r.i < 0:
            mean[r.d][r.j] = r.v / fitted[r.d].n
        else:
            product[r.d][r.i, r.j] = r.v / fitted[r.d].n
    return {d: float(np.abs(product[d] - np.outer(mean[d], mean[d]) - np.eye(k[d])).max(initial=0)) for d in k}


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of (vec_id, embedding).

    A row for each vector and component. Vectors that are null or hold a null or
    non-finite entry take no part. Each length of vectors is whitened by itself.
    Directions without variance are no components, so equal vectors alone, or
    a single one, give no rows; nor do empty vectors or an empty table. Repeated
    rows and ids count and come out each. Entries beyond 2**62 after scaling are
    held there. ``deviation`` is null where it needs more than 64 bits. Other
    columns are left out. Equal eigenvalues share their space in some basis.
    """
    rows = embeddings.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fitted = fit_whitening(rows, components)
    errors = identity_errors(rows, fitted)
    kind = rows.schema["vec_id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            for places, x in _vectors(batch.column("embedding")):
                w = fitted[x.shape[1]]
                k = len(w.values)
                if k:
                    again = pa.array(np.repeat(np.arange(len(places)), k))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "vec_id": batch.column("vec_id").take(pa.array(places)).take(again),
                            "component": pa.array(np.tile(np.arange(1, k + 1), len(places)), pa.int32()),
                            "n": pa.array(np.full(len(again), w.n), pa.int64()),
                            "deviation": w.deviation(x).take(again),
                            "whitened": pa.array(w.whitened(x).ravel()),
                            "explained": pa.array(np.tile(w.explained, len(places))),
                            "identity_error": pa.array(np.full(len(again), errors[x.shape[1]])),
                        }
                    )

    return rows.mapInArrow(work, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
