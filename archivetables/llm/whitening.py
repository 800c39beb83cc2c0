"""Whitening of embeddings by spectral divide-and-conquer.

Entries are put on a grid of 64 steps to the unit, so that sums over all distinct vectors are whole
numbers: tasks add them up exactly, in any order, about the whole numbers nearest to the means, and the
covariance is rounded once. Its invariant subspaces come from polar decompositions: the orthogonal factor
of ``V - shift`` (dynamically weighted Halley iterations, each a QR factorisation) is the sign of that
matrix, and half of sign plus identity projects on the eigenvalues above the shift. Each projector cuts
the matrix into two smaller ones, until single components are left; what holds none of the components
asked for is not cut further. The few components go to all tasks, which project every vector.

Only matrices of dimension by dimension reach the driver, whatever the number of vectors.

Rows whose vector is null, or holds null or non-finite entries, are dropped, and so are vectors of another
length than most (of equally many the longer ones are kept). Repeated rows and repeated or null ``vec_id``
stay, each with its own result; the fit counts a vector once. Components without variance are left out:
a table without two different vectors has none and gives no rows, as an empty one does. Other columns
are ignored, whatever their names. An entry or deviation beyond 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivetables.llm.common import exact, written

STEPS = 64  # of the grid to the unit
ORIGIN = 1_000_000  # grid value of the interval that begins at 0
EXACT = 2**53  # whole numbers below are exact in floating point
EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """``values`` and ``vectors`` (columns) of the leading components of the covariance of ``n`` distinct
    grid vectors with sums ``sums`` and total variance ``trace``."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The whole numbers nearest to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        """``n`` times what the means exceed the centre by."""
        return np.array([s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)])


def grid_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, x``: the usable vectors of ``embeddings`` (``vec_id, embedding``) on the grid."""
    rows = exact(embeddings, "vec_id", "embedding")
    entries = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    on_grid = F.transform(entries, lambda c: F.floor(c * STEPS).cast("long") + F.lit(ORIGIN).cast("long"))
    rows = rows.where(F.col("embedding").isNotNull() & usable & (F.size("embedding") > 0))
    lengths = rows.groupBy(F.size("embedding").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    rows = rows.where(F.size("embedding") == (most.length if most else 0))
    return rows.select("vec_id", on_grid.alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """The lists of a batch as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def gram(z: np.ndarray) -> np.ndarray:
    """The sum of the outer products of the rows of ``z``, in Python's numbers: exact."""
    peak = int(np.abs(z).max())
    if peak * peak * len(z) < EXACT:
        real = z.astype(float)
        return (real.T @ real).astype(np.int64).astype(object)
    whole = z.astype(object)
    return whole.T @ whole


def _added(rows: DataFrame, sums, kind: str = "decimal(38,0)") -> dict[int, Decimal | float]:
    """The arrays that ``sums`` makes of the ``x`` of each batch, added up over all rows, by position."""
    exactly = kind != "double"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = sums(matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            values = [Decimal(int(v)) for v in total] if exactly else total.tolist()
            arrow = pa.decimal128(38, 0) if exactly else pa.float64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(values)), pa.int32()), pa.array(values, arrow)], ["at", "value"]
            )

    parts = rows.select("x").mapInArrow(add, f"at int, value {kind}")
    return {r["at"]: r["value"] for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect()}


def fit_whitening(fit: DataFrame, components: int = 16) -> Whitening | None:
    """The leading components of ``fit`` (``x``, each vector once); none if it is empty."""

    def sums(x: np.ndarray) -> np.ndarray:
        return np.array([len(x), *x.astype(object).sum(axis=0)], dtype=object)

    found = _added(fit, sums)
    if not found:
        return None
    n, total = int(found[0]), tuple(int(found[i]) for i in range(1, len(found)))
    plain = Whitening(n, total, np.empty(0), np.empty((len(total), 0)), 0.0)
    centre, rest = plain.centre, [int(r) for r in plain.rest]
    upper = np.triu_indices(len(total))
    products = _added(fit, lambda x: gram(x - centre)[upper])
    covariance = np.empty((len(total), len(total)))
    for at, (i, j) in enumerate(zip(*upper, strict=True)):
        exactly = n * int(products[at]) - rest[i] * rest[j]
        covariance[i, j] = covariance[j, i] = exactly / (n * n)
    trace = float(np.trace(covariance))
    values, vectors = leading(covariance, min(components, len(total)))
    varied = values > len(total) * EPS * max(values[0], 0.0)
    return Whitening(n, total, values[varied], vectors[:, varied], trace)


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix by dynamically weighted Halley iterations."""
    size = len(a)
    x = a / np.linalg.norm(a)
    r = np.linalg.qr(x, mode="r")
    try:
        low = 1 / (np.linalg.norm(np.linalg.inv(r), 1) * np.sqrt(size))
    except np.linalg.LinAlgError:
        low = EPS
    low = min(max(low, EPS / size), 1.0)
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + d)
        a_ = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        b = (a_ - 1) ** 2 / 4
        c = a_ + b - 1
        q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(size)]))[0]
        new = b / c * x + (a_ - b / c) / np.sqrt(c) * q[:size] @ q[size:].T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (a_ + b * square) / (1 + c * square))
        if 1 - low < 10 * EPS and moved < np.cbrt(EPS):
            break
    return x


def halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of ``a``, that of the greater eigenvalues first; none
    if ``a`` is a multiple of the identity as far as numbers tell.

    Any shift between the least and the greatest entry of the diagonal has eigenvalues on both sides. One
    that hits an eigenvalue gives no projector; the next is tried, and the best one taken.
    """
    size, diagonal = len(a), np.diag(a)
    scale = np.linalg.norm(a)
    mean, median = diagonal.mean(), float(np.median(diagonal))
    if np.linalg.norm(a - mean * np.eye(size)) <= size * EPS * scale:
        return None
    spread = max(np.ptp(diagonal), np.linalg.norm(a - mean * np.eye(size)) / size)
    best, least = None, np.inf
    for shift in (median, mean, *(mean + spread * f for f in (0.013, -0.017, 0.11, -0.13, 0.29, -0.31))):
        projector = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < size:
            continue
        basis = np.linalg.qr(projector @ np.random.default_rng(rank).standard_normal((size, rank)))[0]
        basis = np.linalg.qr(projector @ basis)[0]
        whole = np.linalg.qr(basis, mode="complete")[0]
        upper, lower = whole[:, :rank], whole[:, rank:]
        left = np.linalg.norm(lower.T @ a @ upper)
        if left < least:
            best, least = (upper, lower), left
        if left <= 10 * size * EPS * scale:
            break
    return best


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues of a symmetric matrix, falling, and their vectors as columns."""
    if wanted <= 0:
        return np.empty(0), np.empty((len(a), 0))
    cut = halves(a) if len(a) > 1 else None
    if cut is None:
        order = np.argsort(-np.diag(a), kind="stable")[:wanted]
        return np.diag(a)[order], np.eye(len(a))[:, order]
    values, vectors = [], []
    for basis in cut:
        inner = basis.T @ a @ basis
        some, inside = leading((inner + inner.T) / 2, min(wanted - sum(map(len, values)), len(inner)))
        values.append(some)
        vectors.append(basis @ inside)
    value, vector = np.concatenate(values), np.hstack(vectors)
    vector = vector * np.sign(vector[np.abs(vector).argmax(axis=0), range(vector.shape[1])])
    order = np.argsort(-value, kind="stable")
    return value[order], vector[:, order]


def projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    centred = (x - model.centre).astype(float) - model.rest.astype(float) / model.n
    return centred @ (model.vectors / np.sqrt(model.values))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry, by size, of the covariance of the whitened ``fit`` less the identity."""
    size = len(model.values)

    def sums(x: np.ndarray) -> np.ndarray:
        w = projected(x, model)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    found = _added(fit, sums, "double")
    total = np.array([found[i] for i in range(size + size * size)])
    mean, products = total[:size] / model.n, total[size:].reshape(size, size) / model.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(size)).max())


def deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """For each row the sum of the squares of ``n * x`` less the sums: exact."""
    z, rest = x - model.centre, model.rest
    peak = model.n * int(np.abs(z).max()) + int(np.abs(rest).max())
    if peak * peak * z.shape[1] >= 2**63:
        z, rest = z.astype(object), rest.astype(object)
    apart = model.n * z - rest
    return (apart * apart).sum(axis=1).tolist()


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened`` (an array, by component) of the grid vectors ``rows``."""
    schema = T.StructType(
        [
            rows.schema["vec_id"],
            *T.StructType.fromDDL("deviation bigint, whitened array<double>").fields,
        ]
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1))
                arrays = [
                    batch.column(0),
                    pa.array(deviations(x, model), pa.int64()),
                    pa.array(list(projected(x, model)), pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.mapInArrow(project, schema)


def whitened_components(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every usable row of
    ``embeddings`` and each of its leading components."""
    rows = written(grid_vectors(embeddings), "grid-vectors")
    fit = written(rows.select("x").distinct(), "fit-vectors")
    model = fit_whitening(fit, components)
    if model is None or not len(model.values):
        n, shares, error = 0, F.array().cast("array<double>"), 0.0
        found = rows.where("false").select(
            "vec_id", F.lit(0).cast("long").alias("deviation"), shares.alias("whitened")
        )
    else:
        n, error = model.n, identity_error(fit, model)
        shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
        found = whiten(rows, model)
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
