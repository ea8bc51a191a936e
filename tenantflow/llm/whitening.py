"""Whitening of vectors by the leading eigenvectors of their distributed covariance.

1. The fit list holds each distinct whole-number vector once. Its size and sums are exact.
2. The covariance is added up by task from centred vectors and reduced by element; what
   reaches the driver is one matrix, whose size follows the length of the vectors only.
3. Eigenvectors are found in single precision and corrected by the matrix products of Ogita
   and Aishima in extended precision: an error shrinks to about its square in each round.
   Eigenvalues closer than the round can tell apart are left together; each such cluster is
   then solved as a small problem of its own, with the cluster's middle taken off, and the
   rounds go on.
4. Rows are projected on the components and divided by the root of the eigenvalue. The
   covariance of these values over the fit list is measured once more and compared with the
   identity.

Rows: one for each usable row and component. Null vectors and vectors with null or non-finite
components have none. Equal rows, and rows with null or repeated ids, have rows of their own.
Vectors of different lengths are fitted and whitened apart. A vector of fewer components has
fewer rows, an empty one none. Where the eigenvalue is not above the rounding errors of the
largest one (equal rows, constant dimensions, a single row), ``whitened`` is null and the
component takes no part in ``identity_error``; ``explained`` is null if there is no variance
at all. A ``deviation`` outside long is null. Other columns are ignored.
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
from pyspark.sql.pandas.types import to_arrow_schema

from tenantflow.llm.inputs import record_batch
from tenantflow.llm.vector_tiles import matrix, whole_vectors
from tenantflow.session import staged

_ROUNDS = 30
_LONG = (1 << 63) - 1
#: Of the largest eigenvalue; less is rounding.
_NO_VARIANCE = 1e-12


def _spectral(m: np.ndarray) -> float:
    return float(np.linalg.norm(m.astype(np.float64), 2)) if m.size else 0.0


def _clusters(values: np.ndarray, least_gap: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other within ``least_gap``, two at least."""
    order = np.argsort(values)
    ends = np.flatnonzero(np.diff(values[order]) > least_gap) + 1
    return [c for c in np.split(order, ends) if len(c) > 1]


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Columns that are nearly orthonormal, made so; each round squares what is missing."""
    one = np.eye(x.shape[1], dtype=x.dtype)
    for _ in range(8):
        r = one - x.T @ x
        x = x + x @ r / 2
        if _spectral(r) < 1e-10:
            break
    return x


def refined_eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of a symmetric matrix."""
    scale = float(np.abs(a).max()) if a.size else 0.0
    if scale == 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a.astype(np.longdouble) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    norm, one = _spectral(a), np.eye(len(a), dtype=np.longdouble)
    #: Eigenvalues closer than this are equal in double precision: any basis of theirs is right.
    equal = len(a) * np.finfo(np.float64).eps * norm
    solved: set[tuple[int, ...]] = set()
    before = np.inf
    for _ in range(_ROUNDS):
        r = one - x.T @ x
        s = x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        least_gap = 2 * (_spectral(s - np.diag(values)) + norm * _spectral(r))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > max(least_gap, equal)
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = _orthonormal(x + x @ e)
        size = _spectral(e)
        if size > before / 2 or size < 1e-17:
            # Nothing more to gain this way: what stays together is solved on its own.
            again = False
            for cluster in _clusters(values, least_gap):
                if tuple(cluster) in solved:
                    continue
                solved.add(tuple(cluster))
                own = x[:, cluster]
                shifted = own.T @ (a - values[cluster].mean() * one) @ own
                unit = max(float(np.abs(shifted).max()), np.finfo(np.float64).tiny)
                turned = np.linalg.eigh(((shifted + shifted.T) / (2 * unit)).astype(np.float64))[1]
                x[:, cluster] = own @ turned.astype(np.longdouble)
                again = True
            if not again:
                break
            size = np.inf
        before = size
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(np.float64), x[:, order].astype(np.float64)


@dataclass(frozen=True)
class Whitening:
    """What was fitted to the vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: in long if all fits, else as Python's whole numbers."""
        most = max(int(np.abs(x.astype(np.float64)).max()), 1) * self.n + max(map(abs, self.sums))
        if most < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def squares(self, deviations: np.ndarray) -> list[int | None]:
        """The sum of squares of each row; None outside long."""
        if float(np.abs(deviations.astype(np.float64)).max()) ** 2 * deviations.shape[1] < 1 << 62:
            return (deviations * deviations).sum(axis=1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in deviations]
        return [v if v <= _LONG else None for v in exact]

    def project(self, deviations: np.ndarray) -> np.ndarray:
        centred = (deviations / self.n).astype(np.float64)
        roots = np.sqrt(np.where(self.varying, self.values, np.inf))
        return centred @ self.components / roots

    @property
    def varying(self) -> np.ndarray:
        return self.values > _NO_VARIANCE * max(self.values.max(initial=0.0), 0.0)


_SUMS = T.StructType(
    [
        T.StructField("dims", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("sums", T.ArrayType(T.DecimalType(38, 0))),
    ]
)
_PRODUCTS = T.StructType(
    [
        T.StructField("dims", T.IntegerType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("products", T.ArrayType(T.DoubleType())),
    ]
)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """The rows of each length in a batch of (dims, x, ...)."""
    lengths = np.asarray(batch.column(0))
    for dims in np.unique(lengths).tolist():
        chosen = batch.filter(pa.array(lengths == dims))
        yield dims, chosen, matrix(chosen.column(1), dims)


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length: the number of vectors and the sum of each dimension."""
    arrow = to_arrow_schema(_SUMS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for dims, _, x in _by_length(batch):
                if float(np.abs(x.astype(np.float64)).max()) * len(x) >= 1 << 62:
                    x = x.astype(object)
                n, total = totals.get(dims, (0, np.zeros(dims, object)))
                totals[dims] = n + len(x), total + x.sum(axis=0).astype(object)
        for dims, (n, total) in totals.items():
            yield record_batch(arrow, [[dims], [n], [[Decimal(int(v)) for v in total]]])

    parts = fit.mapInArrow(add, _SUMS)
    by_place = parts.select("dims", "n", F.posexplode("sums")).groupBy("dims", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("sum"))
    found: dict[int, tuple[int, list[int]]] = {}
    for row in by_place.orderBy("dims", "pos").collect():
        found.setdefault(row.dims, (row.n, []))[1].append(int(row["sum"]))
    return found


def _products(fit: DataFrame, rows_of: dict) -> dict[int, np.ndarray]:
    """Per length: the sum of the outer products of ``rows_of[dims](x)``, which are doubles."""
    arrow = to_arrow_schema(_PRODUCTS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, _, x in _by_length(batch):
                rows = rows_of[dims](x)
                totals[dims] = totals.get(dims, 0) + rows.T @ rows
        for dims, total in totals.items():
            yield record_batch(arrow, [[dims] * len(total), range(len(total)), total.tolist()])

    parts = fit.mapInArrow(add, _PRODUCTS)
    reduced = parts.select("dims", "row", F.posexplode("products")).groupBy("dims", "row", "pos").agg(F.sum("col").alias("sum"))
    found: dict[int, dict] = {}
    for row in reduced.collect():  # the elements of one matrix for each length
        found.setdefault(row.dims, {})[row.row, row.pos] = row["sum"]
    return {
        dims: np.array([[cells[i, j] for j in range(side)] for i in range(side)])
        for dims, cells in found.items()
        for side in [1 + max(i for i, _ in cells)]
    }


def fit_whitening(fit: DataFrame, n_components: int) -> dict[int, Whitening]:
    """The whitening for each length of the distinct vectors (dims, x)."""
    sums = _sums(fit)

    def centred(n: int, total: list[int]):
        means = Whitening(n, total, np.zeros(0), np.zeros((0, 0)), 0.0)
        return lambda x: (means.deviations(x) / n).astype(np.float64)

    products = _products(fit, {dims: centred(n, total) for dims, (n, total) in sums.items()})
    fitted = {}
    for dims, (n, total) in sums.items():
        covariance = products[dims] / n
        values, vectors = refined_eigenvectors((covariance + covariance.T) / 2)
        trace = float(np.trace(covariance))
        fitted[dims] = Whitening(n, total, np.maximum(values[:n_components], 0), vectors[:, :n_components], trace)
    return fitted


def identity_errors(fit: DataFrame, fitted: dict[int, Whitening]) -> dict[int, float | None]:
    """Per length: how far the covariance of the whitened fit list is from the identity."""

    def with_one(w: Whitening):
        # The column of ones gives the means, which are taken off below.
        return lambda x: np.hstack([w.project(w.deviations(x))[:, w.varying], np.ones((len(x), 1))])

    errors: dict[int, float | None] = {}
    for dims, total in _products(fit, {dims: with_one(w) for dims, w in fitted.items()}).items():
        n = fitted[dims].n
        mean = total[:-1, -1] / n
        off = total[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(mean))
        errors[dims] = float(np.abs(off).max()) if off.size else None
    return errors


def whiten(embeddings: DataFrame, n_components: int = 4, scale: int = 256) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    vec_id = embeddings["vec_id"]
    vectors = whole_vectors(embeddings, vec_id.alias("vec_id"), scale=scale).where("dims > 0")
    fit = staged(vectors.select("dims", "x").distinct(), "fit-list")
    fitted = fit_whitening(fit, n_components)
    errors = identity_errors(fit, fitted)
    schema = T.StructType(
        [
            T.StructField("vec_id", embeddings.schema["vec_id"].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, chosen, x in _by_length(batch):
                w = fitted[dims]
                deviations = w.deviations(x)
                squares, whitened = w.squares(deviations), w.project(deviations)
                for k in range(len(w.values)):
                    own = whitened[:, k] if w.varying[k] else [None] * len(x)
                    explained = float(w.values[k]) / w.trace if w.trace > 0 else None
                    constant = [[v] * len(x) for v in (explained, errors[dims])]
                    yield record_batch(arrow, [chosen.column(2), [k + 1] * len(x), [w.n] * len(x), squares, own, *constant])

    return vectors.select("dims", "x", "vec_id").mapInArrow(project, schema)
