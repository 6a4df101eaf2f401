"""Whitening of embeddings on the leading principal components.

Components become integers, so that counts, sums and centred squares are exact. Vectors with
equal integers count once in the fit: sums and the covariance run over a table of distinct
vectors, in partial sums of one matrix a task. The eigenpairs of the covariance come from
``feast``; rows are projected where they stand, without a shuffle.

Defined cases: rows whose vector is null or holds a null, NaN or infinite component are left
out; the others stay, once for each row, with null or repeated ids as they are. Vectors of
different lengths are fits of their own, and an empty vector has no component. Components
whose eigenvalue is zero up to rounding cannot be scaled and are left out; so one distinct
vector alone, or an empty table, gives no rows. Columns other than the two named are not
read. Components are exact integers up to 2^53 in size.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import runtime
from eventmart.llm import feast
from eventmart.llm.vectors import matrix, scaled, usable

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Rows of a batch that are multiplied at once.
ROWS = 4096


def _per_dims(batches, dims_of):
    """(dims, rows of vectors) of each batch; a batch may hold several lengths."""
    for batch in batches:
        lengths = dims_of(batch).to_numpy(zero_copy_only=False)
        for dims in np.unique(lengths):
            at = np.flatnonzero(lengths == dims)
            yield int(dims), batch.take(pa.array(at))


def _sums(total, dims_of):
    """One row (dims, place, value) for each entry of the summed arrays of a task.

    ``total(dims, x)`` is the array that rows ``x`` add; sums keep its number type.
    """

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for dims, rows in _per_dims(batches, dims_of):
            for a in range(0, rows.num_rows, ROWS):
                part = total(dims, matrix(rows.column("x").slice(a, ROWS), dims))
                held[dims] = held[dims] + part if dims in held else part
        for dims, value in held.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "dims": np.full(value.size, dims, np.int32),
                    "place": np.arange(value.size, dtype=np.int32),
                    "value": value.ravel(),
                }
            )

    return run


def _summed(vectors: DataFrame, total, kind: str) -> dict[int, np.ndarray]:
    """``total`` summed over all rows, by dimension; only these arrays reach the driver."""
    sums = _sums(total, lambda b: b.column("dims"))
    parts = vectors.mapInArrow(sums, f"dims int, place int, value {kind}")
    rows = parts.groupBy("dims", "place").agg(F.sum("value").alias("value")).toArrow()
    dims, place = (rows.column(c).to_numpy() for c in ("dims", "place"))
    value = rows.column("value").to_numpy()
    out = {}
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        out[int(d)] = value[at[np.argsort(place[at])]]
    return out


class Fit:
    """Count, sums, eigenvalues and components of the vectors of one length."""

    def __init__(self, n: int, sums: np.ndarray):
        self.n, self.sums = n, sums
        whole = [divmod(int(s), n) for s in sums]
        # the mean in two parts, so that centring loses nothing to its size
        self.base = np.array([q for q, _ in whole], np.int64)
        self.rest = np.array([r / n for _, r in whole])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest

    def eigen(self, covariance: np.ndarray, most: int) -> None:
        self.values, self.vectors = feast.leading(covariance, most)
        self.trace = float(np.trace(covariance))
        self.identity_error = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, in whole numbers of any size."""
        off = x - self.base
        rest = np.array([int(s) for s in self.sums - self.n * self.base], object)
        bound = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if bound * bound * x.shape[1] < 1 << 63:
            small = off * self.n - rest.astype(np.int64)
            return (small * small).sum(axis=1).tolist()
        large = off.astype(object) * self.n - rest
        return (large * large).sum(axis=1).tolist()


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """One ``Fit`` for each length among the written rows (dims, x), each counted once."""

    def plain(dims, x):
        return np.append(x.sum(axis=0), len(x))

    def outer(dims, x):
        d = fits[dims].centred(x)
        return d.T @ d

    def unit(dims, x):
        f = fits[dims]
        w = f.whitened(x)
        return w.T @ w

    fits = {d: Fit(int(s[-1]), s[:-1]) for d, s in _summed(distinct, plain, "bigint").items()}
    for dims, sums in _summed(distinct, outer, "double").items():
        fits[dims].eigen(sums.reshape(dims, dims) / fits[dims].n, components)
    for dims, sums in _summed(distinct, unit, "double").items():
        k = len(fits[dims].values)
        error = np.abs(sums.reshape(k, k) / fits[dims].n - np.eye(k)).max(initial=0.0)
        fits[dims].identity_error = float(error)
    return fits


def whiten(
    vectors: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """One row for each usable row of ``vectors`` and component, by falling eigenvalue.

    Columns: vec_id, component (from 1), n (distinct vectors), deviation (decimal, sum of
    (n x - S)^2), whitened, explained (eigenvalue / trace) and identity_error.
    """
    rows = vectors.where(usable(vector)).select(
        F.col(vec_id).alias("vec_id"), scaled(vector, scale, shift).alias("x")
    )
    rows = rows.where(F.size("x") > 0).withColumn("dims", F.size("x"))
    distinct = runtime.written(rows.select("dims", "x").distinct(), "whitening-distinct")
    fits = fit(distinct, components)

    def project(batches):
        for dims, batch in _per_dims(batches, lambda b: b.column("dims")):
            f = fits[dims]
            k = len(f.values)
            for a in range(0, batch.num_rows if k else 0, ROWS):
                part = batch.slice(a, ROWS)
                x = matrix(part.column("x"), dims)
                m = len(x)
                ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
                deviation = [Decimal(v) for v in f.deviations(x)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": ids,
                        "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                        "n": np.full(m * k, f.n, np.int64),
                        "deviation": pa.array(deviation, pa.decimal128(38, 0)).take(
                            pa.array(np.repeat(np.arange(m), k))
                        ),
                        "whitened": f.whitened(x).ravel(),
                        "explained": np.tile(f.values / f.trace, m),
                        "identity_error": np.full(m * k, f.identity_error),
                    }
                )

    id_type = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(
        project,
        f"vec_id {id_type}, component int, n bigint, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double",
    )
