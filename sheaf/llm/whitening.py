"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then
one-sided Jacobi on the triangular factor.

Entries are put on an integer grid, x = floor(scale * c) + offset, and every
sum that decides the model is an exact integer. Each distinct x vector is
fitted once. Three passes over the distinct vectors:

1. count and sums per dimension;
2. the scatter of x centred at the integers nearest to the means; what is
   left of the mean, under half a unit, comes off in integers as well, so
   the covariance V is exact before it becomes a double;
3. the covariance of the whitened vectors, which must be the identity.

The model is made of a d x d matrix only. V = (P L)(P L)' by Cholesky with
the largest remaining diagonal as pivot, until what remains is rounding; the
columns of P L are rotated in pairs until all are orthogonal (Jacobi, no
L'L is ever formed, so small eigenvalues keep their digits). Squared column
norms are the eigenvalues, normalised columns the components.

Spark does the work that grows: vectors become rows of packed integers,
equal ones meet in a partial aggregate, each task returns sums for its rows
and at most d(d+1)/2 of them. Nothing but d sums and the matrix comes to the
driver; the model goes out in the tasks' closure (d x k doubles).

Defined cases: rows whose vector is NULL, empty, or holds a NULL, NaN or
infinite entry are left out, as are those whose length is not the commonest
(the longer on a tie) and those with an entry so large that x leaves 62
bits. Repeated rows are fitted once and each gets its results; NULL ids are
kept. Directions without variance have no component, so fewer than k may
come back, and none for a table of one distinct vector. Eigenvalues that tie
share a space in which any basis is right; the same one serves all rows. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named
from .components import written

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
_EXACT = 1 << 53  # integers up to here are exact in a double
_SAFE = 1 << 20  # entries up to here keep all sums below in 64 bits
BLOCK_BYTES = 4 << 20  # of a batch are held as numbers at a time


@dataclass(frozen=True)
class Whitening:
    """n fitted vectors of ``dim`` entries with sums S = n * centre + rest;
    ``components`` (k x d), ``eigenvalues`` and ``explained`` by falling
    eigenvalue."""

    dim: int
    n: int
    centre: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = max(1, batch.num_rows * BLOCK_BYTES // max(1, batch.nbytes))
        for k in range(0, batch.num_rows, step):
            yield batch.slice(k, step)


def _pack(x: np.ndarray) -> list[bytes]:
    """Rows of integers as bytes, the same bytes for the same integers: one
    byte that gives the width, then 4 or 8 bytes an entry."""
    narrow = (np.abs(x) < 1 << 31).all(axis=1)
    return [b"\x04" + r.astype("<i4").tobytes() if s else b"\x08" + r.astype("<i8").tobytes() for r, s in zip(x, narrow)]


def _unpack(col: pa.Array) -> np.ndarray:
    rows = [v.as_buffer() for v in col]
    return np.stack([np.frombuffer(b, dtype="<i4" if b[0:1].to_pybytes() == b"\x04" else "<i8", offset=1).astype(np.int64) for b in rows])


def _quantise(scale: int, offset: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            vec = batch.column("v")
            size = np.asarray(pc.fill_null(pc.list_value_length(vec), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            flat = vec.flatten().cast(pa.float64())
            values = flat.to_numpy(zero_copy_only=False)  # NULL entries as NaN
            first = np.concatenate([[0], np.cumsum(size)])
            fits = np.isfinite(values) & (np.abs(values) < float(1 << 62) / scale)
            good = np.concatenate([[0], np.cumsum(fits)])
            keep = (size > 0) & (good[first[1:]] - good[first[:-1]] == size)
            for d in np.unique(size[keep]):
                rows = np.flatnonzero(keep & (size == d))
                x = np.floor(values[first[rows][:, None] + np.arange(d)] * scale).astype(np.int64) + offset
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)).cast(kind), pa.array(np.full(len(rows), d, dtype=np.int32)), pa.array(_pack(x), pa.binary())],
                    names=["vec_id", "d", "x"],
                )

    return run


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, d (length) and x (packed integers) of every usable row."""
    rows = vectors.select(named(vec_id).alias("vec_id"), named(embedding).cast("array<double>").alias("v"))
    kind = dict(rows.dtypes)["vec_id"]
    from pyspark.sql.pandas.types import to_arrow_type

    return rows.mapInArrow(_quantise(scale, offset, to_arrow_type(rows.schema["vec_id"].dataType)), f"vec_id {kind}, d int, x binary")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in _blocks(batches):
        x = _unpack(batch.column("x"))
        wide = int(np.abs(x).max()) * len(x) >= 1 << 62
        here = x.astype(object).sum(axis=0) if wide else x.sum(axis=0).astype(object)
        total = here if total is None else total + here
        n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array([str(int(v)) for v in total]), pa.array([n] * len(total), pa.int64())], names=["i", "s", "n"])


def _scatter(centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _blocks(batches):
            y = _unpack(batch.column("x")) - centre
            most = int(np.abs(y).max())
            if most * most >= _EXACT:
                here = y.astype(object).T @ y.astype(object)
            else:
                block = max(1, _EXACT // max(1, most * most))
                here = sum((y[k : k + block].astype(float).T @ y[k : k + block].astype(float)).astype(np.int64).astype(object) for k in range(0, len(y), block))
            total = here if total is None else total + here
        if total is not None:
            i, j = np.triu_indices(len(centre))
            for k in range(0, len(i), 65536):
                a, b = i[k : k + 65536], j[k : k + 65536]
                yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array([str(int(v)) for v in total[a, b]])], names=["i", "j", "s"])

    return run


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """F with v = F F': the triangular factor with its rows back in place,
    one column for every pivot that is more than rounding."""
    d = len(v)
    rest, out = v.copy(), []
    limit = d * np.finfo(float).eps * max(float(np.diag(v).max(initial=0.0)), 0.0)
    left = np.ones(d, dtype=bool)
    for _ in range(d):
        diagonal = np.where(left, np.diag(rest), -np.inf)
        p = int(diagonal.argmax())
        if not diagonal[p] > limit:
            break
        column = np.where(left, rest[:, p], 0.0) / np.sqrt(diagonal[p])
        left[p] = False
        rest -= np.outer(column, column)
        out.append(column)
    return np.stack(out, axis=1) if out else np.zeros((d, 0))


def jacobi_columns(f: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``f`` rotated in pairs until all are orthogonal. In a
    round every column is in one pair; after r - 1 rounds all have met."""
    f = f.copy()
    r = f.shape[1]
    if r < 2:
        return f
    ring = list(range(r)) + ([-1] if r % 2 else [])
    tol = f.shape[0] * np.finfo(float).eps
    for _ in range(sweeps):
        rotated = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(a, b) for a, b in zip(ring[:half], ring[: half - 1 : -1]) if a >= 0 and b >= 0]
            a, b = (np.array(c) for c in zip(*pairs))
            x, y = f[:, a], f[:, b]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(xy) > tol * np.sqrt(xx * yy)
            if turn.any():
                rotated = True
                zeta = (yy - xx) / (2 * np.where(turn, xy, 1.0))
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                c, s = np.where(turn, c, 1.0), np.where(turn, c * t, 0.0)
                f[:, a], f[:, b] = c * x - s * y, s * x + c * y
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if not rotated:
            break
    return f


def solve(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; components as rows) of a covariance, those
    with variance only."""
    f = jacobi_columns(pivoted_cholesky(v))
    norms = np.sqrt((f * f).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, (f[:, order] / norms[order]).T


def distinct_vectors(x: DataFrame) -> DataFrame:
    """The fit list, written once: x of each distinct vector of the
    commonest length, and d."""
    rows = written(x.groupBy("d", "x").agg(F.count("*").alias("n")), "whitening-distinct")
    most = rows.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.filter(F.col("d") == (most["d"] if most else 0)).select("d", "x")


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The model of a fit list; None if it is empty."""
    sums = distinct.select("x").mapInArrow(_sums, "i int, s string, n long")
    rows = sums.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("i").collect()
    if not rows:
        return None
    n, total = rows[0]["n"], [int(r["s"]) for r in rows]
    centre = [(2 * s + n) // (2 * n) for s in total]
    rest = np.array([s - n * c for s, c in zip(total, centre)], dtype=object)
    parts = distinct.select("x").mapInArrow(_scatter(np.array(centre, dtype=np.int64)), "i int, j int, s string")
    v = np.zeros((len(rows), len(rows)))
    for r in parts.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).toLocalIterator():
        v[r["i"], r["j"]] = v[r["j"], r["i"]] = (n * int(r["s"]) - rest[r["i"]] * rest[r["j"]]) / n**2
    eigenvalues, vectors = solve(v)
    trace = float(np.trace(v))
    k = min(components, len(eigenvalues))
    return Whitening(len(rows), n, np.array(centre, dtype=np.int64), rest, vectors[:k], eigenvalues[:k], eigenvalues[:k] / trace if k else eigenvalues[:0])


def _project(model: Whitening):
    mean_rest = (model.rest / model.n).astype(float)
    matrix = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    return lambda y: (y.astype(float) - mean_rest) @ matrix


def _transform(model: Whitening, kind: pa.DataType):
    project = _project(model)
    n, rest = model.n, model.rest
    rest2 = int((rest * rest).sum()) if len(rest) else 0
    small_rest = all(abs(int(r)) < 1 << 40 for r in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            batch = batch.filter(pc.equal(batch.column("d"), model.dim))
            if not batch.num_rows:
                continue
            y = _unpack(batch.column("x")) - model.centre
            # sum of (n*y - rest)^2, in Python integers where 64 bits are not enough
            most = int(np.abs(y).max())
            if most < _SAFE and small_rest and most * model.dim * max([1, *(abs(int(r)) for r in rest)]) < 1 << 62:
                yy, yr = (y * y).sum(axis=1), (y * rest.astype(np.int64)).sum(axis=1)
            else:
                wide = y.astype(object)
                yy, yr = (wide * wide).sum(axis=1), (wide * rest).sum(axis=1)
            deviation = [str(n * n * int(a) - 2 * n * int(b) + rest2) for a, b in zip(yy, yr)]
            z = project(y)
            offsets = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").cast(kind), pa.array(deviation), pa.ListArray.from_arrays(pa.array(offsets), pa.array(z.ravel()))],
                names=["vec_id", "deviation", "whitened"],
            )

    return run


def transform(x: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (the squared distance of x from the mean, times n
    squared, exact, as decimal digits) and whitened (array) of every row."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = dict(x.dtypes)["vec_id"]
    return x.mapInArrow(_transform(model, to_arrow_type(x.schema["vec_id"].dataType)), f"vec_id {kind}, deviation string, whitened array<double>")


def _moments(model: Whitening, centre: np.ndarray | None):
    project = _project(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in _blocks(batches):
            z = project(_unpack(batch.column("x")) - model.centre)
            total = total + (z.sum(axis=0) if centre is None else (z - centre).T @ (z - centre))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["i", "s"])

    return run


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance
    minus the identity: measured on the vectors, centred first."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def sums(centre):
        rows = distinct.select("x").mapInArrow(_moments(model, centre), "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()
        return np.array([r["s"] for r in rows]) / model.n

    return float(np.abs(sums(sums(None)).reshape(k, k) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """The query: one row for every usable vector and component. A deviation
    beyond 64 bits is NULL in ``deviation`` and whole in ``deviation_digits``."""
    x = quantised(vectors)
    distinct = distinct_vectors(x)
    model = fit(distinct, components)
    kind = dict(x.dtypes)["vec_id"]
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_digits string")
    error = identity_error(distinct, model)
    per = F.array(*[F.lit(float(e)) for e in model.explained])
    rows = transform(x, model).select("vec_id", "deviation", F.posexplode("whitened").alias("_k", "whitened"))
    return rows.select(
        "vec_id", (F.col("_k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        "whitened", F.element_at(per, F.col("_k") + 1).alias("explained"), F.lit(error).alias("identity_error"), F.col("deviation").alias("deviation_digits"),
    )
