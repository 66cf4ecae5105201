"""Embedding whitening by shifted CholeskyQR.

The fit list (each distinct vector once) is a tall matrix ``Y`` of centred rows.  One pass over it
sums a Gram matrix; its Cholesky factor turns the rows into nearly orthonormal ones (``Q = Y / R``,
a triangular solve per row, done anew in each pass and never stored), and the next pass repeats that
on ``Q``.  The first factor is taken of the Gram matrix plus a shift, so it exists however badly
conditioned ``Y`` is; later passes need none.  When ``Q`` is orthonormal the factors are multiplied
to one ``R`` with ``Y = QR``, and the singular values and right singular vectors of this small ``R``
are those of ``Y``: the eigenvectors of the covariance and, squared over ``n``, its eigenvalues.
Squaring ``Y`` in one step would lose small eigenvalues; the passes do not.

Vectors are fixed-point integers (``fixed_point``), so sums and deviations are exact, and rows are
centred by the integer part of the mean before anything is rounded.  What reaches the driver is
``d (d + 1) / 2`` sums for vectors of ``d`` entries, whatever the number of rows.

Defined results: rows whose vector is null, empty or holds null, non-finite or over-large entries
(``2**56``: their fixed-point form is no long) are left out.  The dimension is the most common
length in the fit list (ties: the longest); rows of other lengths are left out.  Repeated vectors
count once in the fit and get a result on every row.  Components of no variance (constant or
linearly dependent entries; a fit list of one vector; an empty table) have no rows.  Only the
named columns are read, so other columns may bear any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c

# Entries at or beyond this have no fixed-point form in a long.
TOO_LARGE = float(2**56)
# Passes end when the rows are this close to orthonormal, at the latest after MOST_PASSES.
ORTHONORMAL, MOST_PASSES = 1e-10, 6
# Directions below these parts of the largest (of a Gram matrix, of singular values) are rounding.
NULL_GRAM, NULL_VALUE = 1e-12, 1e-10


@dataclass(frozen=True)
class Whitening:
    """``n`` fit vectors with sums ``total`` per entry; ``vectors`` (one column per component, by
    falling ``values``), the covariance's ``trace``, and the passes it took."""

    n: int
    total: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int

    @property
    def dim(self) -> int:
        return len(self.total)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.total)

    def project(self, x: np.ndarray, components: int) -> np.ndarray:
        return self.centred(x) @ (self.vectors[:, :components] / np.sqrt(self.values[:components]))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over entries of ``(n*x - total)**2``, exact; null where that is no long."""
        low, rest = _mean_parts(self.n, self.total)
        off = x - low
        bound = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if self.dim * bound * bound < 1 << 63:
            d = self.n * off - rest
            return (d * d).sum(axis=1).tolist()
        d = self.n * off.astype(object) - rest.astype(object)
        return [s if s < 1 << 63 else None for s in (d * d).sum(axis=1)]


def _mean_parts(n: int, total: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as its integer part and the ``n``-ths beyond it."""
    return np.array([t // n for t in total], dtype=np.int64), np.array([t % n for t in total], dtype=np.int64)


def _centred(x: np.ndarray, n: int, total: tuple[int, ...]) -> np.ndarray:
    low, rest = _mean_parts(n, total)
    return (x - low).astype(np.float64) - rest / n


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows / r`` for an upper triangular ``r``, column by column."""
    q = np.asfortranarray(rows)
    for j in range(r.shape[0]):
        if j:
            q[:, j] -= q[:, :j] @ r[:j, j]
        q[:, j] /= r[j, j]
    return q


def fixed_point(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64,
                offset: int = 1_000_000) -> DataFrame:
    """``_id`` and ``_x``, the usable vectors as longs ``floor(scale * entry) + offset``."""
    whole = F.forall("_v", lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < TOO_LARGE / max(1, scale / 64)), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    return rows.filter((F.size("_v") > 0) & whole).select("_id", F.transform("_v", lambda v: F.floor(v * scale) + offset).alias("_x"))


def _sums(dim: int):
    """Per task: rows seen and the sums of the high and low halves of every entry (no overflow)."""

    def run(batches):
        n, high, low = 0, np.zeros(dim, dtype=np.int64), np.zeros(dim, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column("_x"), dim)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, n)), pa.array(high), pa.array(low)],
                                             names=["i", "n", "high", "low"])

    return run


def _gram(dim: int, n: int, total: tuple[int, ...], factors: list[np.ndarray], last: np.ndarray | None = None):
    """Per task: the upper half of the Gram matrix of the centred rows after all solves (and, with
    ``last``, after that projection and with a column of ones)."""

    def run(batches):
        g = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _centred(_matrix(batch.column("_x"), dim), n, total)
            for r in factors:
                rows = _solve(rows, r)
            if last is not None:
                rows = np.column_stack([rows @ last, np.ones(len(rows))])
            g = rows.T @ rows + (0 if g is None else g)
        if g is not None:
            i, j = np.triu_indices(len(g))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(g[i, j])], names=["i", "j", "v"])

    return run


def _gram_of(fit_rows: DataFrame, size: int, *args) -> np.ndarray:
    parts = fit_rows.mapInArrow(_gram(*args), "i int, j int, v double")
    g = np.zeros((size, size))
    i, j, v = (x.to_numpy() for x in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow().columns)
    g[i, j] = g[j, i] = v
    return g


def fit(rows: DataFrame) -> tuple[Whitening | None, DataFrame]:
    """The whitening of ``rows`` (``_x``), and its fit list; None where there is no row."""
    unique = c.stage(rows.select("_x").distinct(), "whitening-fit")
    lengths = unique.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return None, unique
    dim = lengths["d"]
    unique = unique.filter(F.size("_x") == dim)
    sums = unique.mapInArrow(_sums(dim), "i int, n long, high long, low long").groupBy("i").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(x).cast("decimal(28,0)")).alias(x) for x in ("high", "low")]).orderBy("i").collect()
    n, total = sums[0]["n"], tuple((int(s["high"]) << 32) + int(s["low"]) for s in sums)
    factors: list[np.ndarray] = []
    while True:
        gram = _gram_of(unique, dim, dim, n, total, factors)
        if not factors:
            square = float(np.trace(gram))
        values, axes = np.linalg.eigh(gram)
        live = values > NULL_GRAM * max(values.max(), np.finfo(float).tiny)
        if square == 0 or (factors and (np.abs(values[live] - 1).max() <= ORTHONORMAL or len(factors) == MOST_PASSES)):
            break
        if not factors:
            gram += 11 * (n * dim + dim * (dim + 1)) * np.finfo(float).eps / 2 * values.max() * np.eye(dim)
        else:
            # Directions without variance hold rounding alone: they are left at their size.
            gram += axes[:, ~live] @ axes[:, ~live].T
        factors.append(np.linalg.cholesky(gram).T)
    r = np.sqrt(np.maximum(values, 0))[:, None] * axes.T
    for factor in reversed(factors):
        r = r @ factor
    _, sizes, vectors = np.linalg.svd(r)
    kept = (sizes > NULL_VALUE * sizes[0]) & (sizes > 0)
    return Whitening(n, total, sizes[kept] ** 2 / n, vectors[kept].T, float((sizes**2).sum() / n), len(factors) + 1), unique


def identity_error(unique: DataFrame, model: Whitening, components: int) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = min(components, len(model.values))
    last = model.vectors[:, :k] / np.sqrt(model.values[:k])
    g = _gram_of(unique, k + 1, model.dim, model.n, model.total, [], last)
    mean = g[k, :k] / model.n
    return float(np.abs(g[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _whiten(model: Whitening, k: int):
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("_x"), model.dim)
            rows = len(x)
            again = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pa.array(again)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(model.deviation(x), pa.int64()).take(pa.array(again)), pa.array(model.project(x, k).ravel())],
                names=["_id", "component", "deviation", "whitened"])

    return run


def whiten(rows: DataFrame, model: Whitening | None, components: int = 16, id_col: str = "vec_id") -> DataFrame:
    """One row per row of ``rows`` (``_id``, ``_x``) and component: id, ``component`` (from 1),
    ``n``, ``deviation``, ``whitened`` and ``explained`` (share of the variance)."""
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, component int, deviation long, whitened double"
    k = min(components, len(model.values)) if model else 0
    if k:
        out = rows.filter(F.size("_x") == model.dim).mapInArrow(_whiten(model, k), schema)
        share = F.array(*[F.lit(float(v / model.trace)) for v in model.values[:k]])
        explained, n = F.get(share, F.col("component") - 1), F.lit(model.n).cast("long")
    else:
        out, explained, n = rows.sparkSession.createDataFrame([], schema), F.lit(None).cast("double"), F.lit(None).cast("long")
    return out.select(F.col("_id").alias(id_col), "component", n.alias("n"), "deviation", "whitened", explained.alias("explained"))


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings`` on the first 16 whitening components."""
    rows = fixed_point(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    model, unique = fit(rows)
    error = identity_error(unique, model, 16) if model and len(model.values) else None
    return whiten(rows, model).withColumn("identity_error", F.lit(error).cast("double"))
