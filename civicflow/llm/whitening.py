"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Entries are whole numbers, x = floor(1024 c) + 100000, so sums do not depend
on the order in which executors add them, and a task that runs again gives
the same bits.

* One pass sums x per dimension, exactly.  A second one centres each x at the
  whole number next to the mean and adds up the products, exactly; what the
  mean lies beside that number is put right in whole numbers too.  A task
  sends one row for each pair of dimensions, which Spark adds up: what reaches
  the driver is the scatter, bounded by the dimension and not by the rows.
* The scatter is factored with diagonal pivots, P L L' P'.  Jacobi rotations
  make the columns of the factor orthogonal: their squared norms are the
  eigenvalues, the columns at length one the components.
* A third pass projects each centred vector.  The covariance of the result is
  measured, not assumed.

Cases: rows whose vector is null, empty or holds a null or non-finite entry
are dropped, and so are those with an entry of ``LIMIT`` or more (its x is no
exact double) and those whose length differs from the most frequent one (of
equally frequent lengths the largest counts).  Repeated rows and ids count as
they are; null ids stay.  Directions without spread have no component: a table
of equal vectors, of one row or of none gives no rows.  Equal eigenvalues come
in an arbitrary order, the same for all rows.  Input columns with the names of
result columns are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.llm.stages import shared, written
from civicflow.llm.textmap import BATCH_ROWS, others, quoted

SCALE, SHIFT = 1024, 100_000
# entries below this have an x that a double holds exactly
LIMIT = float(1 << 42)
COMPONENTS = 8
# products and sums of this size and less are exact in a double
_EXACT = 1 << 53
_SWEEPS = 60
_WHOLE = T.DecimalType(38, 0)


@dataclass
class Whitening:
    """Rows, sums and the whole number next to each mean; eigenvalues, falling, and unit components as columns."""

    n: int
    sums: list[int]
    centre: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def rest(self) -> list[int]:
        """n times what the means lie beside the centre."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them finite and below ``LIMIT``."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT)), F.lit(False))


def dimension(vectors: DataFrame) -> int:
    """The most frequent length of column ``v``; 0 without rows."""
    top = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return top[0]["d"] if top else 0


def _lattice(column: pa.Array, d: int) -> np.ndarray:
    """The x-vectors of a batch, whose lists all hold ``d`` entries."""
    values = np.asarray(column.flatten(), np.float64).reshape(len(column), d)
    return np.floor(values * SCALE).astype(np.int64) + SHIFT


def _gram(v: np.ndarray) -> list[int]:
    """The products v'v above and on the diagonal as whole numbers."""
    top = int(np.abs(v).max(initial=0))
    at = np.triu_indices(v.shape[1])
    if top * top * len(v) < _EXACT:
        # every partial sum is a whole number that a double holds
        w = v.astype(np.float64)
        return [int(x) for x in (w.T @ w)[at].tolist()]
    wide = v.astype(object)
    return (wide.T @ wide)[at].tolist()


def _added(vectors: DataFrame, of_batch) -> dict[int, int]:
    """The sums over all rows of the lists that ``of_batch`` makes of a batch, by place in the list."""
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("total", _WHOLE)])

    def run(batches):
        totals: list[int] = []
        for batch in batches:
            if batch.num_rows:
                made = of_batch(batch.column(0))
                totals = [a + b for a, b in zip(totals, made)] if totals else made
        yield pa.RecordBatch.from_arrays([pa.array(range(len(totals)), pa.int32()),
                                          pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0))], names=["k", "total"])

    vectors.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    # one row for each place: bounded by the dimension
    found = vectors.select("v").mapInArrow(run, schema).groupBy("k").agg(F.sum("total").alias("total")).collect()
    return {r["k"]: int(r["total"]) for r in found}


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """The factor F, rows in the order of ``a`` and columns in the order of the pivots, with F F' = a."""
    d = len(a)
    factor = np.zeros((d, d))
    left = a.diagonal().copy()
    taken = np.zeros(d, bool)
    least = d * np.finfo(float).eps * max(float(left.max(initial=0.0)), 0.0)
    for k in range(d):
        p = int(np.argmax(np.where(taken, -1.0, left)))
        if taken[p] or left[p] <= least:
            return factor[:, :k]
        taken[p] = True
        column = a[:, p] - factor[:, :k] @ factor[p, :k]
        # rows of earlier pivots stay zero: up to the order of rows the factor is triangular
        column = np.where(taken, 0.0, column) / np.sqrt(left[p])
        column[p] = np.sqrt(left[p])
        factor[:, k] = column
        left -= column * column
    return factor


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of F F': rotations make the columns of F orthogonal, all pairs in rounds."""
    u = factor.copy()
    r = u.shape[1]
    seats = np.arange(r + r % 2)
    close = max(u.shape[0], 1) ** 0.5 * np.finfo(float).eps
    for _ in range(_SWEEPS):
        turned = False
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            p, q = seats[:half], seats[half:][::-1]
            real = (p < r) & (q < r)
            p, q = p[real], q[real]
            a, b = (u[:, p] ** 2).sum(0), (u[:, q] ** 2).sum(0)
            g = (u[:, p] * u[:, q]).sum(0)
            turn = np.abs(g) > close * np.sqrt(a * b)
            if turn.any():
                turned = True
                p, q, a, b, g = p[turn], q[turn], a[turn], b[turn], g[turn]
                zeta = (b - a) / (2 * g)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                s = c * t
                u[:, p], u[:, q] = c * u[:, p] - s * u[:, q], s * u[:, p] + c * u[:, q]
            # the first seat stays, the others move on: each pair meets once a sweep
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if not turned:
            break
    e = (u ** 2).sum(0)
    order = np.argsort(-e, kind="stable")
    return e[order], u[:, order] / np.sqrt(e[order])


def vectors_of(embeddings: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """The usable rows with ``v``, the vector in doubles, in front of their columns ``c0``, ``c1``, ...; and the dimension."""
    rows = embeddings.select(quoted(vector).cast("array<double>").alias("v"),
                             *[quoted(c).alias(f"c{i}") for i, c in enumerate(embeddings.columns)]).filter(usable(F.col("v")))
    d = dimension(rows)
    return rows.filter(F.size("v") == d), d


def fit(rows: DataFrame, d: int) -> Whitening | None:
    """The whitening of rows ``v`` of ``d`` entries; None if there are none."""
    if not d:
        return None
    sums = _added(rows, lambda column: [len(column), *map(int, _lattice(column, d).sum(0))])
    n = sums.pop(0, 0)
    if not n:
        return None
    total = [sums[i + 1] for i in range(d)]
    # whole numbers next to the means
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    products = _added(rows, lambda column: _gram(_lattice(column, d) - centre))
    rest = [s - n * int(c) for s, c in zip(total, centre)]
    covariance = np.zeros((d, d))
    for k, (i, j) in enumerate(zip(*np.triu_indices(d))):
        # whole numbers up to this one division
        covariance[i, j] = covariance[j, i] = (n * products[k] - rest[i] * rest[j]) / (n * n)
    values, vectors = jacobi(pivoted_cholesky(covariance))
    return Whitening(n, total, centre, values, vectors, float(covariance.trace()))


def project(rows: DataFrame, d: int, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """The columns beside ``v``, deviation (exact, decimal) and whitened, the first ``components`` projections at spread one."""
    k = min(components, len(model.values))
    sent = shared(rows.sparkSession, (model.n, model.centre, model.rest(), model.vectors[:, :k] / np.sqrt(model.values[:k])))
    carried = [c for c in rows.columns if c != "v"]
    types = rows.schema
    schema = T.StructType([*[types[c] for c in carried], T.StructField("deviation", _WHOLE),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches):
        n, centre, rest, axes = sent()
        beside = np.array([r / n for r in rest])
        for batch in batches:
            v = _lattice(batch.column(0), d) - centre
            top = n * int(np.abs(v).max(initial=0)) + max(map(abs, rest))
            if top * top * d < 1 << 63:
                spread = ((n * v - np.array(rest, np.int64)) ** 2).sum(1)
                deviation = pa.array(spread, pa.int64()).cast(pa.decimal128(38, 0))
            else:
                spread = ((n * v.astype(object) - np.array(rest, object)) ** 2).sum(1)
                # null beyond 38 digits
                deviation = pa.array([Decimal(int(x)) if x < 10 ** 38 else None for x in spread], pa.decimal128(38, 0))
            white = ((v - beside) @ axes).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * axes.shape[1], pa.int32()), pa.array(white))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], deviation, lists], names=[*carried, "deviation", "whitened"])

    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return rows.select("v", *carried).mapInArrow(run, schema)


def identity_error(whitened: DataFrame, k: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity; centred, then multiplied."""
    parts = [F.col("whitened")[i] for i in range(k)]
    means = whitened.agg(*[F.avg(p) for p in parts]).first()
    centred = [p - F.lit(m) for p, m in zip(parts, means)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    entries = whitened.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(e - (i == j)) for e, (i, j) in zip(entries, pairs))


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS,
           keep: list[str] | None = None) -> DataFrame:
    """A row for each usable vector and component.

    Adds component (from 1), n, deviation (decimal), whitened, explained and
    identity_error to the columns to keep (all unless given).
    """
    names = list(embeddings.columns)
    rows, d = vectors_of(embeddings, vector)
    stay = others([c for c in names if keep is None or c in keep],
                  ["component", "n", "deviation", "whitened", "explained", "identity_error"])
    rows = rows.select("v", *[f"c{names.index(c)}" for c in stay])
    model = fit(rows, d)
    k = min(components, len(model.values)) if model else 0
    columns = [F.col(f"c{names.index(c)}").alias(c) for c in stay]
    if not k:
        nothing = rows.limit(0)
        return nothing.select(*columns, F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast(_WHOLE).alias("deviation"),
                              *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])
    done = written(project(rows, d, model, components), "whitened")
    error = identity_error(done, k)
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values[:k]])
    return done.select(*columns, "deviation", F.posexplode("whitened").alias("place", "value")).select(
        *[quoted(c) for c in stay], (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.col("value").alias("whitened"), share[F.col("place")].alias("explained"), F.lit(error).alias("identity_error"))
