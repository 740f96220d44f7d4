"""Whitening of embeddings by leading components of their covariance, found with Jacobi-Davidson.

Vectors become integers (``floor(scale * c)``), and each distinct one is kept once in the fit list,
packed in blocks. The covariance is never built: all that is asked of the data are products
``V Y`` with a few columns Y, each one Spark job over the fit list that centres every vector before
it multiplies. The driver holds d x m arrays of the search space only (d: dimension of the vectors,
m: at most ``Solver.space`` columns).

A round of Jacobi-Davidson:

1. Rayleigh-Ritz on the search space gives the leading Ritz pairs and their residuals. Pairs whose
   residual has reached double precision are locked.
2. For each other wanted pair (theta, u) the correction equation
   ``(I - QQ') (V - theta I) (I - QQ') t = -r``, Q the locked and wanted vectors, is solved by MINRES,
   all of them in step, so that one product serves every equation.
3. The corrections, made orthogonal, extend the search space; it is cut back to its leading Ritz
   vectors when it is full.

When all wanted pairs are locked, random directions orthogonal to the search space join it for one
more round, so that a component which the space has missed would show.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiumlake.llm._store import stored

#: Integers of a packed block of the fit list.
BLOCK_VALUES = 1 << 19

RESULT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Solver:
    guard: int = 4  # Ritz vectors kept beyond the wanted ones
    space: int = 40  # columns of the search space before it is cut back
    inner: int = 8  # most MINRES steps of a round
    inner_tolerance: float = 1e-2  # of a correction equation's residual
    rounds: int = 200
    tolerance: float = 2e-14  # of a residual, as a share of the largest eigenvalue
    settled: float = 1e-12  # as small is enough where rounding keeps it from shrinking further


class NotConverged(RuntimeError):
    """The residuals did not reach double precision."""


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The columns of ``new`` made orthonormal, and orthogonal to those of ``against``; columns
    without a part of their own are left out."""
    kept: list[np.ndarray] = []
    base = np.hstack(against) if against else np.zeros((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if not np.isfinite(size) or size == 0:
            continue
        column = column / size
        for _ in range(3):  # repeated, for orthogonality to double precision
            column = column - base @ (base.T @ column)
            for other in kept:
                column = column - other * (other @ column)
        left = np.linalg.norm(column)
        if left > 1e-10:
            kept.append(column / left)
    return np.array(kept).T.reshape(len(new), len(kept))


def _corrections(product, theta: np.ndarray, base: np.ndarray, rest: np.ndarray, solver: Solver) -> np.ndarray:
    """MINRES on the projected correction equations, one a column, in step: each step asks for one
    product with all columns that are not yet solved."""
    d, k = rest.shape
    project = lambda y: y - base @ (base.T @ y)
    b = project(-rest)
    size = np.linalg.norm(b, axis=0)
    solution = np.zeros((d, k))
    v_old, v = np.zeros((d, k)), b / np.where(size > 0, size, 1)
    w_old, w = np.zeros((d, k)), np.zeros((d, k))
    beta, eta = np.zeros(k), size.copy()
    c_old, c, s_old, s = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    active = size > 0
    for _ in range(min(solver.inner, d)):
        if not active.any():
            break
        at = np.flatnonzero(active)
        image = project(product(v[:, at]) - v[:, at] * theta[at])
        alpha = np.einsum("ij,ij->j", v[:, at], image)
        following = image - v[:, at] * alpha - v_old[:, at] * beta[at]
        beta_new = np.linalg.norm(following, axis=0)
        # the two rotations before, then the one that removes the new subdiagonal entry
        delta = c[at] * alpha - c_old[at] * s[at] * beta[at]
        upper = s[at] * alpha + c_old[at] * c[at] * beta[at]
        third = s_old[at] * beta[at]
        pivot = np.hypot(delta, beta_new)
        pivot = np.where(pivot > 0, pivot, 1)
        c_new, s_new = delta / pivot, beta_new / pivot
        w_new = (v[:, at] - w[:, at] * upper - w_old[:, at] * third) / pivot
        solution[:, at] += w_new * (c_new * eta[at])
        eta[at] = -s_new * eta[at]
        w_old[:, at], w[:, at] = w[:, at], w_new
        v_old[:, at], v[:, at] = v[:, at], following / np.where(beta_new > 0, beta_new, 1)
        beta[at] = beta_new
        c_old[at], c[at] = c[at], c_new
        s_old[at], s[at] = s[at], s_new
        active[at] = (np.abs(eta[at]) > solver.inner_tolerance * size[at]) & (beta_new > 1e-14 * np.abs(theta[at]))
    return project(solution)


def jacobi_davidson(product, d: int, wanted: int, solver: Solver = Solver()) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the ``wanted`` largest eigenvalues of the
    symmetric positive semidefinite map ``product`` (d x k array to d x k array), falling."""
    wanted = min(wanted, d)
    keep = min(d, wanted + solver.guard)
    random = np.random.default_rng(20240517)
    space = _orthonormal(random.standard_normal((d, keep)))
    image = product(space)
    best, probed, still = np.inf, False, 0
    for _ in range(solver.rounds):
        values, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, rotated = space @ turn, image @ turn
        u, theta = ritz[:, :wanted], values[:wanted]
        rest = rotated[:, :wanted] - u * theta
        error = np.linalg.norm(rest, axis=0)
        scale = max(abs(theta[0]), np.finfo(float).tiny)
        worst = error.max() / scale
        still = 0 if worst < best / 2 else still + 1
        best = min(best, worst)
        full = space.shape[1] >= d
        locked = (error <= solver.tolerance * scale) | full
        if locked.all() or (still >= 2 and worst <= solver.settled):
            if probed or full:
                return theta, u
            probed, new = True, random.standard_normal((d, min(wanted, d - space.shape[1])))
        else:
            open_ = np.flatnonzero(~locked)
            new = _corrections(product, theta[open_], u, rest[:, open_], solver)
        if space.shape[1] + new.shape[1] > min(solver.space, d) and space.shape[1] > keep:
            space, image = ritz[:, :keep], rotated[:, :keep]
        new = _orthonormal(new, space)[:, : d - space.shape[1]]
        if not new.shape[1]:  # the corrections lie in the space already
            new = _orthonormal(random.standard_normal((d, min(wanted, d - space.shape[1]))), space)
        space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    raise NotConverged(f"largest residual after {solver.rounds} rounds: {best:.2e} of the largest eigenvalue")


def _rows(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, x array<long>) of rows whose vector is whole."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("c"))
    whole = F.forall("c", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return rows.where(F.col("c").isNotNull() & whole).select("id", F.transform("c", lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))


def _packed(x: DataFrame, d: int) -> DataFrame:
    """(n, block binary): up to ``BLOCK_VALUES`` integers of whole vectors a row, little endian."""

    def run(batches):
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(-1, d)
            step = max(1, BLOCK_VALUES // d)
            for low in range(0, len(flat), step):
                part = flat[low : low + step]
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["n", "block"])

    return x.mapInArrow(run, "n long, block binary")


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, S): how many vectors, and their exact sum in each dimension."""

    def run(batches):
        for batch in batches:
            for block in batch.column("block").to_pylist():
                x = np.frombuffer(block, "<i8").reshape(-1, d)
                safe = np.abs(x.astype(float)).max(initial=0) * len(x) < 1 << 62
                total = x.sum(0).tolist() if safe else [sum(map(int, column)) for column in x.T]
                values = pa.array([[Decimal(t) for t in total]], pa.list_(pa.decimal128(38, 0)))
                yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), values], names=["n", "s"])

    parts = fit.mapInArrow(run, "n long, s array<decimal(38,0)>").select("n", F.posexplode("s").alias("at", "value"))
    found = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).collect()  # a row for each dimension
    total = {r["at"]: int(r["value"]) for r in found}
    return (found[0]["n"] if found else 0), [total[k] for k in range(len(total))]


def _summed(fit: DataFrame, partitions: int, d: int, shape: tuple[int, ...], each) -> np.ndarray:
    """The sum over all blocks of ``each(x)``, x a block as an array of doubles: tasks add up what
    they read, a second layer adds those, and the driver gets the square root of their number."""

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            for block in batch.column("block").to_pylist():
                total += each(np.frombuffer(block, "<i8").reshape(-1, d).astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    def again(batches):
        total = np.zeros(shape)
        for batch in batches:
            for part in batch.column("total").to_pylist():
                total += np.frombuffer(part).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    parts = fit.select("block").mapInArrow(run, "total binary")
    if partitions > 16:
        parts = parts.repartition(int(partitions**0.5) + 1).mapInArrow(again, "total binary")
    total = np.zeros(shape)
    for row in parts.collect():  # at most sixteen, or the square root of the tasks; d x k doubles each
        total += np.frombuffer(row["total"]).reshape(shape)
    return total


def whiten(
    vectors: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", solver: Solver = Solver()
) -> DataFrame:
    """(id_col, component int, n long, deviation decimal, whitened double, explained double,
    identity_error double): for every row with a whole vector and every component 1 to
    ``components``, by falling eigenvalue.

    An entry c becomes ``x = floor(scale * c)``. The fit list is each distinct vector once (n of
    them, with sums S). ``deviation``: sum over dimensions of ``(n x - S)^2``, exact; ``whitened``:
    ``x - S/n`` projected on the component, over the square root of its eigenvalue; ``explained``:
    the eigenvalue's share of the trace; ``identity_error``: the largest absolute entry of the
    covariance of whitened over the fit list, less the identity.

    Rows whose vector is null or holds null or non-finite entries are dropped, as are rows whose
    vector has another length than most (ties: the longer), and components without variance. Rows
    that repeat, null ids among them, get a result each; other columns are not read. Entries beyond
    a long's range take its ends. A table without whole vectors gives an empty result. Equal
    eigenvalues give some orthonormal basis of their space.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {RESULT}"
    rows = _rows(vectors, id_col, vec_col, scale)
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    empty = lambda: spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    if not lengths or not lengths[0]["d"]:
        return empty()
    d = lengths[0]["d"]
    rows = rows.where(F.size("x") == d)
    fit = stored(_packed(rows.select("x").distinct(), d), "fit")
    partitions = fit.rdd.getNumPartitions()
    n, total = _sums(fit, d)
    mean = np.array([s / n for s in total])

    def product(columns: np.ndarray) -> np.ndarray:
        def each(x):
            x = x - mean
            return x.T @ (x @ columns)

        return _summed(fit, partitions, d, columns.shape, each) / n

    trace = float(_summed(fit, partitions, d, (1,), lambda x: np.square(x - mean).sum().reshape(1))[0]) / n
    if trace <= 0:
        return empty()
    values, basis = jacobi_davidson(product, d, components, solver)
    found = values > 1e-12 * trace
    values, basis = values[found], basis[:, found]
    k = len(values)
    turn = basis / np.sqrt(values)
    centre = _summed(fit, partitions, d, (k,), lambda x: ((x - mean) @ turn).sum(0)) / n

    def spread(x):
        y = (x - mean) @ turn - centre
        return y.T @ y

    error = float(np.abs(_summed(fit, partitions, d, (k, k), spread) / n - np.eye(k)).max())
    share = (values / trace).tolist()

    def run(batches):
        sums = np.array(total, object)
        fits = max(map(abs, total), default=0) < 1 << 62
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)
            if not len(x):
                continue
            bound = float(np.abs(x.astype(float)).max()) * n + max(map(abs, total), default=0)
            if fits and bound * bound * d < 1 << 62:
                apart = x * n - np.array(total, np.int64)
                deviation = pa.array(np.einsum("ij,ij->i", apart, apart)).cast(pa.decimal128(38, 0))
            else:
                apart = x.astype(object) * n - sums
                deviation = pa.array([Decimal(int(v)) for v in (apart * apart).sum(1)], pa.decimal128(38, 0))
            white = (x.astype(float) - mean) @ turn
            many = len(x)
            again = np.repeat(np.arange(many), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(again)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * k, n, np.int64)), deviation.take(pa.array(again)), pa.array(white.ravel()),
                    pa.array(np.tile(share, many)), pa.array(np.full(many * k, error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
