"""Whitening of embeddings with the leading components found by Jacobi-Davidson, without ever forming the covariance.

The covariance V of all vectors is known through products alone: one pass over the staged vectors centres each, multiplies it by
a block of directions and sums what comes back, d x k numbers however many rows there are. On the driver stand
only such blocks (:func:`leading`):

* Rayleigh-Ritz on the search space gives approximate components and their residuals; the leading ones whose residuals have reached double
  precision are locked, and everything later is kept orthogonal to them.
* For each of the others the correction equation (I - PP')(V - theta)(I - PP')t = -r, P the locked components and the
  approximation itself, is solved by MINRES. The equations of all components take their steps together, so a step
  is one pass for all of them.
* The corrections enlarge the search space, which starts anew from its best directions when it grows too large. It ends when all
  are locked and nothing left in the search space is above the least of them.

Rows are left out whose vector is null, empty, or holds null, NaN or infinite entries. All others must have the same
length, else a ``ValueError`` tells the lengths. A component whose eigenvalue is zero to double precision cannot be
whitened and is not returned, so a single vector, equal vectors or an empty table give no rows. Repeated rows, ties and missing ids stay; very long
vectors cost d x k numbers per task. Equal eigenvalues have any orthonormal basis of their space. Columns other than the id
and the vector are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.llm.frames import Batches, staged

MORE = 4  # directions searched beyond those wanted
SPACE = 8  # the search space is cut back when it has this many times the wanted directions
STEPS = 4  # MINRES steps at most before the search space is enlarged
ROUNDS = 200
PRECISION = 16 * np.finfo(float).eps  # of the greatest eigenvalue, times the root of the dimension

Product = Callable[[np.ndarray], np.ndarray]


def quantised(embeddings: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """(vec_id, x): usable vectors, entry c as floor(scale * c) + shift."""
    kind = embeddings.schema[id_col].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        for batch in batches:
            column = batch.column(1)
            sizes = np.asarray(column.value_lengths().fill_null(0))
            flat = column.flatten()
            values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan))
            row = np.repeat(np.arange(len(sizes)), sizes)
            good = sizes > 0
            good[row[~np.isfinite(values)]] = False
            whole = np.floor(scale * values[good[row]]).astype(np.int64) + shift
            ends = np.r_[0, np.cumsum(sizes[good])].astype(np.int32)
            x = pa.ListArray.from_arrays(pa.array(ends), pa.array(whole))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), x], names=["vec_id", "x"])

    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, f"vec_id {kind}, x array<long>")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def summed(vectors: DataFrame, d: int, size: int, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum of ``part`` (``size`` numbers from a block of vectors) over all of them: each task adds up its own."""

    def run(batches: Batches) -> Batches:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = part(_matrix(batch.column(0), d))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total.ravel())], names=["i", "v"])

    found = np.zeros(size, np.int64 if kind == "long" else float)
    for i, v in vectors.select("x").mapInArrow(run, f"i int, v {kind}").groupBy("i").agg(F.sum("v")).collect():
        found[i] = v
    return found


def covariance_product(vectors: DataFrame, mean: np.ndarray, n: int) -> Product:
    """Y -> VY in one pass over the vectors."""
    d = len(mean)

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ block)

        return summed(vectors, d, block.size, part).reshape(block.shape) / n

    return product


def _outside(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """``block`` without its parts in the spaces of the orthonormal bases; twice, for rounding."""
    for _ in range(2):
        for basis in bases:
            block = block - basis @ (basis.T @ block)
    return block


def _new_directions(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``block`` outside the bases; those that lie inside them are dropped."""
    found = np.zeros((len(block), 0))
    for column in block.T:
        column = column[:, None]
        before = np.linalg.norm(column)
        column = _outside(column, *bases, found)
        after = np.linalg.norm(column)
        if after > 1e-10 * before and before > 0:
            found = np.c_[found, _outside(column / after, *bases, found)]
            found[:, -1] /= np.linalg.norm(found[:, -1])
    return found


def minres(product: Product, right: np.ndarray, least: float, steps: int) -> np.ndarray:
    """Approximate solutions, column by column, of a symmetric system given by its product with a block.

    All columns step together; it ends when every residual is ``least`` times its start or less.
    """
    norm = np.linalg.norm(right, axis=0)
    live = norm > 0
    v = np.divide(right, norm, where=live, out=np.zeros_like(right))
    before, beta = np.zeros_like(v), np.zeros_like(norm)
    c, s = -np.ones_like(norm), np.zeros_like(norm)
    delta_next, epsilon = np.zeros_like(norm), np.zeros_like(norm)
    w1, w2, found = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    rest = norm.copy()
    for _ in range(steps):
        p = product(v) - before * beta
        alpha = (v * p).sum(axis=0)
        p = p - v * alpha
        beta_next = np.linalg.norm(p, axis=0)
        delta = c * delta_next + s * alpha
        gamma_bar = s * delta_next - c * alpha
        epsilon, epsilon_next = epsilon, s * beta_next
        delta_next = -c * beta_next
        gamma = np.hypot(gamma_bar, beta_next)
        safe = np.where(gamma > 0, gamma, 1)
        c, s = gamma_bar / safe, beta_next / safe
        w = (v - w1 * epsilon - w2 * delta) / safe
        step = np.where(live & (gamma > 0), c * rest, 0)
        found = found + w * step
        rest = rest * s
        epsilon = epsilon_next
        w1, w2 = w2, w
        live = live & (beta_next > 1e-14 * np.abs(alpha)) & (rest > 0)
        before, v = v, np.divide(p, beta_next, where=live, out=np.zeros_like(p))
        beta = beta_next
        if not (live & (rest > least * norm)).any():
            break
    return found


def leading(product: Product, d: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, falling, and their unit eigenvectors as columns."""
    wanted = min(wanted, d)
    space = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, min(d, wanted + MORE))))[0]
    image = product(space)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    for round_ in range(ROUNDS):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        greatest = max(theta.max(initial=0), values.max(initial=0))
        residuals = image - space * theta
        near = np.linalg.norm(residuals, axis=0) <= PRECISION * np.sqrt(d) * max(greatest, np.finfo(float).tiny)
        take = 0
        while take < len(theta) and near[take] and (len(values) + take < wanted or theta[take] > values.min(initial=np.inf)):
            take += 1
        locked, values = np.c_[locked, space[:, :take]], np.r_[values, theta[:take]]
        space, image, theta, residuals = space[:, take:], image[:, take:], theta[take:], residuals[:, take:]
        least = np.sort(values)[::-1][wanted - 1] if len(values) >= wanted else -np.inf
        open_ = max(wanted - len(values), int((theta > least).sum()) if len(values) >= wanted else 0)
        if not open_:
            break
        if space.shape[1] > SPACE * wanted:
            space, image = space[:, :2 * wanted + MORE], image[:, :2 * wanted + MORE]
        m = min(open_, space.shape[1], wanted)
        about, at = space[:, :m], theta[:m]

        def project(block: np.ndarray) -> np.ndarray:
            block = block - locked @ (locked.T @ block)
            return block - about * (about * block).sum(axis=0)

        def shifted(block: np.ndarray) -> np.ndarray:
            block = project(block)
            return project(product(block) - block * at)

        corrections = minres(shifted, project(-residuals[:, :m]), 0.5 ** (round_ + 2), STEPS) if m else np.zeros((d, 0))
        fresh = _new_directions(np.c_[corrections, residuals[:, :m]], locked, space)[:, :max(m, 1)]
        if not fresh.shape[1]:  # the space is closed under V, or rounding is all that is left: search elsewhere
            fresh = _new_directions(np.random.default_rng(seed + round_ + 1).standard_normal((d, wanted)), locked, space)
        space, image = np.c_[space, fresh], np.c_[image, product(fresh)] if fresh.shape[1] else image
    else:
        raise RuntimeError(f"{len(values)} of {wanted} components after {ROUNDS} rounds")
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], locked[:, order]


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exactly; in plain integers where 64 bits might not hold it."""
    kind = pa.decimal128(38, 0)
    if n * (np.abs(x).max(initial=0) + 1) < 1 << 62:
        apart = n * x - sums
        if x.shape[1] * float(np.abs(apart).max(initial=0)) ** 2 < float(1 << 62):
            return pa.array((apart * apart).sum(axis=1)).cast(kind)
    apart = n * x.astype(object) - sums.astype(object)
    return pa.array([str(v) for v in (apart * apart).sum(axis=1)]).cast(kind)


def whitened(
    spark: SparkSession, embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    components: int = 8, scale: int = 1024, shift: int = 100_000,
) -> DataFrame:
    """Per usable vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error).

    ``deviation`` is a decimal, since the exact sum passes 64 bits above about a million rows.
    """
    kind = embeddings.schema[id_col].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    vectors = staged(spark, quantised(embeddings, id_col, vector_col, scale, shift), "vectors")
    n, shortest, longest = vectors.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return spark.createDataFrame([], schema)
    if shortest != longest:
        raise ValueError(f"vectors of {shortest} to {longest} entries")
    d = longest
    sums = summed(vectors, d, d, lambda x: x.sum(axis=0), "long")
    mean = sums / n
    trace = float(summed(vectors, d, 1, lambda x: np.array([((x - mean) ** 2).sum()]))[0]) / n
    if not trace:
        return spark.createDataFrame([], schema)
    values, directions = leading(covariance_product(vectors, mean, n), d, components)
    kept = values > d * np.finfo(float).eps * values[0]
    values, directions = values[kept], directions[:, kept]
    k, onto = len(values), directions / np.sqrt(values)
    centre = summed(vectors, d, k, lambda x: ((x - mean) @ onto).sum(axis=0)) / n

    def products(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ onto - centre
        return w.T @ w

    error = float(np.abs(summed(vectors, d, k * k, products).reshape(k, k) / n - np.eye(k)).max())
    explained = values / trace

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            rows = np.repeat(np.arange(len(x)), k)
            apart = _deviations(x, n, sums)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), n, np.int64)), apart.take(pa.array(rows)), pa.array(((x - mean) @ onto).ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(len(rows), error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)
