"""Whitening of embeddings by block Jacobi-Davidson.

Vectors become whole numbers, and each distinct one is counted once. They are kept as packed blocks
below the shared folder; the covariance matrix is never formed. What the solver needs of
it are products with a few vectors: each task centres its blocks exactly, in integers, multiplies
twice, and sends one row per dimension; the sums over all tasks are grouped by
dimension. All that reaches the driver has the size of the dimensions, whatever the rows.

The solver keeps an orthonormal search space and its products. Rayleigh-Ritz on it gives
approximate eigenpairs; for the wanted ones whose residual is still too large, the projected
correction equation (I - UU')(V - theta I)(I - UU') t = -r is solved by a few steps of
MINRES, all columns in step, so one pass over the data serves them all. The corrections
extend the space. Leading pairs whose residual has reached double precision are locked:
they leave the space, and everything later is kept orthogonal to them. At last
the locked vectors are turned by a Rayleigh-Ritz step of their own.

Defined results: vectors that are null or hold null or non-finite entries are dropped; shorter
vectors are filled up with zeros; repeated rows give a result each and count once in the fit; a
null vec_id is kept. Directions without variance have no component, so fewer than two
distinct vectors, or an empty table, give no rows. Equal eigenvalues get some orthonormal
basis of their space. Entries beyond 2**56 / 64 raise, as their whole numbers would not
fit, and so does a deviation beyond 64 bits when the query casts it. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import common

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
INNER_STEPS = 6
MOST_ROUNDS = 200
# Residuals of so many units of rounding of the largest eigenvalue count as double precision; up to the
# second number, times the root of the dimensions, once a further round makes them no smaller.
ROUNDING, NO_SMALLER = 16, 64
# Eigenvalues below that share of the largest are no variance.
LEAST_SHARE = 1e-12
MOST = 2.0**56


def whole_vectors(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id and x, the whole numbers of the rows that take part."""
    good = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("embedding is not null")

    def whole(c: F.Column) -> F.Column:
        scaled = c.cast("double") * scale
        too_large = F.raise_error(F.lit("a component is too large for a whole number")).cast("long")
        return F.when(F.abs(scaled) < MOST, F.floor(scaled).cast("long") + shift).otherwise(too_large)

    return rows.where(F.coalesce(good, F.lit(False))).select("vec_id", F.transform("embedding", whole).alias("x"))


def _matrix(lists: pd.Series, size: int, shift: int) -> np.ndarray:
    found = np.full((len(lists), size), shift, np.int64)
    for k, v in enumerate(lists):
        found[k, : len(v)] = v
    return found


def _packed(distinct: DataFrame, size: int, shift: int) -> DataFrame:
    """One row per Arrow batch of vectors: their whole numbers as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"block": [_matrix(batch["x"], size, shift).astype("<i8").tobytes()]})

    return distinct.select("x").mapInPandas(run, "block binary")


class Fit:
    """The fit list and its moments; computes with the centred vectors without collecting them."""

    def __init__(self, blocks: DataFrame, size: int):
        self.blocks, self.size = blocks, size

        def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            count, total = 0, np.zeros(size, object)
            for batch in batches:
                for raw in batch["block"]:
                    x = np.frombuffer(raw, "<i8").reshape(-1, size)
                    fits = int(np.abs(x).max()) * len(x) < 2**62
                    count, total = count + len(x), total + (x.sum(axis=0) if fits else x.astype(object).sum(axis=0))
            if count:
                sums = [Decimal(int(v)) for v in (count, *total)]
                yield pd.DataFrame({"i": np.arange(-1, size), "s": pd.Series(sums, dtype=object)})

        rows = blocks.mapInPandas(moments, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
        self.passes = 1
        sums = {r.i: int(r.s) for r in rows}
        self.n = sums.get(-1, 0)
        self.sums = [sums.get(i, 0) for i in range(size)]

    def deviations(self) -> Callable[[np.ndarray], np.ndarray]:
        """n * x - S of whole vectors, exact: 64-bit where that suffices, else Python integers."""
        n, sums = self.n, self.sums

        def run(x: np.ndarray) -> np.ndarray:
            largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
            if largest < 2**62:
                return n * x - np.array(sums, np.int64)
            return n * x.astype(object) - np.array(sums, object)

        return run

    def summed(self, inner: Callable[[np.ndarray], np.ndarray], columns: int) -> np.ndarray:
        """Sum over all blocks of ``inner(centred vectors)``, a matrix of so many columns."""
        size, n, deviations = self.size, self.n, self.deviations()

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for batch in batches:
                for raw in batch["block"]:
                    x = np.frombuffer(raw, "<i8").reshape(-1, size)
                    part = inner(deviations(x).astype(np.float64) / n)
                    total = part if total is None else total + part
            if total is not None:
                yield pd.DataFrame({"i": np.arange(len(total)), **{f"v{k}": total[:, k] for k in range(columns)}})

        names = [f"v{k}" for k in range(columns)]
        parts = self.blocks.mapInPandas(run, "i int, " + ", ".join(f"{v} double" for v in names))
        rows = parts.groupBy("i").agg(*[F.sum(v).alias(v) for v in names]).collect()
        self.passes += 1
        return np.array([list(r)[1:] for r in sorted(rows, key=lambda r: r.i)])

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance matrix times a few vectors."""
        return self.summed(lambda y: y.T @ (y @ vectors), vectors.shape[1]) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda y: (y**2).sum(keepdims=True), 1)[0, 0]) / self.n


def _orthonormal(vectors: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns, orthogonal to those given; dependent columns are dropped."""
    kept = [np.empty((len(vectors), 0))]
    for v in vectors.T:
        size = np.linalg.norm(v)
        if not size:
            continue
        v = v / size
        for _ in range(3):
            for basis in (*against, *kept):
                v = v - basis @ (basis.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        if left >= 1e-10:
            kept.append(v[:, None])
    return np.concatenate(kept, axis=1)


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Columns t with apply(t) near right, by MINRES, all columns in step; apply is symmetric for each."""
    size = np.linalg.norm(right, axis=0)
    v_old, v = np.zeros_like(right), right / np.where(size > 0, size, 1)
    beta, eta = np.zeros(right.shape[1]), size.copy()
    c_old, c, s_old, s = (np.full(right.shape[1], x) for x in (1.0, 1.0, 0.0, 0.0))
    w_old, w, found = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    live = size > 0
    for _ in range(steps):
        after = apply(v)
        alpha = (v * after).sum(axis=0)
        after = after - alpha * v - beta * v_old
        next_beta = np.linalg.norm(after, axis=0)
        delta, over = c * alpha - c_old * s * beta, s * alpha + c_old * c * beta
        above, rho = s_old * beta, np.hypot(delta, next_beta)
        live = live & (rho > 1e-14 * size.max(initial=1e-300))
        safe = np.where(live, rho, 1)
        c_old, s_old, c, s = c, s, np.where(live, delta / safe, 1), np.where(live, next_beta / safe, 0)
        w_old, w = w, np.where(live, (v - above * w_old - over * w) / safe, 0)
        found = found + np.where(live, c * eta, 0) * w
        eta = -s * eta
        live = live & (next_beta > 1e-14 * np.abs(alpha))
        v_old, v, beta = v, np.where(live, after / np.where(next_beta > 0, next_beta, 1), 0), next_beta
        if not live.any():
            break
    return found


def leading_pairs(
    product: Callable[[np.ndarray], np.ndarray], size: int, count: int, steps: int = INNER_STEPS, seed: int = 7
) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues, falling, their vectors, and the largest residual over the largest eigenvalue."""
    count = min(count, size)
    block = min(count + 2, size)
    most = min(size, 4 * block)
    locked, values, before = np.empty((size, 0)), [], np.inf
    space = _orthonormal(np.random.default_rng(seed).standard_normal((size, block)))
    images = product(space)
    for _ in range(MOST_ROUNDS):
        # Rayleigh-Ritz; the space turns to its Ritz vectors.
        theta, turn = np.linalg.eigh((space.T @ images + images.T @ space) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, images = space @ turn, images @ turn
        largest = max([*values, theta[0], 0.0])
        enough = ROUNDING * np.finfo(float).eps * largest
        residual = images - space * theta
        if locked.shape[1]:
            residual = residual - locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        want = count - locked.shape[1]
        done = 0
        while done < min(want, len(theta)) and norms[done] <= enough:
            done += 1
        floor = NO_SMALLER / ROUNDING * np.sqrt(size) * enough
        if not done and before / 2 <= norms[0] <= floor:
            done = 1
        before = norms[done] if done < len(norms) else np.inf
        if done:
            locked = np.concatenate([locked, space[:, :done]], axis=1)
            values += theta[:done].tolist()
            space, images, theta, residual, norms = (
                space[:, done:], images[:, done:], theta[done:], residual[:, done:], norms[done:]
            )
        want = count - locked.shape[1]
        if not want or locked.shape[1] == size:
            break
        active = [k for k in range(min(want, len(theta))) if norms[k] > enough]
        near, shift, right = space[:, : min(want, len(theta))], theta[active], -residual[:, active]
        if not active:
            # All that is left in the space is exact: look elsewhere.
            fresh = np.random.default_rng(seed + locked.shape[1]).standard_normal((size, block))
        else:
            off = np.concatenate([locked, near], axis=1)
            project = lambda t: t - off @ (off.T @ t)
            apply = lambda t: project(product(project(t)) - project(t) * shift)  # noqa: E731, B023
            fresh = project(minres(apply, project(right), steps))
            # A correction too small to see leaves the residual itself as direction.
            fresh = np.where(np.linalg.norm(fresh, axis=0) > 0, fresh, right)
        if most < size and space.shape[1] + fresh.shape[1] > most:
            keep = min(space.shape[1], want + 2)
            space, images = space[:, :keep], images[:, :keep]
        space = _orthonormal(space, locked)
        fresh = _orthonormal(fresh, locked, space)
        if not fresh.shape[1]:
            fresh = _orthonormal(np.random.default_rng(seed + len(values) + 1).standard_normal((size, block)), locked, space)
        space = np.concatenate([space, fresh], axis=1)
        images = product(space)
    else:
        raise ArithmeticError(f"{locked.shape[1]} of {count} eigenpairs reached double precision")
    images = product(locked)
    theta, turn = np.linalg.eigh((locked.T @ images + images.T @ locked) / 2)
    theta, turn = theta[::-1], turn[:, ::-1]
    vectors, images = locked @ turn, images @ turn
    largest = max(theta[0], np.finfo(float).tiny)
    return theta, vectors, float(np.linalg.norm(images - vectors * theta, axis=0).max() / largest)


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, steps: int = INNER_STEPS
) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error, residual, passes."""
    empty = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double, residual double, passes int"
    spark = vectors.sparkSession
    rows, _ = common.stored(whole_vectors(vectors, scale, shift), "whitening-vectors")
    size = rows.agg(F.max(F.size("x"))).first()[0]
    if not size:
        return spark.createDataFrame([], empty)
    # Filled up first, so that vectors that become equal count once.
    full = F.concat("x", F.array_repeat(F.lit(shift).cast("long"), F.greatest(F.lit(size) - F.size("x"), F.lit(0))))
    rows = rows.select("vec_id", full.alias("x"))
    blocks, _ = common.stored(_packed(rows.select("x").distinct(), size, shift), "whitening-blocks")
    fit = Fit(blocks, size)
    trace = fit.trace() if fit.n > 1 else 0.0
    if trace <= 0:
        return spark.createDataFrame([], empty)
    values, basis, residual = leading_pairs(fit.product, size, components, steps)
    kept = values > LEAST_SHARE * values[0]
    values, basis = values[kept], basis[:, kept]
    turn = basis / np.sqrt(values)
    error = np.abs(fit.summed(lambda y: (y @ turn).T @ (y @ turn), len(values)) / fit.n - np.eye(len(values))).max()
    n, deviations, explained = fit.n, fit.deviations(), values / trace
    told = {"n": n, "identity_error": float(error), "residual": residual, "passes": fit.passes}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            apart = deviations(_matrix(batch["x"], size, shift))
            exact = [Decimal(sum(v * v for v in row)) for row in apart.tolist()]
            k = len(values)
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"].repeat(k).reset_index(drop=True),
                    "component": np.tile(np.arange(1, k + 1), len(batch)),
                    "n": n,
                    "deviation": pd.Series(exact, dtype=object).repeat(k).reset_index(drop=True),
                    "whitened": ((apart.astype(np.float64) / n) @ turn).reshape(-1),
                    "explained": np.tile(explained, len(batch)),
                    **{name: told[name] for name in ("identity_error", "residual", "passes")},
                }
            )

    # Ids travel as text: a null would turn a batch of them into floating numbers.
    found = rows.select(F.col("vec_id").cast("string").alias("vec_id"), "x").mapInPandas(run, empty.replace("vec_id long", "vec_id string"))
    return found.withColumn("vec_id", F.col("vec_id").cast("long"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 16 leading components, whitened."""
    found = whiten(common.read_table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained",
        "identity_error", "residual", "passes",
    )
