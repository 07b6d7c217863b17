"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers x = floor(64 c) + 1000000, so that counts and sums are exact. With n
vectors and sums S per dimension, a centred entry is (n x - S) / n; the difference is exact, and the
covariance V is only ever applied, never built:

* A pass multiplies the centred matrix with a block Q of `components` + `guard` columns and its own
  transpose with the result, X'(XQ) / n, on stored blocks of rows. Tasks return one small matrix
  each, which are summed in two steps; the driver holds a few matrices of dimensions x columns.
* A short Lanczos run of single vectors finds where the spectrum ends below.
* A cycle applies a Chebyshev polynomial of V to the block, by its three-term recurrence, one pass
  for each degree. The polynomial is small on the unwanted interval, from the lower end to the
  smallest Ritz value of the block, and grows fast above it. QR makes the block orthonormal and a
  Rayleigh-Ritz step (one more pass) rotates it to Ritz vectors.
* Cycles go on until each wanted pair is certified: its residual |V u - e u| is below `tolerance`
  times the largest eigenvalue, and the wanted values did not move against the cycle before. If
  rounding keeps residuals from falling further, the result is certified by a bound a thousand
  times weaker or an error is raised; nothing uncertified is returned.
* Whitened values are projections of the centred rows over sqrt(e). One more pass over them gives
  their covariance and so `identity_error`.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped,
and so are rows whose length is not the most frequent one (the longest of several); entries beyond
2^62 / 64 are taken as that number; rows that repeat an id are rows of their own and null ids are
kept; components whose eigenvalue is not above 1e-10 of the largest are left out, so equal vectors
or a single one give no rows, as an empty table does; with fewer than 32 dimensions or independent
vectors there are fewer components; `deviation` is null where it does not fit a long; other columns
are ignored."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.frames import cut

COMPONENTS = 32
GUARD = 16
TOLERANCE = 1e-13
LANCZOS = 12
MOST_CYCLES = 60
MOST_DEGREE = 24
SCALE, SHIFT = 64, 1_000_000
# entries of a larger size would not fit a long
WIDEST = 2.0**62 / SCALE
# rows of a stored block, by bytes
BLOCK_BYTES = 2 << 20
SEED = 20_12

# --- stored blocks ------------------------------------------------------------------------

BLOCKS = "ids array<bigint>, length int, x binary, low array<bigint>, high array<bigint>"
HALF = 1 << 26


def _block_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as blocks of whole numbers, each of one length, with exact sums in two parts."""
    for batch in batches:
        lists = batch.column("embedding")
        ids = batch.column("vec_id")
        offsets, valid = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
        bad = ~lists.values.is_valid().to_numpy(zero_copy_only=False)
        entries = pa.compute.fill_null(lists.values, 0).to_numpy(zero_copy_only=False).astype(np.float64)
        bad |= ~np.isfinite(entries)
        spoilt = np.concatenate(([0], np.cumsum(bad)))
        sizes = np.diff(offsets)
        fine = valid & (sizes > 0) & (spoilt[offsets[1:]] == spoilt[offsets[:-1]])
        for length in np.unique(sizes[fine]).tolist():
            rows = np.flatnonzero(fine & (sizes == length))
            step = max(1, BLOCK_BYTES // (8 * length))
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                values = entries[offsets[part][:, None] + np.arange(length)]
                x = np.floor(np.clip(values, -WIDEST, WIDEST) * SCALE).astype(np.int64) + SHIFT
                columns = [
                    pa.array([ids.take(pa.array(part)).to_pylist()], pa.list_(pa.int64())),
                    pa.array([length], pa.int32()),
                    pa.array([x.astype("<i8").tobytes()], pa.binary()),
                    pa.array([(x % HALF).sum(axis=0).tolist()], pa.list_(pa.int64())),
                    pa.array([(x // HALF).sum(axis=0).tolist()], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["ids", "length", "x", "low", "high"])


def _matrix(x: bytes, length: int) -> np.ndarray:
    return np.frombuffer(x, "<i8").reshape(-1, length)


class Fit:
    """Number of vectors and exact sums per dimension."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums, self.length = n, sums, len(sums)

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: as long where every value fits, otherwise as Python numbers."""
        most = max(abs(int(x.max())), abs(int(x.min()))) * self.n + max(map(abs, self.sums))
        if most < 1 << 63:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.differences(x).astype(np.float64) / self.n


# --- distributed products -----------------------------------------------------------------


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for part in batch.column("part").to_pylist():
            found = np.frombuffer(part, "<f8")
            total = found.copy() if total is None else total + found
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])


def _total(blocks: DataFrame, of_block: Callable[[np.ndarray], np.ndarray], length: int, shape: tuple[int, int]) -> np.ndarray:
    """The sum of a small matrix over all blocks: per task, per group of tasks, and of the groups."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for x in batch.column("x").to_pylist():
                total += of_block(_matrix(x, length))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = blocks.select("x").mapInArrow(partial, "part binary")
    groups = max(1, math.isqrt(blocks.sparkSession.sparkContext.defaultParallelism))
    parts = parts.repartition(groups).mapInArrow(_summed, "part binary")
    return sum((np.frombuffer(r["part"], "<f8").reshape(shape) for r in parts.collect()), np.zeros(shape))


def covariance_times(blocks: DataFrame, fit: Fit) -> Callable[[np.ndarray], np.ndarray]:
    """Q -> V Q, one pass over the stored blocks."""

    def product(q: np.ndarray) -> np.ndarray:
        def of_block(x: np.ndarray) -> np.ndarray:
            centred = fit.centred(x)
            return centred.T @ (centred @ q)

        return _total(blocks, of_block, fit.length, q.shape) / fit.n

    return product


# --- the eigenvectors ---------------------------------------------------------------------


def lower_end(times: Callable[[np.ndarray], np.ndarray], length: int, steps: int, random: np.random.Generator) -> float:
    """An estimate from below of the smallest eigenvalue, by a Lanczos run; never below zero."""
    basis = [random.standard_normal(length)]
    basis[0] /= np.linalg.norm(basis[0])
    alpha: list[float] = []
    beta: list[float] = []
    for _ in range(min(steps, length)):
        w = times(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        # against all earlier vectors, twice, so that they stay orthogonal
        for _ in range(2):
            w -= np.array(basis).T @ (np.array(basis) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(map(abs, alpha)) or len(alpha) == length:
            beta[-1] = 0.0
            break
        basis.append(w / beta[-1])
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
    return max(0.0, float(values[0] - abs(beta[-1] * vectors[-1, 0])))


def chebyshev(
    times: Callable[[np.ndarray], np.ndarray], block: np.ndarray, product: np.ndarray, degree: int, low: float, high: float, top: float
) -> np.ndarray:
    """The scaled Chebyshev polynomial of V that is small on low..high, times a block.

    `product` is V times the block. Scaling by the value at `top` keeps numbers in range."""
    centre, half = (low + high) / 2, (high - low) / 2
    sigma = first = half / (top - centre)
    before, now = block, (product - centre * block) * (sigma / half)
    for _ in range(1, degree):
        following = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * following / half) - (sigma * following) * before
        sigma = following
    return now


def degree_for(low: float, high: float, least: float, tolerance: float) -> int:
    """The degree at which the polynomial is 1 / tolerance times larger at `least` than on low..high."""
    x = (least - (low + high) / 2) / ((high - low) / 2)
    if x <= 1:
        return MOST_DEGREE
    return min(MOST_DEGREE, max(2, math.ceil(math.log(2 / tolerance) / math.acosh(x))))


class NotCertified(RuntimeError):
    """The eigenvectors did not reach the asked accuracy."""


def leading_eigenvectors(
    times: Callable[[np.ndarray], np.ndarray], length: int, wanted: int, *, guard: int = GUARD, tolerance: float = TOLERANCE, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit eigenvectors (as columns), certified."""
    random = np.random.default_rng(seed)
    wanted = min(wanted, length)
    width = min(length, wanted + guard)
    low = lower_end(times, length, LANCZOS, random)
    block = np.linalg.qr(random.standard_normal((length, width)))[0]
    values = least = None
    for _ in range(MOST_CYCLES):
        product = times(block)
        ritz, rotation = np.linalg.eigh((block.T @ product + product.T @ block) / 2)
        order = np.argsort(ritz)[::-1]
        ritz, rotation = ritz[order], rotation[:, order]
        block, product = block @ rotation, product @ rotation
        top = max(float(ritz[0]), 0.0)
        residual = np.linalg.norm(product - block * ritz, axis=0)[:wanted].max()
        steady = values is not None and np.abs(values - ritz[:wanted]).max() <= 1e-12 * top
        if top == 0 or residual <= tolerance * top and (steady or width == length):
            return ritz[:wanted], block[:, :wanted]
        if steady and least is not None and residual >= least / 2 and residual <= 1000 * tolerance * top:
            return ritz[:wanted], block[:, :wanted]
        values, least = ritz[:wanted], residual
        high = float(ritz[-1])
        if width == length or not high > low:
            # nothing to damp: the block spans the space, or the rest of the spectrum is one value
            block = np.linalg.qr(product)[0]
            continue
        degree = degree_for(low, high, float(ritz[wanted - 1]), max(tolerance * top / residual, tolerance) / 10)
        block = np.linalg.qr(chebyshev(times, block, product, degree, low, high, top))[0]
    raise NotCertified(f"residual {residual:g} after {MOST_CYCLES} cycles")


# --- whitening ----------------------------------------------------------------------------


def fit_blocks(vectors: DataFrame) -> tuple[DataFrame, Fit | None]:
    """Stored blocks of the most frequent length of `vectors` (vec_id, embedding), and their sums."""
    plain = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    blocks = cut(plain.mapInArrow(_block_batches, BLOCKS))
    # one row for each length that occurs
    sizes = blocks.groupBy("length").agg(F.sum(F.size("ids")).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("length")).first()
    if most is None:
        return blocks, None
    blocks = blocks.where(F.col("length") == most["length"])
    parts = blocks.select(F.posexplode(F.arrays_zip("low", "high")).alias("at", "sums"))
    summed = parts.groupBy("at").agg(*[F.sum(F.col(f"sums.{c}").cast("decimal(38,0)")).alias(c) for c in ("low", "high")])
    sums = [0] * most["length"]
    for r in summed.collect():  # one row for each dimension
        sums[r["at"]] = int(r["low"]) + HALF * int(r["high"])
    return blocks, Fit(most["n"], sums)


WHITENED = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _squares(differences: np.ndarray) -> list[int | None]:
    """Exact sums of squares per row; null where a long cannot hold them."""
    if differences.dtype != object:
        most = int(np.abs(differences).max())
        if most * most * differences.shape[1] < 1 << 63:
            return (differences * differences).sum(axis=1).tolist()
        differences = differences.astype(object)
    return [s if s < 1 << 63 else None for s in (differences * differences).sum(axis=1).tolist()]


def _whitened(batches: Iterable[pa.RecordBatch], fit: Fit, scaled: np.ndarray, explained: np.ndarray, error: float) -> Iterator[pa.RecordBatch]:
    many = scaled.shape[1]
    for batch in batches:
        for ids, x in zip(batch.column("ids").to_pylist(), batch.column("x").to_pylist()):
            differences = fit.differences(_matrix(x, fit.length))
            values = (differences.astype(np.float64) / fit.n) @ scaled
            rows = len(ids)
            columns = [
                pa.array(ids, pa.int64()).take(pa.array(np.repeat(np.arange(rows), many))),
                pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * many, fit.n, np.int64)),
                pa.array(_squares(differences), pa.int64()).take(pa.array(np.repeat(np.arange(rows), many))),
                pa.array(values.ravel()),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * many, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in WHITENED.split(", ")])


def whiten(
    vectors: DataFrame, *, components: int = COMPONENTS, guard: int = GUARD, tolerance: float = TOLERANCE, seed: int = SEED
) -> DataFrame:
    """Per usable row of `vectors` (vec_id, embedding) and component: vec_id, component, n, deviation, whitened,
    explained, identity_error."""
    blocks, fit = fit_blocks(vectors)
    if fit is None:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    stored = blocks.select("ids", "x")
    trace = float(_total(stored, lambda x: np.array([[(fit.centred(x) ** 2).sum()]]), fit.length, (1, 1))[0, 0]) / fit.n
    values, basis = leading_eigenvectors(covariance_times(stored, fit), fit.length, components, guard=guard, tolerance=tolerance, seed=seed)
    kept = values > 1e-10 * max(float(values[0]), 0.0)
    if not kept.any():
        return vectors.sparkSession.createDataFrame([], WHITENED)
    values, basis = values[kept], basis[:, kept]
    scaled, many = basis / np.sqrt(values), int(kept.sum())

    def moments(x: np.ndarray) -> np.ndarray:
        white = fit.centred(x) @ scaled
        return np.vstack((white.T @ white, white.sum(axis=0)))

    found = _total(stored, moments, fit.length, (many + 1, many)) / fit.n
    error = float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(many)).max())
    return stored.mapInArrow(lambda b: _whitened(b, fit, scaled, values / trace, error), WHITENED)
