"""Embedding whitening by matrix-free block Lanczos.

The leading eigenvectors of the vectors' covariance V are found without forming V. A step multiplies V with a block of
directions in one distributed pass: every batch centres its rows, multiplies them with the block and the product with
its own transpose, and the sums over batches, a number for each dimension and direction, are all that is gathered. The
block's image, made orthogonal to all directions so far (twice, so that rounding leaves nothing of them), is the next
block. Directions whose image is spent are replaced by random ones, and the run goes on. It ends when the wanted
eigenvectors' residuals |Vy - ey| are within TOLERANCE of the greatest eigenvalue, or the directions span the whole space.
A block is as wide as the number of components, so an eigenvalue that repeats is found as often as it is wanted.

Components are whole numbers x = floor(64 c) + 1000000; n x - S, for n vectors of sums S, is exact before it is divided,
so the offset costs no digits. The trace of V, by which shares are explained, is the sum of the squared deviations.
The covariance is that of the distinct vectors: copies count once. They are written to the shared folder once and read
from there by every pass. Directions and sums, of the dimension times some hundreds at most, are what the driver holds.

Defined results: vectors that are null or hold null or non-finite components, or one whose 64-fold fits no long, take no
part; vectors shorter than others count as filled up with components of 0, empty ones too; rows that repeat, or have no id,
are returned each; a component whose eigenvalue is not above FLAT times the greatest has no direction of its own and is left
out, so equal vectors, or one alone, give no rows, and nor does an empty table; a deviation that fits no long is null;
other columns are ignored. Signs are arbitrary, the same for all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
#: The residual, relative to the greatest eigenvalue, at which an eigenvector counts as found; the part of it below which there is none.
TOLERANCE, FLAT = 1e-13, 1e-11
SEED = 42
#: Cells of a batch that are handled at a time.
CELLS = 1 << 20
_LONG = 2**63
_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def entries(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the rows that take part."""
    fits = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < 2.0**62 / SCALE))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("embedding").isNotNull() & fits)
    return own.select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE) + OFFSET).alias("x"))


class Centre:
    """The vectors' number and sums. Rows of whole numbers become exact differences n x - S, and centred doubles."""

    def __init__(self, n: int, sums: list[int], widest: int):
        self.n, self.sums, self.dim = n, sums, len(sums)
        # deviations are squared and summed as longs only where they fit
        self.small = self.dim * (2 * n * widest) ** 2 < _LONG

    def rows(self, x: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
        """First and last row of a run, and its n x - S: longs, or Python's integers where those might not do."""
        lengths, base = x.value_lengths().to_numpy(), np.array([s - self.n * OFFSET for s in self.sums], np.int64 if self.small else object)
        at = np.concatenate([[0], np.cumsum(lengths)])
        flat = x.flatten().to_numpy()
        step = max(1, CELLS // max(self.dim, 1))
        for a in range(0, len(x), step):
            b = min(a + step, len(x))
            own = np.zeros((b - a, self.dim), np.int64)
            own[np.arange(self.dim) < lengths[a:b, None]] = flat[at[a] : at[b]] - OFFSET
            yield a, b, own.astype(base.dtype) * self.n - base

    def centred(self, x: pa.Array) -> Iterator[np.ndarray]:
        for _, _, exact in self.rows(x):
            yield exact.astype(float) / self.n


def centre(fit: DataFrame) -> Centre:
    """Of the fit list (x), each vector once."""
    n = fit.count()
    widest = fit.agg(F.max(F.array_max("x")).alias("high"), F.min(F.array_min("x")).alias("low"), F.max(F.size("x")).alias("d")).first()
    sums = fit.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum((F.col("x") - OFFSET).cast("decimal(38,0)")).alias("s"))
    # components that a vector lacks are OFFSET
    found = {r["at"]: int(r.s) for r in sums.collect()}
    return Centre(n, [found[k] + n * OFFSET for k in range(widest.d or 0)], max(abs((widest.high or OFFSET) - OFFSET), abs((widest.low or OFFSET) - OFFSET)))


def _gathered(fit: DataFrame, part: Callable[[pa.Array], Iterator[np.ndarray]], shape: tuple[int, int]) -> np.ndarray:
    """The sum over the fit list's batches of the matrices that part makes of them, of the shape given.

    Tasks sum their own first; the rows of the matrices are what is shuffled, so no task or driver meets all of them at once."""
    height, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for m in part(batch.column("x")):
                total += m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(height), pa.int32()), *(pa.array(c) for c in total.T)], ["at", *(f"c{j}" for j in range(width))])

    rows = fit.select("x").mapInArrow(run, ", ".join(["at int", *(f"c{j} double" for j in range(width))]))
    sums = rows.groupBy("at").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(width)])
    out = np.zeros(shape)
    for r in sums.collect():
        out[r["at"]] = r[1:]
    return out


def _orthogonal(block: np.ndarray, basis: np.ndarray, rng: np.random.Generator, scale: float) -> np.ndarray:
    """Unit columns for what of the block isn't in the basis; columns spent to rounding at this scale give way to random ones, while there is room."""
    room, out = len(basis) - basis.shape[1], basis
    for column in block.T[:room]:
        for tries in range(20):
            had = np.linalg.norm(column)
            for _ in range(2):
                column = column - out @ (out.T @ column)
            left = np.linalg.norm(column)
            if left > 1e-14 * max(had, 0 if tries else scale):
                out = np.column_stack([out, column / left])
                break
            column = rng.standard_normal(len(basis))
    return out[:, basis.shape[1] :]


def leading(multiply: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = SEED, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, int]:
    """The greatest eigenvalues, falling, their unit eigenvectors as columns, and the number of passes, of a symmetric operator.

    multiply gives the operator's product with a block of columns."""
    rng, width = np.random.default_rng(seed), min(wanted, dim)
    basis, image, passes = np.zeros((dim, 0)), np.zeros((dim, 0)), 0
    block = _orthogonal(rng.standard_normal((dim, width)), basis, rng, 1.0)
    while True:
        times = multiply(block)
        passes += 1
        basis, image = np.hstack([basis, block]), np.hstack([image, times])
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:wanted], turn[:, ::-1][:, :wanted]
        vectors = basis @ turn
        residual = np.linalg.norm(image @ turn - vectors * values, axis=0)
        scale = max(values[0], 0.0)
        if basis.shape[1] == dim or (residual <= tolerance * scale).all() and len(values) == width:
            return values, vectors / np.linalg.norm(vectors, axis=0), passes
        block = _orthogonal(times, basis, rng, scale)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    spark, rows = vectors.sparkSession, entries(vectors)
    fit = materialize(rows.select("x").distinct(), "fit-list")
    c = centre(fit)
    if not c.n or not c.dim:
        return spark.createDataFrame([], _RESULT)

    def covariance(block: np.ndarray) -> np.ndarray:
        def part(x: pa.Array) -> Iterator[np.ndarray]:
            for own in c.centred(x):
                yield own.T @ (own @ block)

        return _gathered(fit, part, block.shape) / c.n

    values, directions, _ = leading(covariance, c.dim, min(components, c.dim))
    real = values > FLAT * max(values[0], 0.0)
    values, directions = values[real], directions[:, real]
    if not len(values):
        return spark.createDataFrame([], _RESULT)
    scaled = directions / np.sqrt(values)

    def moments(x: pa.Array) -> Iterator[np.ndarray]:
        # second moments of the whitened, then their sums, then the deviations' sum
        for own in c.centred(x):
            w = own @ scaled
            yield np.vstack([w.T @ w, w.sum(axis=0), np.full(w.shape[1], (own * own).sum())])

    k = len(values)
    found = _gathered(fit, moments, (k + 2, k))
    mean, trace = found[k] / c.n, found[k + 1, 0] / c.n
    error = float(np.abs(found[:k] / c.n - np.outer(mean, mean) - np.eye(k)).max())
    explained = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, exact in c.rows(batch.column("x")):
                total = (exact * exact).sum(axis=1)
                deviation = pa.array(total) if c.small else pa.array([t if t < _LONG else None for t in total.tolist()], pa.int64())
                many = (b - a) * k
                index = pa.array(np.repeat(np.arange(b - a), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").slice(a, b - a).take(index), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b - a)), pa.repeat(pa.scalar(c.n, pa.int64()), many), deviation.take(index),
                    pa.array(((exact.astype(float) / c.n) @ scaled).ravel()), pa.array(np.tile(explained, b - a)), pa.repeat(error, many),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, _RESULT)


query = whiten
