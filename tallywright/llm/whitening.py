"""Whitening of embedding vectors by a distributed block Jacobi-Davidson method.

Entries become whole numbers x = floor(64 c) + 1000000. The covariance V of the x-vectors (divisor n) is
never formed: the method only needs V times a block of vectors, and one such product is one pass over the
vectors. Every task centres its rows by the exact sums, (n x - S) / n, multiplies them, and sends one small
matrix; these are added in groups, so that no task and not the driver reads more than `FAN_IN` at a time.

1. Rayleigh-Ritz on the subspace gives approximate components and residuals V u - e u.
2. Components whose residual has reached double precision, with all before them, are locked; later vectors
   are kept orthogonal to them.
3. For all others the correction equation (I - QQ')(V - e)(I - QQ') t = -residual, Q being the locked and
   the current components, is solved by a few steps of MINRES. The recurrences of all columns advance
   together, so one step is one pass for the whole block.
4. The corrections widen the subspace; beyond `SUBSPACE` vectors it restarts from the best ones.

Residuals are taken from fresh products, not from recurrences. If none of the open components improves any
more, what is left of their residuals is the rounding of the passes; it is accepted up to `ACCEPTED` and is
an error beyond.

Nulls and odd rows: a vector that is null, empty, or holds a null, a non-finite entry or one of 2^40 or more
in size is dropped, and so is one that has not the most frequent number of entries (the larger of two equally
frequent); repeated rows all count; components whose variance is zero, up to rounding (one row, constant
columns), cannot be scaled and are left out; an empty table gives an empty result. `deviation` is null where
it is beyond a long. Columns other than `vec_id, embedding` are not read.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tasks import ship, staged

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 40)

# More vectors than components in the first block, and steps of MINRES for one correction.
GUARD = 8
INNER = 4
# Vectors in the subspace before it restarts, as a multiple of the block.
SUBSPACE = 4
OUTER = 200
# Residuals relative to the largest component: wanted, and accepted where rounding allows no better.
WANTED = 64 * np.finfo(float).eps
ACCEPTED = 1e-12
# Below this share of the largest component a variance is rounding.
NOTHING = 1e-13
# Partial sums added in one task.
FAN_IN = 64

ROWS = "vec_id long, x array<long>"
PROJECTED = "vec_id long, deviation long, whitened array<double>"


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """`vec_id, x` of the usable rows; of several lengths, the most frequent."""
    c = F.col("embedding")
    good = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST)
    doubles = vectors.select("vec_id", c.cast("array<double>").alias("embedding"))
    usable = doubles.filter(F.size(c) > 0).filter(F.forall(c, good))
    x = F.transform(c, lambda e: F.floor(e * SCALE).cast("long") + OFFSET)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch["x"]
    return x.flatten().to_numpy().reshape(len(x), -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """(n x - S) / n without cancellation: the numerator is exact."""
    return deviations(x, n, sums).astype(float) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: as 64-bit integers where they fit."""
    if n * int(np.abs(x).max(initial=0)) + int(max(map(abs, sums.tolist()), default=0)) < 1 << 62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def squared_lengths(d: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; null beyond a long."""
    top = int(np.abs(d).max(initial=0))
    if d.shape[1] * top * top < 1 << 63:
        return (d.astype(np.int64) ** 2).sum(1).tolist()
    lengths = [sum(int(v) ** 2 for v in row) for row in d.tolist()]
    return [v if v < 1 << 63 else None for v in lengths]


class Table:
    """The centred vectors as an operator: products and sums, one pass each."""

    def __init__(self, rows: DataFrame):
        self.rows, self.spark = rows, rows.sparkSession
        found = rows.agg(F.count("*")).first()[0]
        self.n, self.dim = found, len(rows.first().x) if found else 0
        self.sums = np.zeros(self.dim, object)
        if found:
            self.sums = self._integer_sums()
        self.partitions = rows.rdd.getNumPartitions()
        self.passes = 0

    def _integer_sums(self) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                if batch.num_rows:
                    x = _matrix(batch)
                    total = total + x.sum(0).astype(object)
            if not isinstance(total, int):
                texts = [str(v) for v in total]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(texts)), pa.int32()), pa.array(texts)], names=["at", "part"]
                )

        parts = self.rows.select("x").mapInArrow(run, "at int, part string")
        sums = parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).cast("string").alias("s"))
        whole = np.zeros(self.dim, object)
        for row in sums.collect():  # one row per dimension
            whole[row.at] = int(row.s)
        return whole

    def total(self, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all rows of `part`, a matrix of `shape` made from a batch of centred rows."""
        n, sums = self.n, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            held = np.zeros(shape)
            for batch in batches:
                if batch.num_rows:
                    held += part(centred(_matrix(batch), n, sums))
            columns = [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([held.tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "part"])

        def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            whole = np.zeros(shape)
            for data in table["part"]:
                whole += np.frombuffer(data.as_py()).reshape(shape)
            return pa.table({"at": pa.array([key[0].as_py()], pa.int64()), "part": [whole.tobytes()]})

        kind = "at long, part binary"
        parts, width = self.rows.select("x").mapInArrow(run, kind), self.partitions
        while width > FAN_IN:
            parts = parts.groupBy(F.floor(F.col("at") / FAN_IN).alias("group")).applyInArrow(add, kind)
            width = -(-width // FAN_IN)
        self.passes += 1
        found = sorted(parts.collect(), key=lambda row: row.at)
        return sum((np.frombuffer(row.part).reshape(shape) for row in found), np.zeros(shape))

    def times(self, block: np.ndarray) -> np.ndarray:
        """V times `block`."""
        sent = self.spark.sparkContext.broadcast(block)
        try:
            return self.total(block.shape, lambda x: x.T @ (x @ sent.value)) / self.n
        finally:
            sent.unpersist()

    def trace(self) -> float:
        return float(self.total((1, 1), lambda x: np.array([[np.square(x).sum()]]))[0, 0]) / self.n


def _apart(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """`block` without its parts in `bases`, taken off twice."""
    for _ in range(2):
        for basis in bases:
            block = block - basis @ (basis.T @ block)
    return block


def _orthonormal(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what `block` adds to `bases`; columns that add nothing go."""
    columns: list[np.ndarray] = []
    for column in block.T:
        length = np.linalg.norm(column)
        if not length > 0:
            continue
        own = np.array(columns).T if columns else np.zeros((len(column), 0))
        left = _apart((column / length)[:, None], *bases, own)[:, 0]
        if (rest := np.linalg.norm(left)) > 1e-8:
            columns.append(_apart((left / rest)[:, None], *bases, own)[:, 0])
            columns[-1] /= np.linalg.norm(columns[-1])
    return np.array(columns).T if columns else np.zeros((len(block), 0))


def minres(times, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of A t = `right`, column by column; `times` takes (block, columns in use).

    The usual recurrence of Lanczos vectors and plane rotations, with one entry per column instead of
    scalars. A column whose next Lanczos vector vanishes is solved and stays as it is.
    """
    width = right.shape[1]
    solution = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    open_ = beta > 0
    v = np.divide(right, beta, out=np.zeros_like(right), where=open_)
    v_old, w, w_old = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c, c_old, s, s_old = np.ones(width), np.ones(width), np.zeros(width), np.zeros(width)
    eta, beta_now = beta.copy(), np.zeros(width)
    first = beta.copy()
    for _ in range(steps):
        if not open_.any():
            break
        product = np.zeros_like(v)
        product[:, open_] = times(v[:, open_], np.flatnonzero(open_))
        alpha = (v * product).sum(0)
        following = product - alpha * v - beta_now * v_old
        beta_next = np.linalg.norm(following, axis=0)
        # Two rotations of before act on the new column of the tridiagonal matrix, then a third is made.
        above = s_old * beta_now
        middle = c * c_old * beta_now + s * alpha
        low = c * alpha - s * c_old * beta_now
        root = np.hypot(low, beta_next)
        good = open_ & (root > 0)
        c_new = np.divide(low, root, out=np.ones(width), where=good)
        s_new = np.divide(beta_next, root, out=np.zeros(width), where=good)
        w_new = np.divide(v - above * w_old - middle * w, root, out=np.zeros_like(v), where=good)
        solution += np.where(good, c_new * eta, 0) * w_new
        eta = np.where(good, -s_new * eta, eta)
        w_old, w = w, w_new
        c_old, c, s_old, s = c, c_new, s, s_new
        v_old = v
        open_ = good & (beta_next > 1e-14 * np.maximum(np.abs(alpha), 1e-300)) & (np.abs(eta) > 1e-15 * first)
        v = np.divide(following, beta_next, out=np.zeros_like(v), where=open_)
        beta_now = beta_next
    return solution


def jacobi_davidson(
    times: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, inner: int = INNER, seed: int = 7
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues of a symmetric non-negative operator, eigenvectors, residuals."""
    wanted = min(wanted, dim)
    block = min(dim, wanted + GUARD)
    limit = min(dim, SUBSPACE * block)
    start = np.random.default_rng(seed).standard_normal((dim, block))
    locked, values, residuals = np.zeros((dim, 0)), np.zeros(0), np.zeros(0)
    basis = _orthonormal(start)
    image = times(basis)
    lowest, still = np.inf, 0
    for _ in range(OUTER):
        open_ = wanted - locked.shape[1]
        small = basis.T @ image
        theta, rotation = np.linalg.eigh((small + small.T) / 2)
        theta, rotation = theta[::-1], rotation[:, ::-1]
        keep = min(open_ + GUARD, len(theta))
        ritz = basis @ rotation[:, :keep]
        ritz /= np.linalg.norm(ritz, axis=0)
        fresh = times(ritz)
        theta = (ritz * fresh).sum(0)
        residual = _apart(fresh - ritz * theta, locked)
        size = np.linalg.norm(residual, axis=0)
        scale = max(theta.max(initial=0), values.max(initial=0))
        if not scale > 0:  # no variance at all
            return np.zeros(0), np.zeros((dim, 0)), np.zeros(0)
        worst = size[:open_].max()
        still = 0 if worst < lowest / 2 else still + 1
        lowest = min(lowest, worst)
        enough = WANTED if still < 3 else ACCEPTED
        done = size[:open_] <= enough * scale
        n_done = int(np.argmin(done)) if not done.all() else len(done)
        if n_done:
            # Locked in order, so that no smaller component is taken for a larger one.
            locked = np.hstack([locked, _orthonormal(ritz[:, :n_done], locked)])
            values, residuals = np.append(values, theta[:n_done]), np.append(residuals, size[:n_done])
            lowest, still = np.inf, 0
        if locked.shape[1] >= wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order], residuals[order]
        current, residual, shift = ritz[:, n_done:], residual[:, n_done:], theta[n_done:]

        def projected(v: np.ndarray, columns: np.ndarray) -> np.ndarray:
            v = _apart(v, locked, current)
            return _apart(times(v) - v * shift[columns], locked, current)

        correction = minres(projected, _apart(-residual, locked, current), inner)
        left = limit - locked.shape[1]
        if basis.shape[1] + correction.shape[1] > left and left < dim - locked.shape[1] or n_done:
            basis = _orthonormal(current, locked)
            image = times(basis)
        else:
            basis, image = current_subspace(basis, image, rotation, ritz, fresh, keep)
        added = _orthonormal(np.hstack([correction, residual]), locked, basis)
        added = added[:, : max(1, dim - locked.shape[1] - basis.shape[1])]
        if added.shape[1]:
            basis, image = np.hstack([basis, added]), np.hstack([image, times(added)])
    raise ArithmeticError(f"{wanted - locked.shape[1]} components have not converged")


def current_subspace(basis, image, rotation, ritz, fresh, keep):
    """The same subspace in Ritz vectors, whose images have just been computed afresh."""
    return np.hstack([ritz, basis @ rotation[:, keep:]]), np.hstack([fresh, image @ rotation[:, keep:]])


class Whitening:
    """Mean, components and variances, and how far the whitened covariance is from the identity."""

    def __init__(self, rows: DataFrame, components: int = COMPONENTS):
        table = Table(rows)
        self.n, self.sums, self.dim = table.n, table.sums, table.dim
        self.values, self.vectors, self.identity_error = np.zeros(0), np.zeros((self.dim, 0)), 0.0
        self.trace = table.trace() if self.n else 0.0
        if self.trace > 0:
            values, vectors, self.residuals = jacobi_davidson(table.times, table.dim, components)
            some = values > NOTHING * values.max(initial=0)
            self.values, self.vectors = values[some], vectors[:, some]
            scaled = self.vectors / np.sqrt(self.values)
            k = len(self.values)
            mean = table.total((1, k), lambda x: (x @ scaled).sum(0, keepdims=True)) / self.n

            def products(x: np.ndarray) -> np.ndarray:
                y = x @ scaled - mean
                return y.T @ y

            covariance = table.total((k, k), products) / self.n
            self.identity_error = float(np.abs(covariance - np.eye(k)).max())
        self.passes = table.passes


def usable(vectors: DataFrame) -> DataFrame:
    """The rows that count, of one length, written once."""
    rows = staged(whole_vectors(vectors), "vectors")
    lengths = rows.groupBy(F.size("x").alias("size")).count()
    best = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return rows.filter(F.size("x") == best["size"]) if best else rows


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """`vec_id, deviation, whitened`: one row per vector, one entry per component."""
    ship(rows.sparkSession)
    n, sums, scaled = model.n, model.sums, model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = deviations(_matrix(batch), n, sums)
                y = (d.astype(float) / n) @ scaled
                offsets = np.arange(len(d) + 1, dtype=np.int32) * y.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(y.ravel()))
                lengths = pa.array(squared_lengths(d), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], lengths, lists], names=["vec_id", "deviation", "whitened"]
                )

    return rows.mapInArrow(run, PROJECTED)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening]:
    """The whitened rows of `vectors` (vec_id, embedding) and the model fitted on all of them."""
    ship(vectors.sparkSession)
    rows = usable(vectors)
    model = Whitening(rows, components)
    return whitened(rows, model), model


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's whitened coordinates, one row per component."""
    rows, model = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares.cast("array<double>"), F.col("_at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
