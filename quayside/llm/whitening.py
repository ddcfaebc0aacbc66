"""Whitening of vectors: leading eigenvectors by spectrum slicing and Rayleigh quotient iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.vectors import padded, sound
from quayside.scratch import Workspace

EPS = np.finfo(float).eps
#: Eigenvalues closer than this share of the largest are one group, whose vectors span one space.
CLOSE = 1e-11
#: A component below this share of the largest eigenvalue is rounding error, and has no scale.
NOTHING = 1e-10
ROUNDS = 40


@dataclass(frozen=True)
class Whitening:
    """Parameters: an entry c counts as floor(scale * c) + shift; up to ``components`` are given."""

    scale: int = 1024
    shift: int = 100_000
    components: int = 8


def whiten(rows: DataFrame, p: Whitening | None = None) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every sound vector.

    ``rows`` has ``vec_id`` and ``embedding``. Rows whose vector is NULL or has NULL or
    non-finite entries are left out, a shorter vector counts as if it ended in zeros, rows that repeat
    come as often as they are there, a NULL id stays NULL. Columns besides these two are left
    out. Components whose eigenvalue is rounding error (a constant table has no others) are
    not given, so an empty table or one row gives no rows. A deviation that does not fit 64
    bits is NULL.

    Sums and products are added up as whole numbers, so the covariance does not depend on how
    the rows are dealt; the driver gets one number per pair of dimensions, however many rows
    there are, and finds the eigenvectors from those.
    """
    p = p or Whitening()
    work = Workspace(rows.sparkSession, "whitening")
    entries = F.transform(
        "embedding", lambda c: F.floor(F.lit(p.scale) * c.cast("double")).cast("long") + F.lit(p.shift).cast("long")
    )
    kept = rows.where(sound(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("x"))
    kept = work.table(kept, "rows")
    n, width = kept.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    nothing = F.lit(p.shift).cast("long")
    kept = kept.withColumn("x", padded(F.col("x"), width, nothing))

    near = centre(kept, width, n)
    covariance = covariance_of(kept, near, n)
    found = leading(covariance, p.components)
    trace = float(np.trace(covariance))
    done = kept.mapInArrow(projector(near, n, found), "vec_id long, deviation long, whitened array<double>")
    done = work.table(done, "whitened")
    error = distance_to_identity(done, n, len(found))
    explained = F.array(*[F.lit(e / trace) for e, _ in found]).cast("array<double>")
    return done.select("vec_id", "deviation", F.posexplode("whitened").alias("_i", "whitened")).select(
        "vec_id",
        (F.col("_i") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("_i") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


# Sums over all rows, as whole numbers


@dataclass(frozen=True)
class Centre:
    """Per dimension: the sum over all rows, a whole number near the mean, and the largest distance to it."""

    sums: list[int]
    at: np.ndarray
    reach: int

    def rest(self, n: int) -> list[int]:
        """Sums of the distances to ``at``."""
        return [s - n * int(c) for s, c in zip(self.sums, self.at, strict=True)]


def matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A list column whose lists are equally long."""
    n = batch.num_rows
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def partial(batches: Iterator[pa.RecordBatch], add: Callable) -> dict:
    """Whole numbers by place, added up over the batches of a task without overflow."""
    out: dict = {}
    for batch in batches:
        if batch.num_rows:
            add(matrix(batch, "x"), out)
    return out


def sent(cells: dict) -> Iterator[pa.RecordBatch]:
    """Numbers by place as rows; whole numbers travel as text, which has no limit."""
    if cells:
        i, j = np.array(list(cells), dtype=np.int32).T
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array([str(v) for v in cells.values()])], names=["i", "j", "value"])


PLACES = "i int, j int, value string"


def centre(rows: DataFrame, width: int, n: int) -> Centre:
    def add(x: np.ndarray, out: dict) -> None:
        total = x.sum(axis=0) if np.abs(x).max(initial=0) < 2**62 // len(x) else x.astype(object).sum(axis=0)
        for i in range(x.shape[1]):
            out[i, 0] = out.get((i, 0), 0) + int(total[i])
            out[i, 1] = min(out.get((i, 1), int(x[0, i])), int(x[:, i].min()))
            out[i, 2] = max(out.get((i, 2), int(x[0, i])), int(x[:, i].max()))

    numbers = rows.mapInArrow(lambda batches: sent(partial(batches, add)), PLACES).withColumn(
        "value", F.col("value").cast("decimal(38,0)")
    )
    found = numbers.groupBy("i").agg(
        F.sum(F.when(F.col("j") == 0, F.col("value"))).alias("total"),
        F.min(F.when(F.col("j") == 1, F.col("value"))).alias("least"),
        F.max(F.when(F.col("j") == 2, F.col("value"))).alias("most"),
    )
    by_place = {r["i"]: (int(r["total"]), int(r["least"]), int(r["most"])) for r in found.collect()}
    sums = [by_place[i][0] for i in range(width)] if n else [0] * width
    at = [(2 * s + n) // (2 * n) if n else 0 for s in sums]
    reach = max((max(by_place[i][2] - c, c - by_place[i][1]) for i, c in enumerate(at)), default=0) if n else 0
    return Centre(sums, np.array(at, dtype=np.int64), reach)


def covariance_of(rows: DataFrame, near: Centre, n: int) -> np.ndarray:
    """The covariance with divisor n, each entry the double nearest to its exact value."""
    width = len(near.sums)

    def add(x: np.ndarray, out: dict) -> None:
        y = x - near.at
        most = near.reach**2 * len(y)
        kind = np.float64 if most < 2**53 else np.int64 if most < 2**63 else object
        y = y.astype(kind)
        products = (y.T @ y).astype(object)
        for i in range(width):
            for j in range(i, width):
                out[i, j] = out.get((i, j), 0) + int(products[i, j])

    numbers = rows.mapInArrow(lambda batches: sent(partial(batches, add)), PLACES)
    found = numbers.groupBy("i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    rest, covariance = near.rest(n), np.zeros((width, width))
    for i, j, value in found.collect():
        covariance[i, j] = covariance[j, i] = (n * int(value) - rest[i] * rest[j]) / (n * n)
    return covariance


def projector(near: Centre, n: int, found: list[tuple[float, np.ndarray]]):
    """Rows to their deviation and whitened coordinates."""
    rest = np.array(near.rest(n), dtype=object)
    shift = np.array([r / n for r in rest]) if n else np.zeros(len(rest))
    width = len(rest)
    scaled = np.stack([v / np.sqrt(e) for e, v in found], axis=1) if found else np.zeros((width, 0))
    largest = width * (n * near.reach + max((abs(r) for r in rest), default=0)) ** 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = matrix(batch, "x") - near.at
            kind = np.int64 if largest < 2**63 else object
            off = n * y.astype(kind) - rest.astype(kind)
            squares = (off * off).sum(axis=1)
            fits = [int(s) if s < 2**63 else None for s in squares] if kind is object else squares
            white = (y - shift) @ scaled
            offsets = np.arange(len(y) + 1, dtype=np.int32) * white.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))
            yield pa.record_batch(
                [batch.column("vec_id"), pa.array(fits, pa.int64()), lists], names=["vec_id", "deviation", "whitened"]
            )

    return run


def distance_to_identity(done: DataFrame, n: int, count: int) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    if not n or not count:
        return 0.0

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count))
        for batch in batches:
            if batch.num_rows:
                w = matrix(batch, "whitened")
                total[:count] += w.T @ w
                total[count] += w.sum(axis=0)
        i, j = np.indices(total.shape, dtype=np.int32)
        yield pa.record_batch([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "value"])

    found = done.select("whitened").mapInArrow(sums, "i int, j int, value double")
    total = np.zeros((count + 1, count))
    for i, j, value in found.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        total[i, j] = value
    mean = total[count] / n
    return float(np.abs(total[:count] / n - np.outer(mean, mean) - np.eye(count)).max())


# Eigenvalues of a symmetric matrix, on the driver: its size is that of one vector, squared


def count_above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above ``shift``: positive pivots of an LDLᵀ factorisation.

    By Sylvester's law the pivots of ``a - shift`` have the signs of its eigenvalues. The largest
    entry left is taken as pivot, alone or as a block of two, which keeps the factors small.
    """
    m = a - shift * np.eye(len(a))
    positive = 0
    while len(m):
        diagonal = np.abs(np.diagonal(m))
        beside = np.abs(m - np.diag(np.diagonal(m)))
        i = int(diagonal.argmax())
        p, q = divmod(int(beside.argmax()), len(m))
        if max(diagonal[i], beside[p, q]) == 0:
            return positive
        # Fixed value: (1 + sqrt(17)) / 8 bounds the growth of either kind of pivot alike.
        if diagonal[i] >= (1 + 17**0.5) / 8 * beside[p, q]:
            pivot = [i]
            positive += m[i, i] > 0
        else:
            pivot = [p, q]
            positive += 1  # such a block has one eigenvalue of each sign
        others = np.setdiff1d(np.arange(len(m)), pivot)
        across = m[np.ix_(others, pivot)]
        m = m[np.ix_(others, others)] - across @ np.linalg.solve(m[np.ix_(pivot, pivot)], across.T)
        m = (m + m.T) / 2
    return positive


def leading(a: np.ndarray, count: int) -> list[tuple[float, np.ndarray]]:
    """The largest eigenvalues of a covariance, falling, each with a unit eigenvector.

    Bisection by inertia counts cuts the spectrum until every leading eigenvalue has an
    interval of its own, or lies in a group too close to tell apart.
    """
    norm = float(np.abs(a).sum(axis=1).max(initial=0.0))
    if norm == 0:
        return []
    count = min(count, len(a))
    found: list[tuple[float, np.ndarray]] = []
    # intervals, the highest last: low, high, eigenvalues above each
    todo = [(-norm * 1e-3, norm * (1 + 1e-12), len(a), 0)]
    while todo and len(found) < count:
        low, high, above_low, above_high = todo.pop()
        inside = above_low - above_high
        if inside == 0:
            continue
        if inside == 1 and (one := single(a, low, high, above_high, norm)):
            found.append(one)
        elif high - low <= CLOSE * norm:
            found += group(a, (low + high) / 2, inside)
        else:
            middle = (low + high) / 2
            above = count_above(a, middle)
            todo += [(low, middle, above_low, above), (middle, high, above, above_high)]
    largest = found[0][0] if found else 0.0
    return [(e, v) for e, v in found[:count] if e > NOTHING * largest]


def solved(a: np.ndarray, shift: float, b: np.ndarray, norm: float) -> np.ndarray:
    """The solution of ``(a - shift) x = b`` up to a factor; beside an eigenvalue x grows along its vector."""
    for beside in (0, 4 * EPS * norm, 64 * EPS * norm):
        try:
            x = np.linalg.solve(a - (shift + beside) * np.eye(len(a)), b)
        except np.linalg.LinAlgError:
            continue
        if np.abs(x).max() < 1e150:
            return x / np.abs(x).max()
    return b


def single(a: np.ndarray, low: float, high: float, number: int, norm: float) -> tuple[float, np.ndarray] | None:
    """The one eigenvalue within an interval by Rayleigh quotients; None if they leave it.

    ``number`` eigenvalues are above it, which two counts around the value found certify.
    """
    v = np.random.default_rng(len(a)).standard_normal(len(a))
    shift = (low + high) / 2
    for _ in range(3):
        v = solved(a, shift, v / np.linalg.norm(v), norm)
    v /= np.linalg.norm(v)
    best, residual = shift, np.inf
    for _ in range(ROUNDS):
        value = float(v @ a @ v)
        left = float(np.linalg.norm(a @ v - value * v))
        if not low <= value <= high:
            return None
        if left >= residual / 2:
            break
        best, residual = value, left
        v = solved(a, value, v, norm)
        v /= np.linalg.norm(v)
    v /= np.linalg.norm(v)
    best = float(v @ a @ v)
    around = 4 * max(float(np.linalg.norm(a @ v - best * v)), len(a) * EPS * norm)
    if count_above(a, best + around) != number or count_above(a, best - around) != number + 1:
        return None
    return best, v


def group(a: np.ndarray, shift: float, size: int) -> list[tuple[float, np.ndarray]]:
    """Eigenvalues too close to tell apart: an orthonormal base of their common space."""
    norm = float(np.abs(a).sum(axis=1).max())
    base = np.linalg.qr(np.random.default_rng(len(a)).standard_normal((len(a), size)))[0]
    for _ in range(8):
        base = np.linalg.qr(solved(a, shift, base, norm))[0]
    inner, turn = np.linalg.eigh(base.T @ a @ base)
    vectors = base @ turn
    return [(float(inner[k]), vectors[:, k]) for k in reversed(range(size))]
