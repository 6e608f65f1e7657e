"""Whitening of embeddings: the leading components of their covariance, by Chebyshev-filtered subspace iteration.

Entries become whole numbers, and each distinct vector counts once (the fit list). Its rows are packed into blocks of
whole numbers in the shared folder. One pass over the blocks multiplies the covariance with a narrow matrix: each task
centres its rows, adds up X'(XQ) and sends one matrix, and the matrices are summed entry by entry in Spark; the driver
holds matrices of dimensions x ``WANTED + GUARD`` and never the covariance.

A cycle is a polynomial of the covariance times the block: the three-term recurrence of the Chebyshev polynomial that
is small on the unwanted part of the spectrum (from 0 to the smallest Ritz value of the block) and grows fastest above
it, one pass a degree. Then the block is made orthonormal (QR) and turned to its Ritz vectors (Rayleigh-Ritz). The
cycles end when the residuals of the wanted pairs certify them: an eigenvalue lies within the residual of each Ritz
value, and the residual over the gap bounds the error of the vector.

Defined cases: vectors that are null, or hold null or non-finite entries or such whose whole number does not fit a
long, take no part, nor do vectors of another length than the most frequent (the longer on a tie). Repeated rows are
all returned and count once in the fit list. Components with no variance (fewer distinct vectors than dimensions, or
only one) are not returned; with equal eigenvalues any orthonormal choice may come out. ``deviation`` is null where it
does not fit a long. An empty table gives no rows; further columns of any name are ignored; texts play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import ship
from shelfwise.operators.materialise import settle

ship(__name__)

WANTED = 4
# Further vectors in the block: the filter only has to part the wanted pairs from what lies below all of these.
GUARD = 28
DEGREE = 12
MAX_CYCLES = 200
# Residuals of the wanted pairs, relative to the largest eigenvalue: the aim, and what is accepted when rounding
# keeps a further cycle from improving them.
AIM = 1e-14
ACCEPTED = 1e-11
SCALE = 256
BLOCK_ROWS = 4096
SLICE_ROWS = 1024
LONG = 2.0**63
RESULT = ("component int, n long, deviation long, whitened double, explained double, identity_error double")


@dataclass(frozen=True)
class Fit:
    """The components (columns of unit length), their eigenvalues and what else describes the fit list."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    residuals: np.ndarray
    trace: float
    identity_error: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole_numbers(rows: DataFrame, vector: str) -> DataFrame:
    """Adds ``__x``, the vector in whole numbers, and leaves out the rows that take no part."""
    c = F.col(f"`{vector}`").cast("array<double>")
    scaled = F.transform(c, lambda v: v * SCALE)
    fine = F.coalesce(F.forall(scaled, lambda v: v.isNotNull() & (F.abs(v) < LONG)), F.lit(False))
    usable = rows.filter(c.isNotNull() & fine).withColumn("__x", F.transform(scaled, lambda v: F.floor(v) + 0))
    length = (usable.groupBy(F.size("__x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.desc("d")).first())
    return usable.filter(F.size("__x") == (length["d"] if length else 0)).filter(F.size("__x") > 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a table of longs."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            x = _matrix(batch.column("__x").slice(at, BLOCK_ROWS))
            most = max(abs(int(x.min())), abs(int(x.max())))
            kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
            yield pa.record_batch([pa.array([len(x)], pa.int32()), pa.array([kind]),
                                   pa.array([x.astype(kind).tobytes()], pa.binary())], ["rows", "kind", "data"])


def _blocks(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for rows, kind, data in zip(*(batch.column(c) for c in ("rows", "kind", "data"))):
        yield np.frombuffer(data.as_buffer(), kind.as_py()).reshape(rows.as_py(), -1)


def _summed(blocks: DataFrame, measure, size: int) -> np.ndarray:
    """The sum over all blocks of ``measure(block)``, an array of ``size`` doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in _blocks(batch):
                part = measure(block)
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["at", "value"])

    lines = blocks.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    for line in lines:
        out[line["at"]] = line["value"]
    return out


def _exact_sums(blocks: DataFrame) -> tuple[int, list[int]]:
    """Rows and the exact sum of each dimension; halves of the numbers are added, so nothing overflows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for batch in batches:
            for block in _blocks(batch):
                x = block.astype(np.int64)
                n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.record_batch([pa.array(np.arange(len(high), dtype=np.int32)), pa.array(high), pa.array(low),
                                   pa.array(np.full(len(high), n, np.int64))], ["at", "high", "low", "n"])

    lines = (blocks.mapInArrow(run, "at int, high long, low long, n long").groupBy("at")
             .agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]).orderBy("at").collect())
    return (int(lines[0]["n"]), [(int(line["high"]) << 32) + int(line["low"]) for line in lines]) if lines else (0, [])


def _product(blocks: DataFrame, n: int, mean: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, float]:
    """The covariance times ``q``, and its trace: one pass."""
    def measure(block: np.ndarray) -> np.ndarray:
        total = np.zeros(q.size + 1)
        for at in range(0, len(block), SLICE_ROWS):
            x = block[at:at + SLICE_ROWS] - mean
            total[:-1] += (x.T @ (x @ q)).ravel()
            total[-1] += np.einsum("ij,ij->", x, x)
        return total

    found = _summed(blocks, measure, q.size + 1) / n
    return found[:-1].reshape(q.shape), float(found[-1])


def _identity_error(blocks: DataFrame, n: int, mean: np.ndarray, turn: np.ndarray) -> float:
    """The largest entry of the covariance of the whitened fit list minus the identity: one pass."""
    k = turn.shape[1]

    def measure(block: np.ndarray) -> np.ndarray:
        w = (block - mean) @ turn
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    found = _summed(blocks, measure, k * k + k) / n
    centre = found[k * k:]
    return float(np.abs(found[:k * k].reshape(k, k) - np.outer(centre, centre) - np.eye(k)).max())


def fit(rows: DataFrame, wanted: int = WANTED, guard: int = GUARD, degree: int = DEGREE) -> Fit | None:
    """Fit on the distinct vectors of ``rows`` (column ``__x``); None if there are none."""
    packed = settle(rows.select("__x").distinct().mapInArrow(_packed, "rows int, kind string, data binary"), "blocks")
    blocks = packed.frame
    n, sums = _exact_sums(blocks)
    if not n:
        return None
    d = len(sums)
    mean = np.array([s / n for s in sums])
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((d, min(d, wanted + guard))))[0]
    wanted = min(wanted, d)
    before, passes = np.inf, 0
    for _ in range(MAX_CYCLES):
        product, trace = _product(blocks, n, mean, q)
        passes += 1
        # Rayleigh-Ritz: the block turns to its Ritz vectors, and the product with it.
        inner = q.T @ product
        ritz, turn = np.linalg.eigh((inner + inner.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        residuals = np.linalg.norm(product[:, :wanted] - q[:, :wanted] * ritz[:wanted], axis=0)
        worst = residuals.max() / ritz[0] if ritz[0] > 0 else 0.0
        if worst <= AIM or (worst <= ACCEPTED and worst > before / 2) or q.shape[1] == d:
            break
        before = worst
        # Chebyshev recurrence, scaled by its value at the largest Ritz value so that nothing overflows.
        centre = half = max(ritz[-1], ritz[0] * 1e-6) / 2
        sigma = first = half / (ritz[0] - centre)
        last, now = q, (product - centre * q) * (sigma / half)
        for _ in range(degree - 1):
            step = 1 / (2 / first - sigma)
            moved = _product(blocks, n, mean, now)[0] - centre * now
            passes += 1
            last, now, sigma = now, moved * (2 * step / half) - last * (sigma * step), step
        q = np.linalg.qr(now)[0]
    else:
        raise RuntimeError(f"residual {worst:.1e} after {MAX_CYCLES} cycles")
    # Rounding leaves variances of about this size where there are none.
    kept = int(np.sum(ritz[:wanted] > max(ritz[0], 0.0) * d * 1e-15)) if ritz[0] > 0 else 0
    vectors, values = q[:, :kept], ritz[:kept]
    error = _identity_error(blocks, n, mean, vectors / np.sqrt(values)) if kept else 0.0
    packed.delete()
    return Fit(n, tuple(sums), vectors, values, residuals[:kept], trace, error, passes)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sums over the dimensions of (n x - S) squared; None where a long cannot hold one."""
    most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    bound = n * most + max(abs(s) for s in sums)
    if bound * bound * len(sums) < 2**63:
        moved = x * n - np.array(sums, np.int64)
        return np.einsum("ij,ij->i", moved, moved).tolist()
    found = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in found]


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", wanted: int = WANTED,
           guard: int = GUARD, degree: int = DEGREE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for each row and component."""
    kind = rows.schema[vec_id].dataType.simpleString()
    usable = whole_numbers(rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("__v")), "__v")
    usable = usable.select("vec_id", "__x")
    found = fit(usable, wanted, guard, degree)
    schema = f"vec_id {kind}, {RESULT}"
    if found is None or not len(found.values):
        return rows.sparkSession.createDataFrame([], schema)
    k, n, sums, mean = len(found.values), found.n, found.sums, found.mean
    turn = found.vectors / np.sqrt(found.values)
    explained, error = found.values / found.trace, found.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                x = _matrix(part.column("__x"))
                rows = len(x)
                each = pa.array(np.repeat(np.arange(rows), k))
                yield pa.record_batch([
                    part.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)), pa.array(_deviations(x, n, sums), pa.int64()).take(each),
                    pa.array(((x - mean) @ turn).ravel()), pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.mapInArrow(run, schema)
