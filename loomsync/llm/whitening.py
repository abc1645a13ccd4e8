"""Whitening of embedding vectors by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become integers; the distinct ones are the fit list X. Starting from a random unit
vector, alternating products X v and X'u on the centred rows build two orthonormal sequences
in which X is bidiagonal; each new vector of either sequence is orthogonalised against all
before it. The singular values of the small bidiagonal matrix are the deviations, and its right
singular vectors, carried back, are the components.

The long sequence u grows with the table, so it is never stored. Every u is X times a short
vector p that the driver keeps, so a task gets the entries of all earlier u from the rows at
hand. One job per step multiplies the rows with the new direction and with all p, and sums the
norm, the products with the earlier u, and the product with X': at most ``2 * dimensions + 1``
numbers, added up on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from loomsync.llm.common import extended, map_batches
from loomsync.session import staged

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Scaled entries beyond this are set to it, so that each one is an exact double.
LARGEST = 1 << 52
#: A direction shorter than this share of the longest one counts as nothing.
NOTHING = 1e-11
#: Error of a component, in the units of the gap to its neighbours, at which the steps may end.
SETTLED = 1e-13


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: ``n`` distinct vectors, the exact sums of their entries, components as columns."""

    n: int
    sums: tuple[int, ...]  # without OFFSET
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def usable(vector: str) -> F.Column:
    """Not null, not empty, and no entry null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def _scaled(column: pa.ListArray, rows: int, scale: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    return np.clip(np.floor(scale * flat), -LARGEST, LARGEST).astype("<i8")


def _dimension(vectors: DataFrame, vector: str) -> int:
    """The most frequent length, of equals the largest."""
    lengths = vectors.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head(1)
    return lengths[0]["d"] if lengths else 0


def _fit_list(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """The distinct scaled vectors, many to a row: ``block`` (little-endian longs) and ``rows``."""

    def pack(batch: pa.RecordBatch) -> dict:
        return {"x": [row.tobytes() for row in _scaled(batch.column(vector), batch.num_rows, scale)]}

    def join(batch: pa.RecordBatch) -> dict:
        return {"block": [b"".join(batch.column("x").to_pylist())], "rows": [batch.num_rows]}

    distinct = map_batches(vectors.select(vector), pack, "x binary").distinct()
    return staged(map_batches(distinct, join, "block binary, rows long"), "fitlist")


def _summed(blocks: DataFrame, size: int, per_block: Callable[[np.ndarray], np.ndarray], mean: np.ndarray) -> np.ndarray:
    """Sum over the blocks of ``size`` numbers that ``per_block`` makes of centred rows."""
    d = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_ = np.zeros(size), False
        for batch in batches:
            for block in batch.column("block"):
                any_ = True
                rows = np.frombuffer(block.as_buffer(), "<i8").reshape(-1, d)
                total += per_block(rows - mean)
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["slot", "value"])

    sums = blocks.select("block").mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value"))
    made = np.zeros(size)
    for slot, value in sums.collect():  # `size` rows
        made[slot] = value
    return made


def _exact_sums(blocks: DataFrame, d: int) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            for block in batch.column("block"):
                rows = np.frombuffer(block.as_buffer(), "<i8").reshape(-1, d)
                low, high = rows & 0xFFFFFFFF, rows >> 32  # neither sum can leave 64 bits
                total = [t + a + (b << 32) for t, a, b in zip(total, low.sum(0).tolist(), high.sum(0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["slot", "value"])

    sums = blocks.select("block").mapInArrow(run, "slot int, value decimal(38,0)").groupBy("slot").agg(F.sum("value").alias("value"))
    found = dict(sums.collect())
    return [int(found.get(i) or 0) for i in range(d)]


def _fresh(rng: np.random.Generator, basis: list[np.ndarray], d: int) -> np.ndarray:
    """A random unit vector orthogonal to ``basis``."""
    vector = rng.normal(size=d)
    for _ in range(2):
        for v in basis:
            vector -= (v @ vector) * v
    return vector / np.linalg.norm(vector)


def bidiagonalize(product: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]], d: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right singular vectors (columns) of X, largest first.

    ``product(r, p)`` gives for ``w = X r`` the square of its norm, ``(X p)'w`` and ``X'w``. Steps end
    when the ``wanted`` largest are settled, when X has no more directions, or after ``d``.
    """
    rng = np.random.default_rng(11)
    right: list[np.ndarray] = []  # v
    short = np.zeros((d, 0))  # p, with u = X p
    back = np.zeros((d, 0))  # X'u
    diagonal: list[float] = []
    above: list[float] = []  # entry between column j and j + 1
    v, beta, restarted = _fresh(rng, [], d), 0.0, True
    while True:
        r = v - beta * short[:, -1] if beta else v.copy()
        norm2, h, z = product(r, short)
        if h @ h > 0.25 * norm2:  # most of it lay in earlier directions: once more
            r = r - short @ h
            norm2, h, z = product(r, short)
        right.append(v)
        r, z = r - short @ h, z - back @ h
        alpha = float(np.sqrt(max(0.0, norm2 - h @ h)))
        longest = max([alpha, *diagonal, *above])
        empty = alpha <= NOTHING * longest or longest == 0
        diagonal.append(0.0 if empty else alpha)
        short = np.column_stack([short, np.zeros(d) if empty else r / alpha])
        back = np.column_stack([back, np.zeros(d) if empty else z / alpha])
        if len(right) == d or (empty and restarted):
            break
        t = np.zeros(d) if empty else back[:, -1] - alpha * v
        for _ in range(2):
            for known in right:
                t -= (known @ t) * known
        beta = float(np.linalg.norm(t))
        restarted = empty or beta <= NOTHING * longest
        if restarted:
            v, beta = _fresh(rng, right, d), 0.0
        else:
            v = t / beta
            if len(right) > wanted and _settled(diagonal, above, beta, wanted):
                break
        above.append(beta)
    _, values, rows = np.linalg.svd(_bidiagonal(diagonal, above))
    return values, np.column_stack(right) @ rows.T


def _bidiagonal(diagonal: list[float], above: list[float]) -> np.ndarray:
    return np.diag(diagonal) + (np.diag(above[: len(diagonal) - 1], 1) if len(diagonal) > 1 else 0)


def _settled(diagonal: list[float], above: list[float], beta: float, wanted: int) -> bool:
    left, values, _ = np.linalg.svd(_bidiagonal(diagonal, above))
    squares = values**2
    gaps = np.abs(np.diff(squares))
    gap = np.minimum(np.append(gaps, np.inf), np.append(np.inf, gaps))[:wanted]
    return bool(np.all(beta * values[:wanted] * np.abs(left[-1, :wanted]) <= SETTLED * gap))


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The whitening of the distinct usable vectors, None if there are none.

    An entry c counts as floor(``scale`` * c). Of vectors of several lengths those of the most frequent
    one are used. There are as many components as the vectors have independent directions, at
    most ``components``: a direction without deviation cannot be whitened.
    """
    vectors = vectors.where(usable(vector))
    d = _dimension(vectors, vector)
    if not d:
        return None
    blocks = _fit_list(vectors.where(F.size(vector) == d), vector, scale).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = blocks.agg(F.sum("rows")).first()[0]
        sums = _exact_sums(blocks, d)
        mean = np.array([s / n for s in sums])
        square = _summed(blocks, 1, lambda x: np.array([np.einsum("ij,ij->", x, x)]), mean)[0]
        model = Whitening(n, tuple(sums), np.zeros((d, 0)), np.zeros(0), np.zeros(0), 0.0)
        if not square:
            return model

        def product(r: np.ndarray, p: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            k = p.shape[1]

            def rows(x: np.ndarray) -> np.ndarray:
                w = x @ r
                return np.concatenate([[w @ w], (x @ p).T @ w, x.T @ w])

            made = _summed(blocks, 1 + k + d, rows, mean)
            return made[0], made[1 : 1 + k], made[1 + k :]

        values, found = bidiagonalize(product, d, components)
        squares = values**2 / n
        rank = int((squares > d * np.finfo(float).eps * squares[0]).sum())
        k = min(components, rank)
        basis = found[:, :k] / np.linalg.norm(found[:, :k], axis=0)
        to_white = basis / np.sqrt(squares[:k])

        def moments(x: np.ndarray) -> np.ndarray:
            y = x @ to_white
            return np.concatenate([y.sum(0), (y.T @ y).ravel()])

        made = _summed(blocks, k + k * k, moments, mean) / n
        covariance = made[k:].reshape(k, k) - np.outer(made[:k], made[:k])
        return Whitening(n, tuple(sums), basis, squares[:k], squares[:k] * n / square, float(np.abs(covariance - np.eye(k)).max()))
    finally:
        blocks.unpersist()


def _deviation(rows: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum of (n x - S) squared per row, None beyond 64 bits."""
    largest = n * int(np.abs(rows).max(initial=0)) + max(map(abs, sums))
    if largest * largest * len(sums) < 1 << 63:
        away = n * rows - np.array(sums, np.int64)
        return (away * away).sum(1).tolist()
    made = [sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in rows.tolist()]
    return [m if m < 1 << 63 else None for m in made]


def whiten(vectors: DataFrame, model: Whitening | None, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The usable rows of the model's dimension with ``_whitened`` (array of double) and ``_deviation`` (long).

    ``_deviation`` is null where it does not fit a long. Rows that are null or repeated in any other column
    pass as they are; columns of these two names are replaced. No model gives no rows.
    """
    kept = vectors.drop("_whitened", "_deviation").where(usable(vector))
    schema = extended(kept.schema, _whitened="array<double>", _deviation="long")
    if model is None:
        return kept.sparkSession.createDataFrame([], StructType([StructField(f.name, f.dataType) for f in schema]))
    names, mean, n, sums = kept.columns, model.mean, model.n, model.sums
    to_white = model.components / np.sqrt(model.eigenvalues)

    def run(batch: pa.RecordBatch) -> dict:
        rows = _scaled(batch.column(vector), batch.num_rows, scale)
        made = {"_whitened": ((rows - mean) @ to_white).tolist(), "_deviation": _deviation(rows, n, sums)}
        return {c: batch.column(c) for c in names} | made

    return map_batches(kept.where(F.size(vector) == len(sums)), run, schema)


def report(whitened: DataFrame, model: Whitening | None, vec_id: str = "vec_id") -> DataFrame:
    """A row per vector and component, numbered from 1."""
    model = model or Whitening(0, (), np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    rows = whitened.select(F.col(vec_id).alias("vec_id"), "_deviation", F.posexplode("_whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("_deviation").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
