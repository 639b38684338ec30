"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are taken in fixed point, x = floor(scale * entry) + shift, as longs, so counts and
sums are exact; a centred entry is (n * x - S) / n, with the subtraction in whole numbers.

With X the centred rows, the bidiagonalisation makes X V = U B with orthonormal V and U and an
upper bidiagonal B. A right vector is a few doubles and lives on the driver. A left vector has
an entry per row and is never stored: it is X w for a short w that obeys the same recurrence.
So each step is one pass over the rows, in which every task makes p = X w of its rows and hands
on Xᵀp, one number per dimension, and the norm of p. Both sides are reorthogonalised in full:
the left one by Uᵀp = Wᵀ(Xᵀp), which the pass has given already. A step that breaks down starts
anew from a random direction orthogonal to all before. The singular values and right vectors of
B, turned by V, are those of X.

Steps end when all dimensions are used, or earlier when the wanted components have converged
and the variance that is still unaccounted for is less than the last wanted component's, so
that no component can be missed. Tasks hold one batch of rows at a time; what comes to the
driver is a few numbers per dimension and pass. The written rows are read in each pass, so a
lost executor costs its own tasks only.

Defined cases: a vector that is null, or holds a null, a NaN or an infinity, is left out; a
shorter vector counts as filled up with zeros; repeated rows count and are returned each; a
null id is an id like any other; components without variance (a standard deviation below
``RANK`` of the largest) are not returned, so equal vectors, a single one or an empty table
give no rows; other columns are ignored. Entries or counts so large that the whole numbers
would pass 63 bits end the job with an error.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Smallest standard deviation of a component, as a share of the largest.
RANK = 1e-9
#: Largest residual of a converged component, as a share of the largest singular value.
SETTLED = 1e-14
_LARGEST = 1 << 62


@dataclass
class Whitening:
    """n vectors of ``sums``; ``components`` has one row per component, unit length, by falling ``variances``."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float


def fixed_point(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and the vector x of every usable row."""
    vector = vectors[vector_col].cast("array<double>")
    unusable = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    limit = float(1 << 53)
    too_large = F.raise_error(F.lit("an entry is too large for fixed point")).cast("long")
    x = F.transform(vector, lambda c: F.when(F.abs(c) * SCALE < limit, F.floor(c * SCALE) + SHIFT).otherwise(too_large))
    rows = vectors.select(vectors[id_col].alias("vec_id"), x.alias("x"), (vector.isNull() | unusable).alias("unusable"))
    return rows.where(~F.col("unusable")).drop("unusable")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as a matrix of longs, shorter ones filled up with what a zero becomes."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.full((len(sizes), width), SHIFT, np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _summed(rows: DataFrame, width: int, per_batch: Callable[[np.ndarray], np.ndarray], kind: type, size: int) -> np.ndarray:
    """``per_batch`` of all rows, added up in each task and then over the tasks; it gives ``size`` numbers."""
    name = "long" if kind is np.int64 else "double"

    def run(batches):
        total = np.zeros(size, kind)
        for batch in batches:
            total += per_batch(matrix(batch.column("x"), width))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["place", "value"])

    out = np.zeros(size, kind)
    found = rows.select("x").mapInArrow(run, f"place int, value {name}").groupBy("place").agg(F.sum("value").alias("value"))
    for row in found.collect():
        out[row["place"]] = row["value"]
    return out


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def bidiagonalise(product: Callable[[np.ndarray], tuple[np.ndarray, float]], width: int, trace: float, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right singular vectors, one per row, of the matrix X behind ``product``.

    ``product(w)`` gives XᵀXw and the squared length of Xw; ``trace`` is the sum of all squared entries of X.
    """
    rng = np.random.default_rng(13)
    right, short, back = (np.zeros((width, width)) for _ in range(3))  # v, w and Xᵀu of each step, as rows
    alphas, betas = np.zeros(width), np.zeros(width)
    tiny = 1e-13 * np.sqrt(trace)

    def orthogonal(v: np.ndarray, k: int) -> np.ndarray:
        for _ in range(2):
            v = v - right[:k].T @ (right[:k] @ v)
        return v

    v = rng.normal(size=width)
    v /= np.linalg.norm(v)
    k = 0
    while True:
        w = v - betas[k - 1] * short[k - 1] if k else v.copy()
        y, square = product(w)
        for _ in range(2):
            along = short[:k] @ y
            w, y, square = w - along @ short[:k], y - along @ back[:k], square - along @ along
        alpha = np.sqrt(max(square, 0.0))
        right[k] = v
        if alpha > tiny:
            alphas[k], short[k], back[k] = alpha, w / alpha, y / alpha
        rest = orthogonal(back[k] - alphas[k] * v, k + 1)
        beta = np.linalg.norm(rest)
        k += 1
        if k == width:
            break
        if beta <= tiny:
            rest, beta = orthogonal(rng.normal(size=width), k), 0.0
        betas[k - 1] = beta
        v = rest / np.linalg.norm(rest)
        if k >= wanted and beta:
            left, sigma, _ = np.linalg.svd(np.diag(alphas[:k]) + np.diag(betas[: k - 1], 1))
            settled = beta * np.abs(left[-1, :wanted]).max() <= SETTLED * sigma[0]
            if settled and trace - (sigma**2).sum() < sigma[wanted - 1] ** 2:
                break
    _, sigma, turned = np.linalg.svd(np.diag(alphas[:k]) + np.diag(betas[: k - 1], 1))
    return sigma, turned @ right[:k]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of the vectors x of ``rows``, which is read many times."""
    n, width = rows.agg(F.count("x"), F.max(F.size("x"))).first()
    width = width or 0
    if not n or not width:
        return Whitening(n, np.zeros(width, np.int64), np.zeros((0, width)), np.zeros(0), 0.0)
    largest = max(rows.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0] or 0, SHIFT)
    if n * largest >= _LARGEST:
        raise OverflowError(f"{n} vectors with entries up to {largest} are too large for exact sums")
    sums = _summed(rows, width, lambda x: x.sum(axis=0), np.int64, width)
    trace = float(_summed(rows, width, lambda x: np.square(centred(x, n, sums)).sum(axis=0), np.float64, width).sum())
    if not trace:
        return Whitening(n, sums, np.zeros((0, width)), np.zeros(0), 0.0)

    def product(w: np.ndarray) -> tuple[np.ndarray, float]:
        def part(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            p = c @ w
            return np.append(p @ c, p @ p)

        found = _summed(rows, width, part, np.float64, width + 1)
        return found[:-1], found[-1]

    sigma, vectors = bidiagonalise(product, width, trace, min(components, width))
    kept = int((sigma[:components] > RANK * sigma[0]).sum())
    vectors = vectors[:kept]
    signs = np.sign(vectors[np.arange(kept), np.abs(vectors).argmax(axis=1)])  # the largest entry is positive
    return Whitening(n, sums, vectors * signs[:, None], sigma[:kept] ** 2 / n, trace / n)


def _project(x: np.ndarray, model: Whitening) -> np.ndarray:
    return centred(x, model.n, model.sums) @ (model.components / np.sqrt(model.variances)[:, None]).T


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity; 0 without components."""
    k, width = len(model.variances), len(model.sums)
    if not k:
        return 0.0

    def part(x: np.ndarray) -> np.ndarray:
        z = _project(x, model)
        return np.append(z.sum(axis=0), z.T @ z)

    found = _summed(rows, width, part, np.float64, k + k * k) / model.n
    mean, square = found[:k], found[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (the sum over dimensions of (n * x - S)², exact) and whitened, an entry per component."""
    width, k = len(model.sums), len(model.variances)
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("x"), width)
            apart = model.n * x - model.sums
            if apart.size and float(np.abs(apart).max()) ** 2 * width >= _LARGEST:
                raise OverflowError("a deviation does not fit into a long")
            z = _project(x, model)
            ends = pa.array(np.arange(len(x) + 1) * k, pa.int32())
            whitened = pa.ListArray.from_arrays(ends, pa.array(z.ravel()))
            deviation = pa.array(np.square(apart).sum(axis=1), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, whitened], names=["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = written(fixed_point(vectors, id_col, vector_col), "vectors")
    model = fit(rows, components)
    error = identity_error(rows, model)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.variances]).cast("array<double>")
    return (
        transform(rows, model)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
        .select(
            "vec_id",
            (F.col("place") + 1).alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("place")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
