"""Whitening of integer vectors: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

The fit list has each distinct vector once. Partial sums of tasks give its size and its sums; a
second pass subtracts the integer next to the mean in each dimension before it multiplies, so the
scatter is exact in doubles as long as its entries are below 2 ** 53, whatever the order of
partial sums, and what is left of the mean is subtracted in integers. The driver holds only
that d x d scatter: Cholesky with diagonal pivoting factors it, Jacobi rotations make the columns of the
triangular factor orthogonal. Their squared norms are the eigenvalues of the scatter, the
normalised columns its eigenvectors; nothing is squared again, so small eigenvalues keep their digits.
A last pass measures the covariance of what comes out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from glyphline.llm.common import as_text, query, table, written

COMPONENTS = 16
SWEEPS = 60
#: Doubles below this are exact integers.
EXACT = 2.0**53


@dataclass(frozen=True)
class Whitening:
    """A fit: ``near`` is the integer next to the mean and ``rest`` the sums of what that leaves, per dimension."""

    n: int
    near: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.near) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sum) ** 2, exactly; None where it is no long."""
        y = x - self.near
        most = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if most**2 * max(1, y.shape[1]) < 2**63:
            return ((self.n * y - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * y.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


def quantised(vector: str | Column, scale: int = 64, offset: int = 1_000_000) -> Column:
    """floor(scale * c) + offset of every entry, as longs; null for a vector with an entry that is null,
    not finite, or too large for the product to be an exact integer."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    plain = F.transform(vector, lambda c: c.cast("double"))
    sound = F.forall(plain, lambda c: F.coalesce(F.abs(c * scale) < EXACT, F.lit(False)))
    return F.when(sound, F.transform(plain, lambda c: F.floor(c * scale) + F.lit(offset).cast("bigint")))


def by_size(column: pd.Series) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """size, places and matrix of the vectors of each size."""
    sizes = column.map(len).to_numpy()
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size), at, np.stack(column.iloc[at].to_numpy()).astype(np.int64, copy=False)


def _moments(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """n and the exact sums for each vector size. High and low halves are summed apart, so no sum of a task overflows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, list] = {}
        for batch in batches:
            for size, _, x in by_size(batch["x"]):
                own = total.setdefault(size, [0, np.zeros(size, object), np.zeros(size, object)])
                own[0] += len(x)
                own[1] += (x >> 20).sum(axis=0).astype(object)
                own[2] += (x & 0xFFFFF).sum(axis=0).astype(object)
        for size, (n, high, low) in total.items():
            yield pd.DataFrame({
                "size": size, "place": range(size), "n": n, "high": high.astype(np.int64), "low": low.astype(np.int64),
            })

    parts = fit.mapInPandas(run, "size int, place int, n bigint, high bigint, low bigint")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = parts.groupBy("size", "place").agg(F.sum("n").alias("n"), exact("high"), exact("low")).orderBy("size", "place").collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r["size"], (r["n"], []))[1].append((int(r["high"]) << 20) + int(r["low"]))
    return out


def _summed(fit: DataFrame, held, products) -> dict[int, dict[tuple[int, int], float]]:
    """Sum over the fit list of the matrices that ``products`` makes of its blocks, for each vector size.

    Tasks hold one matrix per size and send its cells; cells meet as partial sums.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in by_size(batch["x"]):
                made = products(held.value[size], x)
                total[size] = total[size] + made if size in total else made
        for size, cells in total.items():
            i, j = np.indices(cells.shape)
            yield pd.DataFrame({"size": size, "i": i.ravel(), "j": j.ravel(), "v": cells.ravel()})

    parts = fit.mapInPandas(run, "size int, i int, j int, v double")
    cells = parts.groupBy("size", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = {}
    for size, own in cells.groupby("size"):
        matrix = np.zeros((own["i"].max() + 1, own["j"].max() + 1))
        matrix[own["i"], own["j"]] = own["v"]
        out[int(size)] = matrix
    return out


def scatter(model: Whitening, products: np.ndarray) -> np.ndarray:
    """The centred scatter from that around the near integers; in integers while those are exact."""
    if np.abs(products).max(initial=0) < EXACT:
        whole = np.vectorize(int, otypes=[object])(products)
        rest = model.rest.astype(object)
        return ((model.n * whole - np.outer(rest, rest)) / model.n).astype(float)
    return products - np.outer(model.rest, model.rest / model.n)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L @ L.T, its rows in the order of ``a`` and as many columns as ``a`` has rank.

    Each step takes the largest remaining diagonal entry; with the rows in that order L is lower triangular.
    """
    d = len(a)
    left = np.diag(a).astype(float).copy()
    factor = np.zeros((d, d))
    limit = d * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(d):
        pivot = int(left.argmax())
        if left[pivot] <= limit:
            return factor[:, :k]
        column = (a[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / np.sqrt(left[pivot])
        column[np.isneginf(left)] = 0.0
        column[pivot] = np.sqrt(left[pivot])
        factor[:, k] = column
        left -= column**2
        left[pivot] = -np.inf
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """The columns of ``factor`` rotated until they are orthogonal, longest first.

    A sweep visits every pair of columns once, in rounds of pairs without a common column, so
    the rotations of a round are done together.
    """
    g = factor[:, np.argsort(-(factor**2).sum(axis=0), kind="stable")]
    r = g.shape[1]
    if r < 2:
        return g
    g = np.concatenate([g, np.zeros((len(g), r % 2))], axis=1)
    seats = np.arange(g.shape[1])
    half = len(seats) // 2
    for _ in range(sweeps):
        turned = False
        for _ in range(len(seats) - 1):
            p, q = seats[:half], seats[half:][::-1]
            x, y = g[:, p], g[:, q]
            a, b, c = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            some = np.abs(c) > np.finfo(float).eps * np.sqrt(a) * np.sqrt(b)
            if some.any():
                turned = True
                x, y, a, b, c = x[:, some], y[:, some], a[some], b[some], c[some]
                zeta = (b - a) / (2 * c)
                tan = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                cos = 1 / np.hypot(1.0, tan)
                sin = cos * tan
                g[:, p[some]], g[:, q[some]] = cos * x - sin * y, sin * x + cos * y
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if not turned:
            break
    norms = (g**2).sum(axis=0)
    return g[:, np.argsort(-norms, kind="stable")[:r]]


def decomposed(model: Whitening, products: np.ndarray, count: int) -> Whitening:
    """The fit with its leading components, the largest entry of each positive."""
    spread = scatter(model, products)
    g = one_sided_jacobi(pivoted_cholesky(spread))
    norms = np.sqrt((g**2).sum(axis=0))
    g, norms = g[:, norms > 0][:, :count], norms[norms > 0][:count]
    unit = g / norms
    if unit.size:
        unit = unit * np.sign(unit[np.abs(unit).argmax(axis=0), np.arange(unit.shape[1])])
    return replace(model, components=unit, eigenvalues=norms**2 / model.n, trace=float(np.trace(spread)) / model.n)


def fit_whitening(vectors: DataFrame, vector_col: str, count: int = COMPONENTS) -> dict[int, Whitening]:
    """A fit for each vector size, from the distinct vectors of integers in ``vector_col``.

    Null vectors, vectors with a null entry and empty vectors take no part; an empty table has no fit. A fit
    has at most ``count`` components, and no more than its vectors span: one distinct vector has none.
    """
    spark = vectors.sparkSession
    x = F.col(vector_col).cast("array<bigint>")
    sound = vectors.select(x.alias("x")).filter((F.size("x") > 0) & ~F.exists("x", lambda c: c.isNull()))
    # copies meet as partial groups, so a vector that many rows have is no hot key
    fit = written(sound.distinct(), "fit")
    models = {}
    for size, (n, sums) in _moments(fit).items():
        near = [(2 * s + n) // (2 * n) for s in sums]
        rest = np.array([s - n * m for s, m in zip(sums, near)], np.int64)
        models[size] = Whitening(n, np.array(near, np.int64), rest, np.zeros((size, 0)), np.zeros(0), 0.0)
    if not models:
        return models

    def around(model: Whitening, x: np.ndarray) -> np.ndarray:
        y = (x - model.near).astype(float)
        return y.T @ y

    def covariance(model: Whitening, x: np.ndarray) -> np.ndarray:
        w = np.concatenate([model.whitened(x), np.ones((len(x), 1))], axis=1)
        return w.T @ w

    products = _summed(fit, spark.sparkContext.broadcast(models), around)
    models = {size: decomposed(model, products[size], count) for size, model in models.items()}
    for size, sums in _summed(fit, spark.sparkContext.broadcast(models), covariance).items():
        model, mean = models[size], sums[-1, :-1] / sums[-1, -1]
        own = sums[:-1, :-1] / sums[-1, -1] - np.outer(mean, mean) - np.eye(len(mean))
        models[size] = replace(model, identity_error=float(np.abs(own).max(initial=0.0)))
    return models


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "x", models: dict[int, Whitening] | None = None,
    count: int = COMPONENTS,
) -> DataFrame:
    """vec_id, n, deviation, whitened, explained, identity_error: one row per vector of integers that has a fit.

    ``whitened`` and ``explained`` are arrays by component. Vectors of several sizes have fits of their own;
    vectors that took no part in the fit have no row; a null or repeated id is carried through; an empty
    table gives an empty result; other columns are not read. ``deviation`` is null where it is no long.
    """
    spark = vectors.sparkSession
    models = fit_whitening(vectors, vector_col, count) if models is None else models
    held = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, at, x in by_size(batch["x"]):
                if size not in held.value:
                    continue
                model = held.value[size]
                yield pd.DataFrame({
                    "vec_id": batch["vec_id"].iloc[at].to_numpy(), "n": model.n,
                    "deviation": pd.array(model.deviations(x), dtype="Int64"),
                    "whitened": list(model.whitened(x)),
                    "explained": [model.eigenvalues / model.trace if model.trace else model.eigenvalues] * len(x),
                    "identity_error": model.identity_error,
                })

    rows = vectors.select(as_text(id_col).alias("vec_id"), F.col(vector_col).cast("array<bigint>").alias("x"))
    rows = rows.filter((F.size("x") > 0) & ~F.exists("x", lambda c: c.isNull()))
    kinds = (
        "vec_id string, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"
    )
    found = rows.mapInPandas(run, kinds)
    return found.withColumn("vec_id", F.col("vec_id").cast(vectors.schema[id_col].dataType))


@query()
def op12_embedding_whitening(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", quantised("embedding").alias("x"))
    found = whiten(rows).select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")))
    return found.select(
        "vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", "col.whitened", "col.explained", "identity_error"
    )
