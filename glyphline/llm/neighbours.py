"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample by splitting the largest cluster in two until there
are enough, which keeps lists of like length. Every vector goes to the list of its nearest
centroid, and vectors near a boundary to several lists. A query finds its nearest centroids by
a best-first walk over a neighbour graph of the centroids, held in memory by every task, and
reads the lists whose centroids are not much farther than the nearest one. A query whose
lists hold too few candidates reads all lists.

A list longer than a part is split, and so are the queries of a list, so one task never holds
more than a part of both, whatever the share of vectors in a list.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from glyphline.llm.common import query, table, written

SAMPLE = 20_000
#: Half the square root of the number of vectors is the number of lists, up to what is kept in memory.
MAX_LISTS = 1024
#: Lists of a boundary vector: so many at most, not farther than this ratio of the nearest.
COPIES = 4
COPY_RATIO = 1.15
#: Lists of a query: not farther than a ratio of the nearest, and a few in any case. The ratio is
#: the least at which this share of true neighbours is found for this many rows of the sample.
RECALL = 0.97
TRIALS = 400
LEAST_READ = 8
DEGREE = 16
PART = 4096
NEIGHBOURS = 5
EVERY = 50


def _clean(vectors: list, dim: int) -> np.ndarray:
    """Vectors as doubles, scaled by a power of two so that squares neither overflow nor vanish.

    The scale changes no digit of a cosine.
    """
    x = np.array(vectors, np.float64).reshape(-1, dim)
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0.0))
    return np.ldexp(x, -exponent[:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors to centroids."""
    square = (x * x).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)[None] - 2 * x @ centroids.T
    return np.sqrt(np.maximum(square, 0))


def balanced_centroids(x: np.ndarray, number: int, seed: int = 0) -> np.ndarray:
    """Split the largest cluster by two-means until there are enough, then refine them once together."""
    chance = np.random.default_rng(seed)
    clusters = [(-len(x), 0, np.arange(len(x)))]
    done, tag = [], 1
    while clusters and len(clusters) + len(done) < number:
        _, _, rows = heapq.heappop(clusters)
        part = x[rows]
        pair = part[chance.choice(len(part), 2, replace=False)] if len(part) > 1 else part
        side = np.zeros(len(part), bool)
        for _ in range(8):
            margin = part @ (pair[-1] - pair[0])
            side = margin > np.median(margin)  # halves of like size
            if side.all() or not side.any():
                break
            pair = np.stack([part[~side].mean(axis=0), part[side].mean(axis=0)])
        if side.all() or not side.any():
            done.append(rows)  # equal vectors can't be told apart
            continue
        for half in (rows[~side], rows[side]):
            heapq.heappush(clusters, (-len(half), tag, half))
            tag += 1
    centroids = np.stack([x[rows].mean(axis=0) for rows in done + [c[2] for c in clusters]])
    nearest = _distances(x, centroids).argmin(axis=1)
    filled = [x[nearest == k].mean(axis=0) for k in np.unique(nearest)]
    return np.stack(filled)


class Index:
    """Centroids with their neighbour graph. At most MAX_LISTS rows, so it is sent to every task."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE, seed: int = 0):
        self.centroids = centroids
        apart = _distances(centroids, centroids)
        self.apart = apart
        near = np.argsort(apart, axis=1, kind="stable")[:, 1 : degree + 1]
        # a few far links keep separate groups of centroids within reach of each other
        far = np.random.default_rng(seed).integers(0, len(centroids), (len(centroids), 4))
        links: list[set[int]] = [set(row) for row in np.concatenate([near, far], axis=1).tolist()]
        for k, row in enumerate(near.tolist()):
            for other in row:
                links[other].add(k)
        self.links = [np.array(sorted(x - {k}), np.int64) for k, x in enumerate(links)]
        self.ratio = 1.0
        self.entries = np.unique(np.linspace(0, len(centroids) - 1, min(len(centroids), 16)).astype(np.int64))

    def nearest(self, x: np.ndarray, ratio: float) -> list[tuple[float, int]]:
        """(distance, centroid), nearest first, of a best-first walk that ends beyond ``ratio`` of the nearest."""
        seen = np.zeros(len(self.centroids), bool)
        seen[self.entries] = True
        start = _distances(x[None], self.centroids[self.entries])[0]
        ahead = list(zip(start.tolist(), self.entries.tolist()))
        heapq.heapify(ahead)
        found, least = [], np.inf
        while ahead:
            distance, k = heapq.heappop(ahead)
            least = min(least, distance)
            if distance > ratio * least and len(found) >= LEAST_READ:
                break
            found.append((distance, k))
            fresh = self.links[k][~seen[self.links[k]]]
            seen[fresh] = True
            if len(fresh):
                for item in zip(_distances(x[None], self.centroids[fresh])[0].tolist(), fresh.tolist()):
                    heapq.heappush(ahead, item)
        return sorted(found)

    def read_by(self, x: np.ndarray) -> list[int]:
        """The lists a query reads: by distance ratio, and a few in any case."""
        near = self.nearest(x, self.ratio)
        return [k for i, (d, k) in enumerate(near) if i < LEAST_READ or d <= self.ratio * near[0][0]]

    def calibrate(self, x: np.ndarray, neighbours: int) -> None:
        """Set the ratio from the sample: how far the lists of true neighbours are, against the nearest list."""
        chosen = np.linspace(0, len(x) - 1, min(TRIALS, len(x))).astype(np.int64)
        like = x[chosen] @ x.T
        like[np.arange(len(chosen)), chosen] = -np.inf
        true = np.argsort(-like, axis=1, kind="stable")[:, :neighbours]
        held = dict(zip(np.unique(true).tolist(), self.lists_of(x[np.unique(true)])))
        away = _distances(x[chosen], self.centroids)
        least = np.maximum(away.min(axis=1), 1e-12)
        needed = [away[i, held[j]].min() / least[i] for i, row in enumerate(true.tolist()) for j in row]
        self.ratio = float(max(1.0, np.quantile(needed, RECALL))) if needed else 1.0

    def lists_of(self, x: np.ndarray) -> list[list[int]]:
        """The lists of each vector: the nearest, and others about as near unless one taken is nearer to them."""
        out = []
        for at in range(0, len(x), 2048):
            distance = _distances(x[at : at + 2048], self.centroids)
            k = min(4 * COPIES, distance.shape[1])
            order = np.argpartition(distance, k - 1, axis=1)[:, :k]
            for row, close in zip(distance, order):
                close = close[np.argsort(row[close], kind="stable")]
                taken = [int(close[0])]
                for c in close[1:].tolist():
                    if len(taken) == COPIES or row[c] > COPY_RATIO * row[taken[0]]:
                        break
                    if (self.apart[c, taken] > row[c]).all():
                        taken.append(c)
                out.append(taken)
        return out


def _fit(vectors: DataFrame, dim: int, count: int, neighbours: int) -> Index:
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    sample = _unit(_clean([r[0] for r in rows], dim))
    index = Index(balanced_centroids(sample, max(1, min(MAX_LISTS, isqrt(count) // 2, len(sample)))))
    index.calibrate(sample, neighbours)
    return index


def _best(queries: pd.DataFrame, rows: pd.DataFrame, dim: int, neighbours: int) -> pd.DataFrame:
    """The nearest rows of one part of a list for each query of one part of its queries."""
    columns = ["query_id", "vec_id", "score"]
    if queries.empty or rows.empty:
        return pd.DataFrame({c: [] for c in columns})
    rows = rows.sort_values("vec_id", kind="stable")
    ids, x = rows["vec_id"].to_numpy(), _clean(rows["vector"].tolist(), dim)
    norm = np.sqrt((x * x).sum(axis=1))
    unit = x / norm[:, None]
    found = []
    for at in range(0, len(queries), 512):
        block = queries.iloc[at : at + 512]
        q = _clean(block["vector"].tolist(), dim)
        rough = _unit(q) @ unit.T
        for k, query_id in enumerate(block["query_id"].tolist()):
            line = np.where(ids == query_id, -np.inf, rough[k])
            floor = np.partition(line, -neighbours)[-neighbours] if len(line) > neighbours else -np.inf
            near = np.flatnonzero((line >= floor - 1e-9) & (ids != query_id))
            # equal vectors must get equal scores, so the exact score is summed row by row
            score = (x[near] * q[k]).sum(axis=1) / (norm[near] * np.sqrt((q[k] * q[k]).sum()))
            best = np.lexsort((ids[near], -score))[:neighbours]
            found += [(query_id, int(ids[near[b]]), float(score[b])) for b in best]
    return pd.DataFrame(found, columns=columns)


def _search(queries: DataFrame, lists: DataFrame, dim: int, neighbours: int) -> DataFrame:
    """query_id, rank, vec_id, score from queries with the lists they read (``query_id, vector, list``)."""
    parts = lambda rows, name: rows.groupBy("list").agg(F.ceil(F.count("*") / PART).alias(name))
    shape = parts(lists, "n_parts").join(parts(queries, "n_blocks"), "list")
    by = ["list", "part", "block"]
    spread = lambda key, n: F.pmod(F.xxhash64(key), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    rows = lists.join(shape, "list").select(
        "list", spread("vec_id", "n_parts").alias("part"), every("n_blocks").alias("block"), "vec_id", "vector"
    )
    asked = queries.join(shape, "list").select(
        "list", every("n_parts").alias("part"), spread("query_id", "n_blocks").alias("block"), "query_id", "vector"
    )

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _best(left, right, dim, neighbours)

    found = (
        asked.groupBy(*by).cogroup(rows.groupBy(*by)).applyInPandas(best, "query_id bigint, vec_id bigint, score double")
    )
    return _ranked(found, neighbours)


def _ranked(found: DataFrame, neighbours: int) -> DataFrame:
    """The best of each query, each row once."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nearest = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= neighbours).select(
        "query_id", "rank", "vec_id", "score"
    )


def nearest(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    neighbours: int = NEIGHBOURS, every: int = EVERY,
) -> DataFrame:
    """query_id, rank, vec_id, score: neighbours by cosine of the rows whose id is divisible by ``every``.

    Vectors that are null or zero, or hold a null or a number that is not finite, and rows
    without an id take no part. Vectors of different lengths have no cosine: those of each length have
    an index of their own, and a query's neighbours are among those of its length. Rows that repeat
    an id count once, with their best score; equal scores rank by the smaller id; an empty
    table gives an empty result. Only the two named columns are read.
    """
    vector = F.col("vector")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    usable = (
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .filter(F.col("vec_id").isNotNull() & vector.isNotNull())
        .filter(~F.exists(vector, bad) & F.exists(vector, lambda v: v != 0))
    )
    lengths = usable.groupBy(F.size(vector).alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").collect()
    found = [_of_length(usable.filter(F.size(vector) == r["dim"]), r["dim"], r["n"], neighbours, every) for r in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # an id may come with several lengths
    return found[0] if len(found) == 1 else _ranked(reduce(DataFrame.unionByName, found), neighbours)


def _of_length(usable: DataFrame, dim: int, count: int, neighbours: int, every: int) -> DataFrame:
    """The neighbours among vectors of one length."""
    index = usable.sparkSession.sparkContext.broadcast(_fit(usable, dim, count, neighbours))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _unit(_clean(batch["vector"].tolist(), dim))
                yield batch.assign(list=index.value.lists_of(x)).explode("list").astype({"list": "int64"})

    def reading(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _unit(_clean(batch["vector"].tolist(), dim))
                yield batch.assign(list=[index.value.read_by(v) for v in x]).explode("list").astype({"list": "int64"})

    lists = written(usable.mapInPandas(listed, "vec_id bigint, vector array<double>, list bigint"), "lists")
    wanted = usable.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    queries = wanted.mapInPandas(reading, "query_id bigint, vector array<double>, list bigint")
    found = written(_search(queries, lists, dim, neighbours), "found")
    # queries that found too few read every list, which is exact
    least = min(neighbours, usable.select("vec_id").distinct().limit(neighbours + 1).count() - 1)
    counts = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    short = wanted.join(counts, "query_id", "left_anti")
    all_lists = F.sequence(F.lit(0).cast("bigint"), F.lit(len(index.value.centroids) - 1).cast("bigint"))
    whole = _search(short.select("*", F.explode(all_lists).alias("list")), lists, dim, neighbours)
    return found.join(counts, "query_id", "left_semi").unionByName(whole)


@query()
def op10_nearest_neighbours(spark, sf):
    return nearest(table(spark, sf, "embeddings"))
