"""Nearest neighbours by stable projections to few dimensions, a kd-tree, and a chi-square stopping test.

Vectors get one more component that makes all norms equal, so that the largest inner product is the least
distance.  Gaussian projections of that are indexed by a kd-tree: its upper levels, fitted on a bounded
sample, deal the rows to cells, and every cell builds the lower levels.  A query takes leaves in the order
of their projected distance and verifies the rows in them exactly.  The squared projected distance over the
squared distance follows a chi-square law; the search stops when a row as near as the worst one kept would,
with probability ``CERTAINTY``, have been projected nearer than all that is left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tallyweir.llm.shared import stored
from tallyweir.llm.vectors import SAMPLE, matrix, sampled, usable

NEIGHBOURS = 20
PROJECTIONS = 8
CERTAINTY = 0.95
CELL = 8192
LEAF = 128
QUERIES_AT_ONCE = 256
QUERIES_IN_TASK = 8192
LEAST_SAMPLE = 32


def chi_square(x: np.ndarray, m: int) -> np.ndarray:
    """Probability that a chi-square variable of ``m`` (even) degrees of freedom is at most ``x``."""
    half = np.asarray(x, dtype=np.float64) / 2
    term = total = np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, m) < p else (low, middle)
    return high


class Index(NamedTuple):
    """The upper levels of the kd-tree: ``axes`` and ``thresholds`` of nodes 1, 2, 3, ... down to ``depth``."""

    projection: np.ndarray
    longest: float
    depth: int
    axes: np.ndarray
    thresholds: np.ndarray

    def of_rows(self, vectors: np.ndarray) -> np.ndarray:
        """Projections of candidates, which get the component that brings their norm to the longest."""
        rest = np.sqrt(np.maximum(0, 1 - np.sum((vectors / self.longest) ** 2, axis=1)))
        return (vectors / self.longest) @ self.projection[:-1] + rest[:, None] * self.projection[-1]

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors / self.longest) @ self.projection[:-1]

    def cells(self, projected: np.ndarray) -> np.ndarray:
        node = np.ones(len(projected), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + (projected[np.arange(len(node)), self.axes[node]] > self.thresholds[node])
        return node

    def boxes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every cell with the least and largest projections it can hold."""
        first = 1 << self.depth
        low, high = np.full((2 * first, self.projection.shape[1]), -np.inf), np.full((2 * first, self.projection.shape[1]), np.inf)
        for node in range(1, first):
            for child, bound in ((2 * node, high), (2 * node + 1, low)):
                low[child], high[child] = low[node], high[node]
                bound[child, self.axes[node]] = self.thresholds[node]
        return np.arange(first, 2 * first), low[first:], high[first:]


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``[point, box]``: squared distances to the nearest place of each box."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        x = points[:, axis, None]
        out += np.maximum(0, np.maximum(low[None, :, axis] - x, x - high[None, :, axis])) ** 2
    return out


def fitted(sample: np.ndarray, rows: int, longest: float, m: int, seed: int = 1) -> Index:
    """An index for ``rows`` vectors of which ``sample`` are some."""
    projection = np.random.default_rng(seed).standard_normal((sample.shape[1] + 1, m))
    depth = max(0, min(math.ceil(math.log2(max(rows, 1) / CELL)), int(math.log2(max(len(sample), 1) / LEAST_SAMPLE))))
    axes, thresholds = np.zeros(1 << depth, dtype=np.int64), np.zeros(1 << depth)
    index = Index(projection, longest, depth, axes, thresholds)

    def grow(node: int, own: np.ndarray) -> None:
        if node >= 1 << depth:
            return
        axes[node] = np.argmax(own.max(axis=0) - own.min(axis=0)) if len(own) else 0
        thresholds[node] = np.median(own[:, axes[node]]) if len(own) else 0.0
        side = own[:, axes[node]] > thresholds[node]
        grow(2 * node, own[~side])
        grow(2 * node + 1, own[side])

    grow(1, index.of_rows(sample))
    return index


def kd_leaves(projected: np.ndarray) -> list[np.ndarray]:
    """Rows of the leaves of a kd-tree: halves along the widest axis, down to ``LEAF`` rows."""
    todo, out = [np.arange(len(projected))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            out.append(rows)
            continue
        own = projected[rows]
        axis = np.argmax(own.max(axis=0) - own.min(axis=0))
        order = np.argpartition(own[:, axis], len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


def searched(ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, worst: np.ndarray, index: Index, k: int, limit: float):
    """``query``, ``id``, ``score``: the best ``k`` rows for each query that beat its ``worst`` score so far.

    All queries go on together: each in turn takes as many more leaves as it has had, the nearest ones first,
    as long as its stopping test does not hold.
    """
    projected = index.of_rows(vectors)
    leaves = kd_leaves(projected)
    low, high = (np.array([f(projected[rows], axis=0) for rows in leaves]) for f in (np.min, np.max))
    away = box_distances(index.of_queries(queries), low, high)
    order = np.argsort(away, axis=1, kind="stable")
    sorted_away = np.take_along_axis(away, order, axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(leaves))[None, :], axis=1)
    scores = np.full((len(queries), len(ids)), -np.inf)
    lengths = np.sum((queries / index.longest) ** 2, axis=1)
    worst = worst.copy()
    start, step = 0, 1
    while start < len(leaves):
        # squared distances of the worst rows kept, in the units of the projection
        reach = limit * np.maximum(0, lengths + 1 - 2 * worst / index.longest**2) * (1 + 1e-9) + 1e-12
        going = np.isinf(worst) | (sorted_away[:, start] <= reach)
        if not going.any():
            break
        taken = going[:, None] & (rank >= start) & (rank < start + step) & (np.isinf(worst)[:, None] | (away <= reach[:, None]))
        for leaf in np.flatnonzero(taken.any(axis=0)):
            who = np.flatnonzero(taken[:, leaf])
            scores[np.ix_(who, leaves[leaf])] = queries[who] @ vectors[leaves[leaf]].T
        if len(ids) >= k:
            worst = np.maximum(worst, np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k])
        start, step = start + step, 2 * step if start else 1
    # the last bits of a matrix product depend on the place of a row, so what may be among the best is scored again
    doubt = 4 * vectors.shape[1] * np.finfo(float).eps * index.longest * np.sqrt(np.sum(queries**2, axis=1))
    query, row = np.nonzero((scores > -np.inf) & (scores >= (worst - doubt)[:, None]))
    score, own = products(queries, vectors, query, row), ids[row]
    best = np.lexsort((own, -score, query))
    query, own, score = query[best], own[best], score[best]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < k], own[place < k], score[place < k]


def products(a: np.ndarray, b: np.ndarray, rows_a: np.ndarray, rows_b: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, added up component by component, so that equal vectors have equal ones."""
    out = np.zeros(len(rows_a))
    for i in range(a.shape[1]):
        out += a[rows_a, i] * b[rows_b, i]
    return out


def nearest(table: DataFrame, is_query: str, k: int = NEIGHBOURS, projections: int = PROJECTIONS, certainty: float = CERTAINTY) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the nearest rows of ``table`` (``vec_id``, ``embedding``) for
    every row where the SQL condition ``is_query`` holds, by the largest inner product of the original vectors
    in double precision, ties to the smaller ``vec_id``; all other rows if there are no more than ``k``.

    A query's own id is never among its results.  Vectors that are null, empty, zero or have null or
    non-finite components, and rows without id, take no part; vectors of different lengths are apart.
    Repeated rows count once; other columns are ignored; an empty table gives no rows.

    Queries first search the cell they fall into, which bounds how far they must look, then only cells within
    that reach.  Equal vectors are searched for once, and of equal candidates only the ``k + 1`` smallest ids
    are kept, which is all that any query can get.
    """
    rows = table.where(usable() & F.col("vec_id").isNotNull()).selectExpr("bigint(vec_id) AS vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding")
    good = stored(rows.dropDuplicates(["vec_id", "embedding"]), "vectors")
    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    kept = stored(
        good.withColumn("place", F.row_number().over(smallest)).where(f"place <= {k + 1}").selectExpr("vec_id", "embedding", "size(embedding) AS dims"), "kept"
    )
    asked = good.where(is_query)
    vectors = stored(
        asked.select("embedding").distinct().select(F.monotonically_increasing_id().alias("query"), "embedding", F.size("embedding").alias("dims")), "queries"
    )
    indexes = _fit(kept, projections)
    limit = chi_square_quantile(certainty, projections)
    near = _near(kept, vectors, indexes, k, limit)
    found = asked.join(vectors, "embedding").selectExpr("vec_id AS query_id", "query").join(near, "query").where("query_id <> vec_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(f"rank <= {k}")


def _fit(kept: DataFrame, m: int) -> dict[int, Index]:
    """An index for every number of dimensions, from at most about ``SAMPLE`` vectors of each."""
    longest = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x))
    indexes = {}
    for dims, n, most in kept.groupBy("dims").agg(F.count("*"), F.max(longest)).collect():
        some = kept.where((F.col("dims") == dims) & sampled(min(1.0, SAMPLE / n), "vec_id", "embedding")).select("embedding").toPandas()["embedding"]
        indexes[dims] = fitted(matrix(some) if len(some) else np.empty((0, dims)), n, most, m)
    return indexes


def _near(kept: DataFrame, vectors: DataFrame, indexes: dict[int, Index], k: int, limit: float) -> DataFrame:
    """``query``, ``vec_id``, ``score``: the best ``k + 1`` rows for each distinct query vector."""

    def celled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, own in batch.groupby("dims"):
                points = matrix(own["embedding"])
                project = indexes[dims].of_rows if "vec_id" in own else indexes[dims].of_queries
                yield own.assign(cell=indexes[dims].cells(project(points)))

    def reaching(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, own in batch.groupby("dims"):
                index = indexes[dims]
                queries = matrix(own["embedding"])
                cells, low, high = index.boxes()
                away = box_distances(index.of_queries(queries), low, high)
                worst = own["worst"].fillna(-np.inf).to_numpy()
                reach = limit * np.maximum(0, np.sum((queries / index.longest) ** 2, axis=1) + 1 - 2 * worst / index.longest**2) * (1 + 1e-9) + 1e-12
                query, cell = np.nonzero((away <= reach[:, None]) & (cells[None, :] != own["cell"].to_numpy()[:, None]))
                yield own.iloc[query].assign(cell=cells[cell])[["query", "embedding", "dims", "worst", "cell"]]

    # Rows and queries of a cell are cut into chunks, so that no task holds a whole cell however full it is.
    points = stored(kept.mapInPandas(celled, "vec_id bigint, embedding array<double>, dims int, cell bigint"), "cells")
    chunks = points.groupBy("dims", "cell").agg(F.ceil(F.count("*") / (2 * CELL)).cast("int").alias("chunks"))
    points = points.join(chunks, ["dims", "cell"]).selectExpr("dims", "cell", "int(pmod(xxhash64(vec_id), chunks)) AS chunk", "vec_id", "embedding")

    def search(queries: DataFrame) -> DataFrame:
        asking = queries.groupBy("dims", "cell").agg(F.ceil(F.count("*") / QUERIES_IN_TASK).cast("int").alias("parts"))
        dealt = queries.join(asking, ["dims", "cell"]).withColumn("part", F.expr("int(pmod(xxhash64(query), parts))")).drop("parts")
        parts = asking.selectExpr("dims", "cell", "explode(sequence(0, parts - 1)) AS part")
        left = dealt.join(chunks, ["dims", "cell"]).selectExpr("*", "explode(sequence(0, chunks - 1)) AS chunk").drop("chunks")
        right = points.join(parts, ["dims", "cell"])
        keys = ["dims", "cell", "chunk", "part"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(found, "query bigint, vec_id bigint, score double")

    def found(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query": [], "vec_id": [], "score": []}).astype({"query": "int64", "vec_id": "int64"})
        if not len(queries) or not len(rows):
            return none
        index = indexes[rows["dims"].iloc[0]]
        ids, points = rows["vec_id"].to_numpy(), matrix(rows["embedding"])
        out = [none]
        for low in range(0, len(queries), QUERIES_AT_ONCE):
            some = queries.iloc[low : low + QUERIES_AT_ONCE]
            query, own, score = searched(ids, points, matrix(some["embedding"]), some["worst"].fillna(-np.inf).to_numpy(), index, k + 1, limit)
            out.append(pd.DataFrame({"query": some["query"].to_numpy()[query], "vec_id": own, "score": score}))
        return pd.concat(out)

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    homes = stored(vectors.mapInPandas(celled, "query bigint, embedding array<double>, dims int, cell bigint"), "homes")
    here = stored(search(homes.withColumn("worst", F.lit(None).cast("double"))), "near")
    worst = here.withColumn("place", F.row_number().over(best)).where(f"place = {k + 1}").selectExpr("query", "score AS worst")
    bounded = homes.join(worst, "query", "left").select("query", "embedding", "dims", "worst", "cell")
    there = search(stored(bounded.mapInPandas(reaching, "query bigint, embedding array<double>, dims int, worst double, cell bigint"), "reach"))
    return stored(here.union(there).withColumn("place", F.row_number().over(best)).where(f"place <= {k + 1}").drop("place"), "found")
