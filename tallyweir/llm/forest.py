"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits the vectors at the median of their projections on a random direction, again and again;
vectors close to a split go to both sides.  Only vectors that share a leaf of some tree are compared, those
alike enough are linked, and links are united into components.  Medians come from a bounded sample; every
vector is sent down every tree.  Below the depth that the sample supports, the nodes of a level under one
node share direction and threshold, so the trees stay small however many vectors there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyweir.llm.components import components
from tallyweir.llm.shared import stored
from tallyweir.llm.vectors import SAMPLE, matrix, sampled, unit_vectors, usable

COSINE = 0.95
TREES = 6
LEAF = 512
BLOCK = 1024
# Half the width of the overlap, in standard deviations of what two vectors just alike enough differ by.
SPILL = 0.5
LEAST_SAMPLE = 32


class Split(NamedTuple):
    direction: np.ndarray
    threshold: float


class Tree(NamedTuple):
    """``splits[node]`` down to ``depth``; then ``lower[node]`` holds one split per further level."""

    depth: int
    splits: dict[int, Split]
    lower: dict[int, list[Split]]


def planted(sample: np.ndarray, rows: int, seed: tuple[int, ...], leaf: int = LEAF) -> Tree:
    """A tree for ``rows`` unit vectors of which ``sample`` are some."""
    levels = max(0, math.ceil(math.log2(max(rows, 1) / leaf)))
    depth = min(levels, max(0, int(math.log2(max(len(sample), 1) / LEAST_SAMPLE))))
    tree = Tree(depth, {}, {})

    def split(own: np.ndarray, *place: int) -> Split:
        direction = np.random.default_rng((*seed, *place)).standard_normal(sample.shape[1])
        direction /= np.linalg.norm(direction)
        return Split(direction, float(np.median(own @ direction)) if len(own) else 0.0)

    def grow(node: int, own: np.ndarray, level: int) -> None:
        if level == depth:
            tree.lower[node] = [split(own, node, i) for i in range(1, levels - depth + 1)]
            return
        tree.splits[node] = split(own, node)
        side = own @ tree.splits[node].direction > tree.splits[node].threshold
        grow(2 * node, own[~side], level + 1)
        grow(2 * node + 1, own[side], level + 1)

    grow(1, sample, 0)
    return tree


def leaves(tree: Tree, vectors: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """``row``, ``leaf``: the leaves of every vector; one that lies within ``margin`` of a split is on both sides."""
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def both(split: Split, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        off = vectors[rows] @ split.direction - split.threshold
        return off <= margin, off > -margin

    def down(node: int, rows: np.ndarray, level: int) -> None:
        if not len(rows):
            return
        if level < tree.depth:
            low, high = both(tree.splits[node], rows)
            down(2 * node, rows[low], level + 1)
            down(2 * node + 1, rows[high], level + 1)
            return
        leaf = np.full(len(rows), node, dtype=np.int64)
        for split in tree.lower[node]:
            low, high = both(split, rows)
            rows, leaf = np.concatenate((rows[low], rows[high])), np.concatenate((2 * leaf[low], 2 * leaf[high] + 1))
        found.append((rows, leaf))

    down(1, np.arange(len(vectors)), 0)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([r for r, _ in found]), np.concatenate([leaf for _, leaf in found])


def vector_groups(table: DataFrame, trees: int = TREES) -> DataFrame:
    """One row per row of ``table`` (``vec_id``, ``embedding``): ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors are linked if they share a leaf and their cosine, in double precision, is ``COSINE`` or more.
    ``n_links`` counts the other rows linked, ``component_id`` is the smallest ``vec_id`` that links reach,
    and its row is kept.  Vectors that are null, empty, zero or have null or non-finite components, and
    vectors of different lengths, are linked with nothing.  Null ids come last; repeated rows are linked with
    each other and all returned; other columns are ignored; an empty table gives no rows.

    Equal vectors are made one first and only counted, so copies give no comparisons.  A leaf with many
    different vectors is cut into blocks and pairs of blocks are compared in tasks that return one row per
    vector.  A pair that shares several leaves counts in the first of them.
    """
    rows = table.selectExpr("bigint(vec_id) AS vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding")
    good = rows.where(usable())
    nodes = stored(
        good.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
        .select(F.monotonically_increasing_id().alias("node"), F.size("embedding").alias("dims"), "*"),
        "vectors",
    )
    forest = _forest(nodes, trees)
    placed = stored(nodes.select("node", "copies", "embedding").mapInPandas(_placing(forest), "node bigint, copies bigint, embedding array<double>, leaves array<bigint>"), "leaves")
    found = stored(_compared(placed), "compared")
    stars = components(found.selectExpr("node AS a", "root AS b"))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    labelled = stored(
        nodes.join(stars, "node", "left").join(counts, "node", "left")
        .selectExpr("embedding", "vec_id", "copies - 1 + coalesce(n, 0) AS n_links", "coalesce(component, node) AS component"),
        "labelled",
    )
    least = labelled.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = labelled.join(least, "component").select("embedding", "n_links", "component_id")
    linked = good.join(named, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable()).selectExpr("vec_id", "0L AS n_links", "vec_id AS component_id")
    return linked.union(alone).withColumn("kept", F.expr("vec_id <=> component_id"))


def _forest(nodes: DataFrame, trees: int) -> dict[int, list[Tree]]:
    """Trees for every number of dimensions, from at most about ``SAMPLE`` vectors of each."""
    forest = {}
    for dims, n in nodes.groupBy("dims").count().collect():
        some = nodes.where((F.col("dims") == dims) & sampled(min(1.0, SAMPLE / n), "node")).select("embedding")
        vectors = some.toPandas()["embedding"]
        sample = unit_vectors(matrix(vectors)) if len(vectors) else np.empty((0, dims))
        forest[dims] = [planted(sample, n, (t, dims)) for t in range(trees)]
    return forest


def _placing(forest: dict[int, list[Tree]]):
    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, own in batch.groupby(batch["embedding"].map(len)):
                vectors = unit_vectors(matrix(own["embedding"]))
                margin = SPILL * math.sqrt((2 - 2 * COSINE) / dims)
                parts = []
                for t, tree in enumerate(forest[dims]):
                    row, leaf = leaves(tree, vectors, margin)
                    # the leaf's number holds the tree and the number of dimensions
                    parts.append((row, leaf * 8191 + dims % 8191 << 6 | t))
                row, leaf = map(np.concatenate, zip(*parts))
                order = np.lexsort((leaf, row))
                own = own.assign(leaves=np.split(leaf[order], np.searchsorted(row[order], np.arange(1, len(own)))))
                yield own[["node", "copies", "embedding", "leaves"]]

    return placed


def _compared(placed: DataFrame) -> DataFrame:
    """``node``, ``n``, ``root``: how many rows a vector is linked with in a leaf, and a vector that links reach there."""
    dealt = placed.select("node", "copies", "embedding", "leaves", F.explode("leaves").alias("leaf"))
    sizes = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().where("count > 1")
    blocks = (
        dealt.join(sizes, "leaf")
        .selectExpr("*", f"int(ceil(count / {BLOCK})) AS blocks")
        .selectExpr("*", "int(pmod(xxhash64(node), blocks)) AS block")
        .selectExpr(
            "leaf", "node", "copies", "embedding", "leaves", "block",
            "inline(transform(sequence(0, blocks - 1), i -> struct(least(i, block) AS low, greatest(i, block) AS high)))",
        )
    )
    return blocks.groupBy("leaf", "low", "high").applyInPandas(_linked, "node bigint, n bigint, root bigint")


def _linked(group: pd.DataFrame) -> pd.DataFrame:
    none = pd.DataFrame({"node": [], "n": [], "root": []}, dtype="int64")
    dims = group["embedding"].map(len)
    if dims.nunique() > 1:  # numbers of leaves of different dimensions that happen to be equal
        return pd.concat([none, *(_linked(own) for _, own in group.groupby(dims))])
    vectors = unit_vectors(matrix(group["embedding"]))
    alike = vectors @ vectors.T >= COSINE
    np.fill_diagonal(alike, False)
    block, leaf = group["block"].to_numpy(), group["leaf"].iloc[0]
    if group["low"].iloc[0] != group["high"].iloc[0]:
        alike &= block[:, None] != block[None, :]
    linked = np.flatnonzero(alike.any(axis=1))
    if not len(linked):
        return none
    alike, group = alike[np.ix_(linked, linked)], group.iloc[linked]
    # pairs that met in an earlier leaf are counted there
    own_leaves = group["leaves"].to_list()
    sizes = [len(x) for x in own_leaves]
    flat, owner = np.concatenate(own_leaves), np.repeat(np.arange(len(group)), sizes)
    earlier = flat < leaf
    flat, owner = flat[earlier], owner[earlier]
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    counted = alike.copy()
    for members in np.split(owner, np.flatnonzero(np.diff(flat)) + 1):
        if len(members) > 1:
            counted[np.ix_(members, members)] = False
    n = counted.astype(np.int64) @ group["copies"].to_numpy()
    root = np.arange(len(group))
    while True:
        lower = np.minimum(root, np.where(alike, root[None, :], len(group)).min(axis=1))
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    node = group["node"].to_numpy()
    return pd.DataFrame({"node": node, "n": n, "root": node[root]})
