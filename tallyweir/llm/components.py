"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is a minimum per node, added up in the tasks before the shuffle, and an equi-join that Spark can
split where a node has many links.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyweir.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for nodes that have links.

    ``links`` has two BIGINT columns ``a`` and ``b`` in any order, repeats and self-links allowed.  A row
    per node with a smaller one in its component; the smallest node of a component has no row.
    """
    edges = stored(
        links.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), "links"
    )
    state = None
    while True:
        edges = _large_star(edges)
        edges = stored(_small_star(edges), "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state or now[0] == 0:
            return edges.selectExpr("u AS node", "v AS component")
        state = now


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
    return both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (
        edges.join(least, "u")
        .selectExpr("inline(array(struct(v AS u, m AS v), struct(u AS u, m AS v)))")
        .where("u <> v")
        .distinct()
    )
