from __future__ import annotations

import numpy as np
import pytest

from tallyweir.llm.forest import COSINE, leaves, planted, vector_groups
from tallyweir.llm.queries import op10_forest


def brute_force(rows):
    """``[(vec_id, n_links, component_id, kept)]`` by comparing all pairs."""
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float) / np.abs(v).max()) / np.abs(v).max() if g else None for g, (_, v) in zip(good, rows)]
    alike = [
        [i != j and good[i] and good[j] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= COSINE for j in range(len(rows))]
        for i in range(len(rows))
    ]
    label = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            label[i] = min([label[i], *(label[j] for j in range(len(rows)) if alike[i][j])])
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        least = min(ids, default=None) if good[i] else vec_id
        out.append((vec_id, sum(alike[i]), least, vec_id == least))
    return out


def clusters(rng, n, dims, sizes):
    vectors = list(rng.standard_normal((n, dims)))
    for size in sizes:
        center = rng.standard_normal(dims)
        vectors += [center + rng.standard_normal(dims) * rng.uniform(0.05, 0.25) for _ in range(size)]
    return [v.tolist() for v in vectors]


def test_odd_rows_and_small_tables(spark):
    rng = np.random.default_rng(2)
    rows = list(enumerate(clusters(rng, 20, 16, [5, 9])))
    nan, inf = float("nan"), float("inf")
    rows += [(100, rows[0][1]), (101, (np.array(rows[0][1]) * 3).tolist()), (0, rows[0][1]), (None, rows[1][1]), (None, [9.0] * 3), (102, [1.0, 2.0]), (103, [1.0, 2.01])]
    rows += [(200, None), (201, []), (202, [0.0] * 16), (203, [nan] * 16), (204, [inf] + [1.0] * 15), (205, [1.0] * 15 + [None]), (206, [1e300] * 16), (207, [1e-300] * 16)]
    frame = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id bigint, embedding array<double>, leaf int")
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_groups(frame).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_force(rows)))
    assert vector_groups(frame.limit(0)).count() == 0


def test_blocks_and_leaves(spark, monkeypatch):
    import tallyweir.llm.forest as forest

    monkeypatch.setattr(forest, "BLOCK", 40)
    monkeypatch.setattr(forest, "LEAF", 16)
    rng = np.random.default_rng(4)
    rows = list(enumerate(clusters(rng, 150, 24, [60, 3, 3, 20, 2])))
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    stored_rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_groups(frame).collect())
    assert got == sorted(brute_force(stored_rows))


def test_trees_below_the_sample_still_split():
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((5000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    tree = planted(vectors[:300], 1_000_000, (1,), 512)
    row, leaf = leaves(tree, vectors, 0.0)
    assert sorted(row) == list(range(5000)) and len(np.unique(leaf)) > 1000
    row, leaf = leaves(tree, vectors, 0.01)
    assert len(row) > 5000 and set(row) == set(range(5000))


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_query_finds_the_links_of_brute_force(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect())
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    alike = vectors @ vectors.T >= COSINE
    np.fill_diagonal(alike, False)
    label = np.arange(len(ids))
    for _ in range(len(ids)):
        lower = np.minimum(label, np.where(alike, label[None, :], len(ids)).min(axis=1))
        if (lower == label).all():
            break
        label = lower
    want = {int(i): (int(n), int(ids[c])) for i, n, c in zip(ids, alike.sum(axis=1), label)}
    got = {r.vec_id: (r.n_links, r.component_id) for r in op10_forest(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    assert sum(n for n, _ in got.values()) >= 0.999 * sum(n for n, _ in want.values())
    assert sum(got[i] == want[i] for i in want) >= 0.999 * len(want)
