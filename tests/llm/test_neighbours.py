from __future__ import annotations

import math

import numpy as np
import pytest

from tallyweir.llm.neighbours import chi_square, chi_square_quantile, nearest
from tallyweir.llm.queries import op2_neighbours


def brute_force(rows, is_query, k):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for q, query in rows:
        if is_query(q):
            scores = [(-float(np.dot(np.array(v), np.array(query))), i) for i, v in rows if i != q and len(v) == len(query)]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        own = out.setdefault(r.query_id, [])
        assert r.rank == len(own) + 1
        own.append((r.vec_id, r.score))
    return out


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in own}) for q, own in want.items()) / sum(map(len, want.values()))


def test_chi_square():
    assert chi_square(np.array([0.0, 2.0]), 2).tolist() == pytest.approx([0, 1 - math.exp(-1)])
    assert chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((40, 6)) * rng.uniform(0.1, 9, (40, 1)))]
    rows += [(100 + i, rows[3][1]) for i in range(30)] + [(3, rows[3][1]), (200, [1.0, 2.0]), (220, [2.0, 1.0])]
    bad = [(240, None), (260, []), (280, [0.0] * 6), (300, [float("nan")] * 6), (320, [None] * 6), (340, [float("inf")] * 6), (None, rows[1][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id bigint, embedding array<double>, rank int")
    got = by_query(nearest(frame, "vec_id % 20 = 0", certainty=0.9999999).collect())
    want = brute_force(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == {q for q, own in want.items() if own}
    for q, own in got.items():
        assert [i for i, _ in own] == [i for i, _ in want[q]]
        assert [s for _, s in own] == pytest.approx([s for _, s in want[q]])
    assert nearest(frame.limit(0), "vec_id % 20 = 0").count() == 0


def test_cells_and_chunks(spark, monkeypatch):
    import tallyweir.llm.neighbours as neighbours

    for name, value in (("CELL", 40), ("LEAF", 8), ("QUERIES_AT_ONCE", 3), ("QUERIES_IN_TASK", 5)):
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(7)
    centers = rng.standard_normal((6, 12))
    rows = [(i, (centers[i % 6] + 0.4 * rng.standard_normal(12)).tolist()) for i in range(500)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    want = brute_force(rows, lambda i: i % 20 == 0, 20)
    got = by_query(nearest(frame, "vec_id % 20 = 0").collect())
    assert all(len(own) == 20 for own in got.values()) and got.keys() == want.keys()
    assert recall(got, want) >= 0.9
    scores = {i: np.array(v) for i, v in rows}
    assert all(s == pytest.approx(float(scores[q] @ scores[i])) for q, own in got.items() for i, s in own)
    sure = by_query(nearest(frame, "vec_id % 20 = 0", certainty=0.9999999).collect())
    assert recall(sure, want) == 1


def test_equal_vectors_have_equal_scores(spark):
    rng = np.random.default_rng(12)
    base = rng.standard_normal((30, 65))
    rows = [(i, base[i % 30].tolist()) for i in range(360)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    scores = {i: np.array(v) for i, v in rows}
    for q, own in by_query(nearest(frame, "vec_id % 20 = 0", certainty=0.9999999).collect()).items():
        exact = sorted((-float(np.add.accumulate(scores[q] * v)[-1]), i) for i, v in scores.items() if i != q)[:20]
        assert own == [(i, -s) for s, i in exact]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute_force(rows, lambda i: i % 20 == 0, 20)
    got = by_query(op2_neighbours(spark, sf_dir).collect())
    assert got.keys() == want.keys() and all(len(own) == 20 for own in got.values())
    assert recall(got, want) >= 0.9
