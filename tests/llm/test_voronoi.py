import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import voronoi
from helpers import clash


def brute(rows, every, k, scale=1024):
    """rows: (vec_id, components) -> sorted (query_id, rank, vec_id, score)."""
    ints = [(i, [int(np.floor(scale * float(c))) for c in v]) for i, v in rows
            if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for q, qv in {(i, tuple(v)) for i, v in ints if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ints if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, every, k=10, **more):
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), "cell", "v", "dist")
    return sorted(tuple(r) for r in voronoi.top_k(df, F.col("vec_id") % every == 0, k, **more).collect())


def as_float(rows):
    return [(i, v and [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows]


@pytest.mark.parametrize("blocks", [False, True])
def test_equals_brute_force(spark, monkeypatch, blocks):
    if blocks:
        for name, value in (("QUERY_BLOCK", 4), ("LEAST_PART_ROWS", 20), ("BROADCAST_ROWS", 0)):
            monkeypatch.setattr(voronoi, name, value)
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]                     # a crowd of equal vectors
    assert run(spark, rows, 10, pivots=16) == brute(as_float(rows), 10, 10)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, []), (7, [-0.0005]), (8, [0.5, -3.0, 9.0]), (0, [1.0, 2.0]),
            (10, [3.0, 1.0])]
    assert run(spark, rows, 10) == brute(as_float(rows), 10, 10)
    assert run(spark, rows[:1], 10) == []
    assert run(spark, [], 10) == []
    huge = [(i, [3e10 * (i + 1), 1.0]) for i in range(3)]
    assert len(run(spark, [(i, [1e5 * (i + 1), 1e5]) for i in range(12)], 10)) == 20
    with pytest.raises(Exception):
        run(spark, huge, 1)


def test_rings_prune_far_cells():
    """On clustered data most cells are not needed, and none that holds a neighbour is dropped."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 50, (20, 8))
    x = np.round(centres[rng.integers(0, 20, 2000)] + rng.normal(0, 1, (2000, 8))).astype(np.int64)
    m = float((x.astype(float) ** 2).sum(1).max())
    p = voronoi._Pivots(x[:40], np.arange(40), m)
    d = p.candidates(x)
    cell = d.argmin(1)
    dist = d[np.arange(len(x)), cell]
    low = np.array([dist[cell == c].min(initial=np.inf) for c in range(40)])
    high = np.array([dist[cell == c].max(initial=-np.inf) for c in range(40)])
    near = np.full((40, 11), np.inf)
    for c in range(40):
        s = np.sort(dist[cell == c])[:11]
        near[c, :len(s)] = s
    q = x[100:150]
    needed, lo, hi = voronoi.query_rings(p, p.queries(q), np.arange(100, 150), low, high, near, 10)
    assert needed.mean() < 0.8
    for i in range(len(q)):
        s = x @ q[i]
        s[100 + i] = s.min() - 1
        for j in np.argsort(-s, kind="stable")[:10]:
            assert needed[i, cell[j]] and lo[i, cell[j]] <= dist[j] <= hi[i, cell[j]]
