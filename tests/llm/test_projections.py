import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cohortlens.llm import projections as pr
from cohortlens.llm.projections import nearest
from cohortlens.llm.queries import QUERIES
from helpers import clash

ROWS = "vec_id long, embedding array<double>, label int"


def brute(rows, every, k=5):
    """{query_id: [(vec_id, score)]} of the k largest cosines."""
    kept = [(i, [float(c) for c in x]) for i, x, _ in rows
            if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x) and any(x)]
    dim = max((len(x) for _, x in kept), default=0)
    ids = np.array([i for i, _ in kept])
    m = np.array([x + [0.0] * (dim - len(x)) for _, x in kept])
    m /= np.abs(m).max(axis=1)[:, None]
    length = np.sqrt((m * m).sum(axis=1))
    out = {}
    for at in np.flatnonzero(ids % every == 0):
        score = (m * m[at]).sum(axis=1) / (length * length[at])
        mine = np.flatnonzero(ids != ids[at])
        best = mine[np.lexsort((ids[mine], -np.round(score[mine], 12)))[:k]]
        out[int(ids[at])] = [(int(ids[j]), float(score[j])) for j in best]
    return out


def run(spark, rows, every=50, parts=4, **how):
    df = clash(spark.createDataFrame(rows, ROWS).repartition(parts), "x", "y", "cell", "number", "row", "score")
    got = {}
    for r in sorted(nearest(df, F.col("vec_id") % every == 0, **how).collect()):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return got


def check(got, want, least):
    assert set(got) == {q for q, near in want.items() if near}
    hits = total = 0
    for q, near in want.items():
        scores = dict(near)
        assert [r for r, _, _ in got.get(q, [])] == list(range(1, len(near) + 1))
        for _, v, s in got.get(q, []):
            assert v not in scores or abs(scores[v] - s) < 1e-12
        keys = [(-s, v) for _, v, s in got.get(q, [])]
        assert keys == sorted(keys)
        hits += (Counter(v for _, v, _ in got.get(q, [])) & Counter(v for v, _ in near)).total()
        total += len(near)
    assert hits >= least * total, (hits, total)


def clustered(n, dim, seed, centres=20):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    return [(i, (middle[rng.integers(centres)] + 0.2 * rng.normal(size=dim)).tolist(), None) for i in range(n)]


def test_recall_on_clusters_and_on_random_vectors(spark, monkeypatch):
    monkeypatch.setattr(pr, "PART_ROWS", 300)
    monkeypatch.setattr(pr, "QUERY_BLOCK", 7)
    rows = clustered(2500, 32, 1)
    check(run(spark, rows, 20), brute(rows, 20), 0.93)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(32)], None) for i in range(1500)]
    check(run(spark, rows, 25), brute(rows, 25), 0.9)


def test_copies_go_to_the_smallest_ids(spark, monkeypatch):
    monkeypatch.setattr(pr, "PART_ROWS", 200)
    rows = clustered(300, 16, 3) + [(1000 + i, [0.5] * 16, 1) for i in range(900)] + [(1000 + i, [0.5] * 16, 2) for i in range(5)]
    got, want = run(spark, rows), brute(rows, 50)
    check(got, want, 0.9)
    for q in range(1000, 1900, 50):     # copies of one vector, two of them with a repeated id
        assert [(v, round(s, 12)) for _, v, s in got[q]] == [(v, round(s, 12)) for v, s in want[q]]


def test_special_rows(spark):
    rows = clustered(60, 8, 4) + [
        (None, [1.0] * 8, 1), (100, None, 1), (150, [0.0] * 8, 1), (200, [float("nan")] * 8, 1), (250, [None] * 8, 1),
        (300, [float("inf")] * 8, 1), (350, [1e200] * 8, 1), (400, [1e-200] * 8, 1), (450, [3.0, 1.0], 1), (500, [], 1),
        (50, [0.3] * 8, 1)]                     # a repeated id with another vector
    got = nearest(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 50 == 0).collect()
    want = brute([r for r in rows if r[0] != 50], 50)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {0, 50, 350, 400, 450} and len(by[50]) == 10
    assert sorted(r.vec_id for r in by[350])[-1] == 400 and abs(by[350][0].score - 1) < 1e-12
    assert {r.vec_id for r in by[450]} & {v for v, _ in want[450]}


def test_few_rows_and_empty_table(spark):
    rows = [(0, [1.0, 0.0], None), (1, [0.0, 1.0], None), (2, [1.0, 1.0], None)]
    check(run(spark, rows), brute(rows, 50), 1.0)
    assert run(spark, [(0, [1.0], None)]) == {}
    assert run(spark, []) == {}


def test_query_recall_on_the_given_vectors(spark):
    got = {}
    for r in QUERIES["op13_projections"](spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    check({q: sorted(v) for q, v in got.items()}, brute(rows, 50), 0.93)


def test_chi_square_quantile_and_stopping():
    assert abs(pr.chi_square_quantile(0.95, 2) - 5.991464547) < 1e-6
    assert abs(pr.chi_square_quantile(0.95, 16) - 26.296227605) < 1e-6
    rng = np.random.default_rng(5)
    x, length = pr.scaled(rng.normal(size=(4000, 24)) * 0.05 + np.repeat(rng.normal(size=(40, 24)), 100, axis=0))
    y = (x / length[:, None]) @ np.random.default_rng(pr.SEED).normal(size=(24, 16))
    tree = pr.Lower(y)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(4000))
    seen = []
    quantile = pr.chi_square_quantile(0.96, 16)
    for i in range(0, 4000, 400):
        rows, scores = pr.search(tree, x, length, np.arange(4000), x[i], length[i], y[i], i, 5, float("inf"), quantile)
        cosine = (x * x[i]).sum(axis=1) / (length * length[i])
        cosine[i] = -2
        seen.append(len(set(rows.tolist()) & set(np.argsort(-cosine)[:5].tolist())))
        reach = quantile * (2 - 2 * scores[-1])
        assert (tree.gaps(y[i]) < reach).mean() < 0.5      # leaves that the test rules out are not read
    assert sum(seen) >= 45


def test_upper_levels_put_every_row_into_a_cell():
    rng = np.random.default_rng(6)
    rows = np.concatenate((rng.normal(size=(500, 4)), np.ones((500, 4))))
    upper = pr.Upper(rows, 50)
    cell = upper.cell(rows)
    assert set(cell.tolist()) == set(range(upper.cells)) and len(set(cell[500:].tolist())) == 1
    assert max(np.bincount(cell[:500])) <= 50
