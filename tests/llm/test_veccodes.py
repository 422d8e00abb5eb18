import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import veccodes as vc
from cohortlens.llm.oracle import ORACLE
from cohortlens.llm.queries import QUERIES
from helpers import clash

ROWS = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Codebooks, and (vec_id, label, codes, error) of each kept row, in Python integers."""
    kept = []
    for vec_id, x, label in rows:
        if x is not None and all(c is not None and np.isfinite(c) for c in x):
            kept.append((vec_id, [int(np.floor(np.float64(c) * scale)) for c in x], label))
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    kept = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept]
    seeds = sorted((r for r in kept if r[0] is not None), key=lambda r: r[:2])[:entries]
    books = [[v[p * width:(p + 1) * width] for _, v, _ in seeds] for p in range(parts)]

    def assign(v, p):
        mine = v[p * width:(p + 1) * width]
        far = [sum((a - b) ** 2 for a, b in zip(mine, c)) for c in books[p]]
        return far.index(min(far)), min(far), mine
    for _ in range(rounds):
        new = []
        for p in range(parts):
            chosen = [assign(v, p) for _, v, _ in kept]
            groups = [[m for e, _, m in chosen if e == k] for k in range(len(books[p]))]
            new.append([[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(groups, books[p])])
        books[:] = new
    out = [(i, label, [assign(v, p)[0] for p in range(parts)], sum(assign(v, p)[1] for p in range(parts)))
           for i, v, label in kept]
    return books, out


def digest(books):
    return hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def check(spark, rows):
    df = clash(spark.createDataFrame(rows, ROWS).repartition(3), "v", "codes", "error", "part", "x")
    ints = vc.integers(df, F.col("vec_id"), F.col("label"))
    books = vc.fit(ints)
    want_books, want = brute(rows)
    assert books.digest() == digest(want_books)
    key = lambda r: tuple(map(str, r))
    got = [(r.vec_id, r.label, list(r.codes), r.error) for r in vc.encode(ints, books).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def vectors(n, dim, size, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, size) for _ in range(dim)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [(7, rows[3][1], 1), (None, rows[4][1], None), (2, rows[2][1], 2), (n + 1, None, 1),
             (n + 2, [float("nan")] * dim, 1), (n + 3, [None] + [0.5] * (dim - 1), 1), (n + 4, [float("inf")] * dim, 2)]
    return rows + [(n + 5 + i, [0.25] * dim, 5) for i in range(n // 2)]


def test_equals_brute_force(spark):
    check(spark, vectors(150, 16, 0.3, 1))


def test_large_components_take_several_limbs_and_python_integers(spark):
    rows = vectors(40, 8, 0.01, 2) + [(1000 + i, [3e4 * i + 0.3] * 8, 1) for i in range(10)]  # 10^9 after scaling
    check(spark, rows)
    assert not vc.Codebooks([np.zeros((1, 1), np.int64)] * 8, 1 << 45).fits


def test_few_rows_odd_lengths_and_no_rows(spark):
    check(spark, [(3, [0.5, -0.5, 1.0], None), (9, [0.1] * 11, 4), (4, [], 4)])
    empty = vc.integers(spark.createDataFrame([(None, [1.0], 1), (1, None, 2)], ROWS), F.col("vec_id"))
    assert vc.fit(empty) is None
    with pytest.raises(Exception, match="too large"):
        vc.integers(spark.createDataFrame([(1, [1e300], 1)], ROWS), F.col("vec_id"))


def test_limb_products_are_exact():
    rng = np.random.default_rng(3)
    for top in (10, 2**20, 2**26, 2**30, 2**60):
        a, b = rng.integers(-top, top, (20, 13)), rng.integers(-top, top, (9, 13))
        fits = top <= 2**29
        want = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b] for r in a]
        assert vc.dot(a if fits else a.astype(object), b if fits else b.astype(object), fits).tolist() == want
        for limb in vc.limbs(a, 24):
            assert np.abs(limb).max() <= 2**24


def test_decode_gives_the_chosen_entries():
    books = vc.Codebooks([np.array([[1, 2], [3, 4]]), np.array([[5, 6], [7, 8]])], 8)
    assert books.decode([1, 0]) == [3, 4, 5, 6]


def test_query_equals_sql(spark, tmp_path):
    rows = vectors(60, 64, 0.2, 4)
    spark.createDataFrame(rows, ROWS).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op12_veccodes"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    res = con.execute(ORACLE["op12_veccodes"])
    assert got.columns == [c[0] for c in res.description]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(res.fetchall(), key=key)
