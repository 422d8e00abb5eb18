import random
import re

import numpy as np
import pytest
import xxhash

from cohortlens.llm import simhash
from cohortlens.llm.components import components
from helpers import clash, documents


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, max_bits=4):
    """rows: (doc_id, fp) -> {doc_id: smallest reachable id}."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[find(i)] = min(d, best.get(find(i), d))
    return {d: best[find(i)] for i, (d, _) in enumerate(rows)}


def test_fingerprint():
    for text in ["", None, "One", "a b c d", "A b  c\td\ne", "é É ß x\x1cy z", "the cat sat on the mat " * 9]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def chained(rng, n, step):
    """Fingerprints in chains: each differs from the one before in up to ``step`` bits."""
    out = []
    for _ in range(n):
        fp = out[-1] if out and rng.random() < 0.8 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randint(0, step)):
            fp ^= 1 << b
        out.append(fp)
    return out


@pytest.mark.parametrize("count, longest", [(400, 16_384), (400, 64), (10**9, 16_384)])
def test_groups_equal_brute_force(spark, monkeypatch, count, longest):
    """Also with runs dealt out as pairs of parts, and with keys of many blocks."""
    monkeypatch.setattr(simhash, "MAX_RUN", longest)
    rng = random.Random(count + longest)
    centre = rng.getrandbits(64)
    fps = list(set(chained(rng, 250, 6) + [centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (
        1 << rng.randrange(64)) for _ in range(150)]))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = [tuple(r) for r in simhash.links(table, count).collect()]
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= 4 for a, b in found)
    want = brute_components([(i, fp) for i, fp in enumerate(fps)])
    index = {s: i for i, s in enumerate(signed)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in found:
        root[find(index[a])] = find(index[b])
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(i)
    assert {i: min(g) for g in groups.values() for i in g} == want


def test_long_runs_are_searched_whole(monkeypatch):
    rng = random.Random(2)
    fps = np.array(sorted(set(chained(rng, 500, 4))), dtype=np.uint64)
    keys = np.zeros(len(fps), dtype=np.int64)
    a, b = simhash.run_links(keys, fps.view(np.int64), 4)
    rows = [(i, int(x)) for i, x in enumerate(fps)]
    index = {int(x): i for i, x in enumerate(fps)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for x, y in zip(a.view(np.uint64), b.view(np.uint64)):
        root[find(index[int(x)])] = find(index[int(y)])
    best = {}
    for i in range(len(fps)):
        best[find(i)] = min(i, best.get(find(i), i))
    assert {i: best[find(i)] for i in range(len(fps))} == brute_components(rows)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [
        (rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: find(n) for n in linked}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_documents(spark):
    base = " ".join(f"word{i}" for i in range(300))
    texts = [base, base.upper(), base + " end", "", None, "   ", "other words here now", base, "unlike all the rest"]
    docs = clash(documents(spark, texts, ids=[5, 3, 9, 20, 21, 22, 30, 5, 31]), "fp", "component_id", "key", "root")
    rows = [(r.doc_id, r.fp & ((1 << 64) - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert len(rows) == 9
    want = brute_components([(d, f) for d, f, _ in sorted(rows)])
    assert {d: c for d, _, c in rows} == want
    assert {d for d, _, c in rows if c == 3} >= {3, 5} and {d for d, _, c in rows if c == 20} == {20, 21, 22}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in rows})
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    nulls = documents(spark, ["a b", "a b", "c d"], ids=[None, 4, None])
    assert sorted(str(r.component_id) for r in simhash.near_duplicates(nulls).collect()) == ["4", "4", "None"]
    assert simhash.keep_one(nulls).filter("doc_id is null").count() == 2


def test_keep_one_with_equal_ids_and_different_texts(spark):
    """Decided per fingerprint and id: no group is lost, none keeps two rows with ids."""
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(40)) for w in "abcd")
    # id 5: once a copy of id 1, once alone; id 6: twice alone, with different texts, and once repeated
    rows = [(1, a), (5, a), (5, b), (6, c), (6, c), (6, d), (None, a)]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    out = simhash.keep_one(clash(docs, "fp", "first_id", "root"))
    assert out.columns == [*docs.columns, "fp", "first_id", "root"]
    assert sorted((r.text[0], r.doc_id) for r in out.filter("doc_id IS NOT NULL").collect()) == [("a", 1), ("b", 5), ("c", 6), ("d", 6)]
