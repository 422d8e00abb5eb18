import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from cohortlens.llm import divergence as dv
from cohortlens.llm.divergence import divergence
from helpers import DOCS, clash

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs):
    """The audit from its definition, over (text, lang, source)."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang, source in counts:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        whole = Counter()
        for (l, _), c in counts.items():
            if l == lang:
                whole.update({t: c[t] for t in kept})

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}
        p, q = share(counts[lang, source]), share(whole)
        pairs = [(sum(abs(p[t] - r[t]) for t in kept), s) for l, s in counts if l == lang and s != source
                 for r in [share(counts[l, s])]]
        own = [(p[t] - q[t], t) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", pairs), ("term", own)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(found)
                    if part == "pair" or i < 50]
    return sorted(out)


def table(spark, rows, parts=3):
    full = [(i, text, lang, source, None) for i, (text, lang, source) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def texts(n, seed, sources=7):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Élan", "ÉLAN", "ab1cd", "don't", "日本", "I"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(" ".join(rng.choices(words, weights, k=rng.randint(0, 40))), rng.choice(["en", "en", "de", None]),
             rng.choice(["hot"] * 4 + [f"s{i}" for i in range(sources)] + [None, "Ω"])) for _ in range(n)]
    return rows + [(None, "en", "s0"), ("", "xx", "alone"), ("w w w", "yy", "a"), ("v", "yy", "b"), (None, None, None)]


def test_equals_brute_force(spark):
    rows = texts(400, 1)
    got = divergence(clash(table(spark, rows), "term", "n", "block", "shard"), min_docs=5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_small_blocks_of_postings_sources_and_terms(spark, monkeypatch):
    monkeypatch.setattr(dv, "SOURCE_BLOCK", 3)
    monkeypatch.setattr(dv, "TERM_BLOCK", 20)
    monkeypatch.setattr(dv, "LEAST_TERM_BLOCK", 4)
    monkeypatch.setattr(dv, "BROADCAST_ROWS", 0)
    rows = texts(300, 2, sources=12)
    got = divergence(table(spark, rows, 5), min_docs=3, block_postings=40)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3)


def test_empty_table_and_no_kept_terms(spark):
    assert divergence(spark.createDataFrame([], DOCS)).count() == 0
    rows = [("a b", "en", "x"), ("c", "en", "y")]
    assert sorted(map(tuple, divergence(table(spark, rows)).collect())) == brute(rows, 30) == [
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_runs_are_sorted_pieces_and_merge_to_sums(monkeypatch):
    monkeypatch.setattr(dv, "PIECE_POSTINGS", 3)
    monkeypatch.setattr(dv, "MERGE_POSTINGS", 5)
    rng, want, docs, batches = random.Random(3), Counter(), Counter(), []
    for _ in range(12):
        block = dv._Block()
        for _ in range(rng.randint(0, 4)):
            rows = [(rng.choice(["x", "y"]), " ".join(rng.choice("abcdEfghij") * 2 for _ in range(rng.randint(0, 6))))
                    for _ in range(rng.randint(0, 8))]
            block.add(pa.array(["l"] * len(rows), pa.binary()), pa.array([r[0] for r in rows], pa.binary()),
                      pa.array([r[1] for r in rows], pa.binary()))
            assert block.full(40) in (False, True)
            for source, text in rows:
                terms = [(w.encode(), b"l", source.encode()) for w in text.lower().split()]
                want.update(terms)
                docs.update(set(terms))
        batches += block.run(1)
    for b in batches:
        for piece, first, last in zip(b.column("term").to_pylist(), b.column("first").to_pylist(), b.column("last").to_pylist()):
            assert piece == sorted(piece) and len(piece) <= 3 and (piece[0], piece[-1]) == (first, last)
    pieces = sorted(((b.column("first")[i].as_py(), b.slice(i, 1)) for b in batches for i in range(b.num_rows)),
                    key=lambda x: x[0])
    whole = pa.Table.from_batches([p for _, p in pieces]).combine_chunks()
    for size in (1, 4, 1000):
        merged = [r for b in dv._merge(iter(whole.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        keys = [(r["term"], r["lang"], r["source"]) for r in merged]
        assert sorted(keys) == sorted(want) and len(set(keys)) == len(keys)
        assert all((want[k], docs[k]) == (r["n"], r["docs"]) for k, r in zip(keys, merged))


def test_long_and_odd_texts():
    text = "Aé bb, " * 50_000 + "c" * 60 + " bb\x00日本İx"
    whole, block = Counter(t.translate(LOWER).encode() for t in TERM.findall(text)), dv._Block()
    block.add(pa.array(["en"] * 3, pa.binary()), pa.array(["s"] * 3, pa.binary()),
              pa.array(["", text, "zz"], pa.binary())[1:2].take(pa.array([0, 0, 0])))
    [run] = block.run(1)
    got = dict(zip(run.column("term").flatten().to_pylist(), zip(run.column("n").flatten().to_pylist(),
                                                                run.column("docs").flatten().to_pylist())))
    assert got == {t: (3 * n, 3) for t, n in whole.items()}
