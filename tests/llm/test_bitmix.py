import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortlens.llm import bitmix
from cohortlens.llm.common import token_lists
from helpers import clash, documents


def brute_base(rows):
    """rows: (doc_id, text) -> {doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}."""
    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    counts = Counter(w for d, t in rows if not held[d] for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return {d: (held[d], len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
                sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))) for d, t in rows}


def test_base_equals_brute_force_and_model_is_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_base(rows)
    out = bitmix.score(clash(docs, "train", "chunk", "codes")).collect()
    assert len(out) == len(rows)
    for r in out:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in out if r.held_out]
    gain = (sum(r.score for r in held) - sum(r.base_score for r in held)) / sum(r.n_tokens for r in held)
    print("log10 gain per held-out token", gain)
    assert gain > 0
    assert all(r.score < 0 and math.isfinite(r.score) and r.bits_per_byte > 0 for r in out)


def test_code_probabilities_sum_to_one():
    """Over all codes the mixed bit predictions are a distribution, in any context."""
    state, seen = bitmix.new_state(), np.zeros((bitmix.GATES, bitmix.INPUTS))
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 50, 5000).astype("<i4")
    row = dict(part=0, chunk=0, doc_ids=[1, 2], train=[True, True], sizes=[2000, 3000], bytes=[1, 1], codes=codes.tobytes(),
               hashes=np.arange(50, dtype="<u8").tobytes(),
               symbols=rng.integers(0, bitmix.NODES, 50).astype("<i2").tobytes())
    bitmix.learn(state, bitmix._Chunk(row), seen)
    model = bitmix._frozen(state)
    symbols = np.arange(bitmix.NODES, dtype="<i2")
    every = dict(row, doc_ids=list(range(bitmix.NODES)), train=[False] * bitmix.NODES,
                 sizes=[2] * bitmix.NODES, bytes=[1] * bitmix.NODES,
                 codes=np.stack([np.zeros(bitmix.NODES), symbols], 1).astype("<i4").tobytes(),
                 hashes=symbols.astype("<u8").tobytes(), symbols=symbols.tobytes())
    logs = bitmix.code_log10(model, bitmix._Chunk(every))
    assert (10 ** logs[1::2]).sum() == pytest.approx(1, abs=1e-6)
    assert (10 ** logs[0]).sum() < 1


def test_edge_cases(spark):
    texts = [None, "", " \n", "Wort wort WORT", "Wort wort WORT", "x\x1cy É é"]
    rows = [(i, t) for i, t in enumerate(texts)]
    out = {r.doc_id: r for r in bitmix.score(documents(spark, texts)).collect()}
    want = brute_base(rows)
    for d, (held, n, known, total, base) in want.items():
        r = out[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base) and r.score <= 0
    assert bitmix.score(documents(spark, [])).count() == 0
    lone = bitmix.score(documents(spark, ["a b"], ids=[next(
        i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)])).collect()
    assert lone[0].held_out and lone[0].n_known == 0 and lone[0].base_score == 0 and lone[0].train_tokens == 0
    assert bitmix.score(documents(spark, ["a", "a"], ids=[None, None])).count() == 2


def test_chunks_do_not_change_the_base(spark, monkeypatch):
    texts = [f"word{i % 7} and more{i % 3} . " * (i % 5 + 1) for i in range(40)]
    docs = documents(spark, texts, parts=5)
    out = {r.doc_id: r.base_score for r in bitmix.score(docs).collect()}
    for d, (_, _, _, _, base) in brute_base(list(enumerate(texts))).items():
        assert out[d] == pytest.approx(base)


def test_texts_of_several_chunks_keep_their_words(spark):
    """More text than one chunk holds: every word of every slice is counted."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"Word{x}" + "x" * 2000 for x in rng.integers(0, 90, 700)) for _ in range(14)]
    assert sum(map(len, texts)) > 2 * bitmix.CHUNK_BYTES
    out = {r.doc_id: r for r in bitmix.score(documents(spark, texts, parts=1)).collect()}
    for d, (held, n, known, total, base) in brute_base(list(enumerate(texts))).items():
        r = out[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base)


def test_rows_of_numbers_come_back():
    numbers = np.zeros(bitmix.PIECE)
    numbers[[0, 7, 8, 9, 100, bitmix.PIECE - 1]] = (1, 255, 256, 1e9, -0.25, 3.5)
    for some in (numbers, numbers[:9], numbers.astype(np.float32), np.ones(1)):
        row = bitmix._part(5, some).to_pylist()[0]
        places, values = bitmix._numbers(row)
        back = np.zeros(len(some))
        back[places] = values
        assert (back == some).all()
    assert len(bitmix._part(0, np.ones(bitmix.PIECE)).to_pylist()[0]["large"]) == 0


def test_words_of_a_slice():
    texts = pa.array([f"Ab{i} C\tdE" for i in range(50)])
    for start, n in ((0, 50), (1, 7), (20, 30)):
        offsets, words = token_lists(texts.slice(start, n), lower=True)
        assert offsets.tolist() == list(range(0, 3 * n + 1, 3))
        assert words.to_pylist() == [w for i in range(start, start + n) for w in (f"ab{i}", "c", "de")]


def test_codes_and_slots_follow_the_corpus(spark):
    """Few tokens get 12-bit codes; more tokens and contexts get more bits and slots, up to the largest sizes."""
    small = documents(spark, ["a b c"] * 9)
    rng = np.random.default_rng(3)
    large = documents(spark, [" ".join(f"w{x}" for x in rng.integers(0, 9000, 3000)) for _ in range(20)])
    shapes = []
    for docs in (small, large):
        chunks = docs.selectExpr("0 AS part", "doc_id", "text", "true AS train").mapInArrow(bitmix._chunks, bitmix._CHUNK)
        distinct = len({w for r in docs.collect() for w in r.text.split()}) + 1
        shapes.append(bitmix.model_shape(chunks, distinct))
    assert shapes[0] == (12, 18, 18)
    assert shapes[1][0] == 14 and min(shapes[1][1:]) > 18 and max(shapes[1][1:]) <= bitmix.MAX_SLOT_BITS
    out = bitmix.score(large).collect()
    assert len(out) == 20 and all(r.score < 0 and math.isfinite(r.score) for r in out)


def test_score_does_not_depend_on_the_layout(spark, monkeypatch):
    """Two, sixteen and shuffled partitions give the same scores, over several training parts."""
    monkeypatch.setattr(bitmix, "PART_BYTES", 1 << 19)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    more = docs.selectExpr("doc_id + 1000000 AS doc_id", "concat(text, ' ', reverse(text)) AS text").union(docs)
    assert bitmix.deal(more.withColumn("train", F.lit(True))).select("part").distinct().count() > 1
    layouts = [more.coalesce(1).repartition(2), more.repartition(16, "doc_id"), more.orderBy(F.xxhash64("text"))]
    want, *others = [{r.doc_id: r.score for r in bitmix.score(d).collect()} for d in layouts]
    for got in others:
        assert got.keys() == want.keys()
        assert max(abs(got[k] / want[k] - 1) for k in want) < 1e-6


def test_many_copies_of_one_row_are_spread(spark, monkeypatch):
    monkeypatch.setattr(bitmix, "PART_BYTES", 20_000)
    docs = documents(spark, ["one text that many rows repeat"] * 4000 + ["another text " + str(i) for i in range(99)],
                     ids=[5] * 4000 + list(range(100, 199)))
    sizes = bitmix.deal(docs.selectExpr("doc_id", "text", "true AS train")).groupBy("part").count().collect()
    assert len(sizes) >= 9 and max(r["count"] for r in sizes) < 1000
    assert sum(r["count"] for r in sizes) == 4099
    assert bitmix.score(docs).count() == 4099


def test_pairs_of_a_part_are_sent_once():
    """Chunks of one part share their pairs; both contexts go in one row; each pair is that of a plain count."""
    words = [b"a", b"bb", b"ccc", b"\n"]
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)

    def chunk(number, part, codes):
        return {"part": part, "chunk": number, "doc_ids": [1], "train": [True], "sizes": [len(codes)], "bytes": [9],
                "codes": pa.compress(np.array(codes, "<i4").tobytes(), "zstd", asbytes=True), "hashes": hashes.tobytes(),
                "symbols": bitmix._symbols(pa.array(words, pa.binary()), hashes).astype("<u2").tobytes()}

    def sent(*chunks):
        batches = [pa.RecordBatch.from_pylist([c], schema=bitmix._CHUNK_ARROW) for c in chunks]
        out = [r for b in bitmix._pairs(12)(iter(batches)) for r in b.to_pylist()]
        return [[r[k] for r in out if r[k] is not None] for k in ("one", "two")], len(out)

    first, second = chunk(0, 0, [0, 1, 2, 0, 3]), chunk(1, 0, [2, 2, 1, 3])
    (one, two), rows = sent(first, second)
    assert len(set(one)) == len(one) and len(set(two)) == len(two) and rows < len(one) + len(two)
    alone = [sent(c)[0] for c in (first, second)]
    assert set(one) == set(alone[0][0]) | set(alone[1][0]) and set(two) == set(alone[0][1]) | set(alone[1][1])
    want = set()
    for c in (first, second):
        symbol, before, _ = bitmix._Chunk(bitmix._plain(c), 12, 14).contexts()
        want |= {int(b) << 12 | 1 << d | int(s) >> (12 - d) for s, b in zip(symbol, before) for d in range(12)}
    assert set(one) == want


def test_pairs_take_little_memory():
    """Four chunks of one part are counted in less than 120 bytes a token of one chunk."""
    rng, n, known = np.random.default_rng(2), 300_000, 50_000
    hashes = rng.integers(0, 1 << 63, known, dtype=np.uint64)
    symbols = rng.integers(0, 1 << bitmix.MAX_DEPTH, known).astype("<u2").tobytes()
    batches = [pa.RecordBatch.from_pylist([{
        "part": 0, "chunk": i, "doc_ids": [1], "train": [True], "sizes": [n], "bytes": [9], "hashes": hashes.tobytes(),
        "codes": pa.compress(rng.integers(0, known, n).astype("<i4").tobytes(), "zstd", asbytes=True),
        "symbols": symbols}], schema=bitmix._CHUNK_ARROW) for i in range(4)]
    pairs = bitmix._pairs(bitmix.MAX_DEPTH)(iter(batches))
    tracemalloc.start()
    try:
        sent = sum(batch.num_rows for batch in pairs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sent > 4 * n and peak < 120 * n


def coded(number, codes, symbols, known):
    return pa.RecordBatch.from_pylist([{
        "part": 0, "chunk": number, "doc_ids": [1], "train": [True], "sizes": [len(codes)], "bytes": [9],
        "codes": pa.compress(codes.astype("<i4").tobytes(), "zstd", asbytes=True),
        "hashes": np.arange(known, dtype="<u8").tobytes(), "symbols": symbols.astype("<u2").tobytes()}],
        schema=bitmix._CHUNK_ARROW)


def test_pairs_beyond_the_largest_size_are_not_sent(spark, monkeypatch):
    """A context with enough pairs sends one row that says so; the shape is that of all pairs."""
    rng = np.random.default_rng(4)
    symbols = rng.integers(0, 1 << bitmix.MAX_DEPTH, 900)
    batches = [coded(i, rng.integers(0, 900, 3000), symbols, 900) for i in range(3)]
    every = pa.Table.from_batches(bitmix._pairs(14)(iter(batches)))
    assert every.num_rows > 30_000 and not any(every["many_one"].to_pylist() + every["many_two"].to_pylist())
    few = pa.Table.from_batches(bitmix._pairs(14, 100)(iter(batches)))
    assert few.to_pylist() == [{"one": None, "two": None, "many_one": True, "many_two": True}]
    same = [codes for codes in [np.arange(900)] * 3]        # as many of one as of the other, and none too many
    some = pa.Table.from_batches(bitmix._pairs(14, 10_000)(iter(coded(i, c, symbols, 900) for i, c in enumerate(same))))
    assert some.equals(pa.Table.from_batches(bitmix._pairs(14)(iter(coded(i, c, symbols, 900) for i, c in enumerate(same)))))
    chunks = spark.createDataFrame(pa.Table.from_batches(batches).to_pandas(), bitmix._CHUNK)
    monkeypatch.setattr(bitmix, "MAX_SLOT_BITS", 19)        # enough: 2^17, more than there are
    counted = bitmix.model_shape(chunks, 900)
    monkeypatch.setattr(bitmix, "SLOT_BITS", 10)
    monkeypatch.setattr(bitmix, "MAX_SLOT_BITS", 13)        # enough: 2^11
    assert counted == (12, 18, 18) and bitmix.model_shape(chunks, 900) == (12, 13, 13)


def test_a_bit_is_predicted_once_for_equal_contexts(monkeypatch):
    """Repeated texts cost one prediction a bit and slice, and have equal scores."""
    rng = np.random.default_rng(6)
    symbols, text = rng.integers(0, bitmix.NODES, 40), rng.integers(0, 40, 100)
    row = dict(part=0, chunk=0, doc_ids=list(range(50)), train=[True] * 50, sizes=[100] * 50, bytes=[1] * 50,
               codes=np.tile(text, 50).astype("<i4").tobytes(), hashes=b"", symbols=symbols.astype("<u2").tobytes())
    state, seen = bitmix.new_state(), np.zeros((bitmix.GATES, bitmix.INPUTS))
    bitmix.learn(state, bitmix._Chunk(row), seen)
    asked, plain = [], bitmix._bit_log10
    monkeypatch.setattr(bitmix, "_bit_log10", lambda model, begin, *rest: asked.append(len(begin)) or plain(
        model, begin, *rest))
    logs = bitmix.code_log10(bitmix._frozen(state), bitmix._Chunk(row)).reshape(50, 100)
    assert sum(asked) <= 100 * bitmix.DEPTH and (logs == logs[0]).all()
    monkeypatch.setattr(bitmix, "SLICE", 64)
    assert bitmix.code_log10(bitmix._frozen(state), bitmix._Chunk(row)).reshape(50, 100) == pytest.approx(logs, rel=1e-12)
