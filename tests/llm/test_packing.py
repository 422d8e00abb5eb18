import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from cohortlens.llm import packing
from cohortlens.llm.tokens import tokenizer
from helpers import clash, documents

FILES = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def test_ids_equal_the_tokenizers_file():
    tok = tokenizer(*FILES)
    rng = random.Random(1)
    texts = ["", "a<|endoftext|>b", "don't  \n\n\t x 's'sa 　 x y \x1c\x85 z", "汉字 ½ ² ٣ 𝟘 é é 🙂🏽",
             " " * 3000 + "x", "\n" * 50, "ab" * 3000]
    pool = [chr(c) for c in range(0x20, 0x3000, 7)] + [" ", "\n", "'", "s", "1", " ", "\x0b", "\x1f"] * 30
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(800)]
    for text in texts:
        assert tok.encode(text).tolist() == tok.encode_exact(text).tolist(), repr(text)


def brute_cost(x, cost, window):
    f = [0] + [float("inf")] * (len(x) - 1)
    for j in range(1, len(x)):
        f[j] = min((f[i] + window - (x[j] - x[i]) + cost[j] for i in range(j) if x[j] - x[i] <= window),
                   default=float("inf"))
    return f[-1]


def test_cuts_are_the_cheapest():
    rng = random.Random(4)
    for _ in range(200):
        x = np.cumsum([0] + [rng.randint(1, 9) for _ in range(rng.randint(1, 40))])
        cost = np.array([rng.choice([0, 2, 5]) for _ in x])
        cuts = packing.best_cuts(x, cost, 16)
        index, before, total = {int(p): i for i, p in enumerate(x)}, 0, 0
        for c in cuts:
            assert c - before <= 16
            total += 16 - (c - before) + cost[index[c]]
            before = c
        assert before == x[-1] and total == brute_cost(x.tolist(), cost.tolist(), 16)


def check(pieces, texts, window):
    """Every id lies in exactly one piece, offsets have no gaps, digests agree."""
    tok = tokenizer(*FILES)
    ids = {i: np.append(tok.encode_exact(t or ""), np.uint32(0)).astype("<u4") for i, t in texts.items()}
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
        part = ids[p.doc_id][p.start:p.start + p.length]
        assert len(part) == p.length > 0 and zlib.crc32(part.tobytes()) == p.ids_crc32
        assert p.doc_tokens == len(ids[p.doc_id])
    assert set(by_doc) == set(ids)
    for d, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(ids[d])
    padding = 0
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padding += window - at
    return padding / (window * len(by_seq))


@pytest.mark.parametrize("stretch, window", [(1 << 20, 1024), (300, 64)])
def test_pieces(spark, monkeypatch, stretch, window):
    rng = random.Random(9)
    texts = [None, "", "word " * 4000, "One. Two! Three?\n" * 300, "x" * 5000] + [
        " ".join("".join(rng.choice("abcde") for _ in range(4)) + rng.choice(["", ".", ""]) for _ in range(
            rng.randint(1, 300))) for _ in range(60)]
    docs = clash(documents(spark, texts, parts=2), "start", "offset", "ids")
    rows = packing.pack(docs, *FILES, window=window).collect()
    share = check(rows, dict(enumerate(texts)), window)
    assert share < 0.1
    if stretch < 1000:  # the same on one stream that is solved in stretches
        monkeypatch.setattr(packing, "STRETCH", stretch)
        tok = tokenizer(*FILES)
        stream, out = packing._Stream(3, window, tok.ends), []
        for i, t in enumerate(texts):
            stream.add(i, np.append(tok.encode(t or ""), np.uint32(0)).astype(np.uint32))
            if stream.held >= stretch:
                out += stream.pack(False).to_pylist()
        out += stream.pack(True).to_pylist()
        from types import SimpleNamespace
        assert check([SimpleNamespace(**r) for r in out], dict(enumerate(texts)), window) < 0.1


def test_empty_and_repeated(spark):
    assert packing.pack(documents(spark, []), *FILES).count() == 0
    rows = packing.pack(documents(spark, ["a", "a"], ids=[None, 1], parts=1), *FILES).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == [("1", 2), ("None", 2)]
