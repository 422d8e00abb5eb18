"""The whole score of op10 against a plain loop over tokens and bits."""

import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortlens.llm import bitmix
from helpers import documents

DEPTH, SLOTS = 12, 18
M = 0xFFFFFFFF


def code(token):
    word = b"\n" if token is None else token.encode()
    tail = xxhash.xxh32_intdigest(word[-2:]) % 32
    return (tail << 9 | xxhash.xxh64_intdigest(word) % 512) >> (14 - DEPTH)


def bits_of(tokens):
    """Per token the (bit, bit position, slots) of its code given the tokens before."""
    before = tail = 0
    for t in tokens:
        symbol = code(t)
        now = (before + 127) >> 7
        two = now * 40 + tail
        out = []
        for d in range(DEPTH):
            node = 1 << d | symbol >> (DEPTH - d)
            mixed = node * 0x9E3779B1 & M
            h1 = ((before * 0x85EBCA6B + mixed & M) * 0xC2B2AE35 & M) >> (32 - SLOTS)
            h2 = ((two * 0x27D4EB2F + mixed & M) * 0x165667B1 & M) >> (32 - SLOTS)
            out.append((symbol >> (DEPTH - 1 - d) & 1, d, ((0, node), (1, h1), (2, h2))))
        yield out
        before, tail = symbol + 1, now


class Plain:
    def __init__(self):
        self.counts = defaultdict(lambda: [0, 0])
        self.weights = defaultdict(lambda: [0.6, 0.2, 0.2, 0.0])
        self.slopes = defaultdict(lambda: [0.0] * 4)
        self.map = {(d, b): [4 / (1 + math.exp(-(b - 15.5) / 2)), 4.0] for d in range(DEPTH) for b in range(32)}

    def mix(self, d, slots):
        pairs = [self.counts[s] if s in self.counts else (0, 0) for s in slots]
        xs = [math.log((one + 0.4) / (zero + 0.4)) for zero, one in pairs] + [1.0]
        levels = [sum(sum(p) > least for least in (0, 3, 31)) for p in pairs[1:]]
        gate = (d, *levels)
        dot = sum(w * x for w, x in zip(self.weights[gate], xs))
        return xs, gate, dot, (d, int(min(31, max(0, dot * 2 + 16))))

    def learn(self, tokens, block, portion):
        for i in range(0, len(tokens), block):
            for j in range(i, min(i + block, len(tokens)), portion):
                slopes = defaultdict(lambda: [0.0] * 4)
                seen = []
                for bit, d, slots in chain.from_iterable(tokens[j:min(j + portion, i + block)]):
                    xs, gate, dot, place = self.mix(d, slots)
                    for n, x in enumerate(xs):
                        slopes[gate][n] += (bit - 1 / (1 + math.exp(-dot))) * x
                    seen.append((place, bit))
                for gate, row in slopes.items():
                    for n, g in enumerate(row):
                        self.slopes[gate][n] += g * g
                        self.weights[gate][n] += 0.02 * g / math.sqrt(self.slopes[gate][n] + 1e-6)
                for place, bit in seen:
                    self.map[place][0] += bit
                    self.map[place][1] += 1
            for bit, _, slots in chain.from_iterable(tokens[i:i + block]):
                for s in slots:
                    self.counts[s][bit] += 1

    def log10(self, bits):
        total = 0.0
        for bit, d, slots in bits:
            _, _, dot, place = self.mix(d, slots)
            ones, every = self.map[place]
            p = (1 / (1 + math.exp(-dot)) + (ones + 0.5) / (every + 1)) / 2
            p = min(1 - 1e-6, max(1e-6, p))
            total += math.log10(p if bit else 1 - p)
        return total


def test_score_equals_a_plain_loop(spark):
    rng = np.random.default_rng(5)
    words = "the a cat dog Sat mat on running Überall new".split()
    texts = [" ".join(rng.choice(words, rng.integers(0, 260))) for _ in range(360)] + [None, "unseen only here", ""]
    docs = documents(spark, texts, parts=3)

    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]

    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    dealt = bitmix.deal(docs.select("doc_id", "text", F.lit(True).alias("train"))).collect()
    plain, stream = Plain(), []
    counts = Counter()
    for r in dealt:  # one part: the order in which it is learned
        if not held[r.doc_id]:
            stream += list(bits_of(tokens(r.text)))
            counts.update(tokens(r.text))
    assert len(stream) > bitmix.BLOCK
    plain.learn(stream, bitmix.BLOCK, bitmix.PORTION)
    room = Counter()
    for t, n in counts.items():
        room[code(t)] += n + 1
    out = {r.doc_id: r for r in bitmix.score(docs).collect()}
    for i, text in list(enumerate(texts))[::6] + list(enumerate(texts))[-3:]:
        want = sum(plain.log10(b) + math.log10((counts[t] + 1) / (1 + room[code(t)]))
                   for t, b in zip(tokens(text), bits_of(tokens(text))))
        assert out[i].score == pytest.approx(want, rel=2e-3), i
