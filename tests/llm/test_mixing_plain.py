"""Posteriors of op9 against a plain naive Bayes."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from cohortlens.llm import mixing
from helpers import documents

FEATURES = 40


def features(text):
    """(family, bucket) twice per word: the word and its last two characters."""
    mask = mixing.BUCKETS - 1
    end = xxhash.xxh64_intdigest(b"end", seed=42)
    for w in re.split(r"[\x20\x09-\x0D]+", text or ""):
        if w:
            yield 0, xxhash.xxh64_intdigest(w.encode(), seed=42) & mask
            yield 1, xxhash.xxh64_intdigest(w[-2:].encode(), seed=end) & mask


def plain(rows, domain_of):
    """rows: {doc_id: text} -> {doc_id: (tokens, posteriors)}."""
    domains = sorted(set(domain_of.values()))
    size = Counter(domain_of.values())
    words = {k: Counter() for k in domains}
    holding = {k: Counter() for k in domains}
    for d, k in domain_of.items():
        found = Counter(features(rows[d]))
        words[k] += found
        holding[k].update(found.keys())
    every = sum(size.values())
    z = {}
    for f in set().union(*words.values()):
        n = sum(holding[k][f] for k in domains)
        best = 0.0
        for k in domains:
            share = size[k] / every
            shift = abs(holding[k][f] - share * n)
            if shift >= mixing.LEAST_SHIFT * n:
                best = max(best, shift / math.sqrt(share * (1 - share) * n))
        if best >= mixing.LEAST_Z:
            z[f] = best
    telling = set(sorted(z, key=lambda f: (-z[f], f))[:FEATURES])
    assert 2 < len(telling) < FEATURES
    out = {}
    for d, text in rows.items():
        logs = []
        for k in domains:
            log = math.log(size[k] / every)
            for f in features(text):
                total = sum(n for g, n in words[k].items() if g[0] == f[0])
                own = sum(words[k][g] for g in telling if g[0] == f[0])
                room = total + 1 + mixing.SMOOTH * FEATURES
                log += math.log((words[k][f] + mixing.SMOOTH) / room if f in telling else (total - own + 1) / room)
            logs.append(log)
        e = [math.exp(x - max(logs)) for x in logs]
        out[d] = (sum(1 for _ in features(text)) // 2, [x / sum(e) for x in e])
    return out


def test_posteriors_equal_a_plain_naive_bayes(spark):
    rng = np.random.default_rng(2)
    vocabulary = {"clean": "good fine nice common shared text", "poor": "zzq xxv common shared text brk",
                  "toxic": "vile nasty common text shared grim"}
    texts, domain_of = [], {}
    for i in range(180):
        domain = ("clean", "clean", "poor", "toxic")[i % 4]
        texts.append(" ".join(rng.choice(vocabulary[domain].split(), rng.integers(1, 12))))
        domain_of[i] = domain
    texts += [None, "", "Überall neue words\tonly", "good good vile", "zzq"]
    docs = documents(spark, texts)
    labels = spark.createDataFrame(list(domain_of.items()), "doc_id long, domain string")
    model = mixing.fit_domains(docs, labels, features=FEATURES)
    assert model.domains == ["clean", "poor", "toxic"]
    want = plain(dict(enumerate(texts)), domain_of)
    got = {r.doc_id: r for r in mixing.posteriors(docs, model).collect()}
    assert got.keys() == want.keys()
    for d, (tokens, p) in want.items():
        assert got[d].tokens == tokens and got[d].p == pytest.approx(p, rel=1e-9, abs=1e-12), d
