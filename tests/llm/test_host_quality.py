import random
import re

from cohortlens.llm.host_quality import host_quality, host_rates, measure, repeated_words, text_stats
from helpers import clash, documents


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def test_text_stats_equal_brute_force():
    rng = random.Random(3)
    cases = ["", None, " \n\t ", "a", "x\x1cy z w", "é ß\n\n é ß\r\n é ß", "a b c d e " * 4, "#*$ | <>&%"]
    cases += [" ".join(rng.choice("abc") + rng.choice(["", "\n", "\t"]) for _ in range(rng.randint(0, 60)))
              for _ in range(60)]
    for text in cases:
        assert text_stats(text) == brute(text), text
    assert repeated_words(list("abcde")) == 0


def test_edge_cases(spark):
    good = " ".join(f"w{i}" for i in range(20))
    texts = [None, "", good, good, "short", "a b c d e " * 50] + [good + f" {i}" for i in range(6)]
    docs = clash(documents(spark, texts, sources=["a", None]), "host", "kept", "n_words")
    out = {(r.doc_id): r for r in host_quality(docs).collect()}
    assert len(out) == len(texts)
    assert [out[i].base_failed for i in range(6)] == [True, True, False, False, True, True]
    assert out[2].kept and not out[0].kept
    empty = host_quality(documents(spark, []))
    assert empty.count() == 0


def test_bad_host_loses_its_documents_and_small_hosts_are_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(20))
    texts = ["bad"] * 90 + [good] * 10 + [good] * 300 + ["bad"] + [good]
    sources = ["spam"] * 100 + ["fine"] * 300 + ["tiny", "tiny"]
    rows = [(i, t, None, s, 0) for i, (t, s) in enumerate(zip(texts, sources))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in host_quality(docs).collect()}
    assert not any(out[i].kept for i in range(100))
    assert all(out[i].kept for i in range(100, 400))
    rates = {r.host: r for r in host_rates(measure(docs)).collect()}
    assert 0.22 < rates["tiny"].host_rate < 0.5 and out[401].kept


def test_salted_join_gives_the_same(spark):
    from cohortlens.llm.common import attach
    left = spark.createDataFrame([(i, None if i % 5 == 0 else "k" + str(i % 3)) for i in range(50)], "id long, k string")
    right = spark.createDataFrame([("k0", 1), (None, 2), ("k2", 3)], "k string, v int")
    one = sorted(map(tuple, attach(left, right, "k", 3).collect()), key=str)
    two = sorted(map(tuple, attach(left, right, "k", 3, limit=1).collect()), key=str)
    assert one == two and len(one) == 50
