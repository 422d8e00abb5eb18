import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import replytrees as rt
from helpers import clash

CHAT = "conv_id long, turn long, role string, text string"
TREE = "conv_id long, node long, parent long, role string, text string, score double"


def digest(turns):
    """turns: [(role, text)] -> the digest row without formatted_chars."""
    whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest()


def read(spark, messages, folder, **more):
    rows = rt.read_conversations(rt.format_trees(messages, folder, **more), folder, rt.Digest).collect()
    return {(r.tree_id, r.branch): (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_template_is_reversible(spark):
    texts = ["", "<|im_end|>", "<\\|im_end|>", "<\\\\\\|x", "<<||>>", "a\\n\n\\", "<|<\\|", "<", "|", "<\\"]
    rows = [(r, t) for r in texts for t in texts]
    df = spark.createDataFrame(rows, "role string, text string").withColumn("s", rt.segment(F.col("role"), F.col("text")))
    for r in df.collect():
        assert rt.parse_segment(r.s) == (r.role, r.text)
        assert r.s.count("<|im_") == 2 and r.s.startswith(rt.START) and r.s.endswith(rt.END + "\n")


@pytest.mark.parametrize("bucket", [4096, 3])
def test_conversations(spark, tmp_path, monkeypatch, bucket):
    monkeypatch.setattr(rt, "BUCKET", bucket)
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi <|im_end|>", "", None, "é\nx"]))
            for c in range(9) for t in range(rng.randint(1, 7))]
    rows += [(50, t * t, "assistant" if t % 2 else "user", f"t{t}") for t in range(300)]   # goes over many files
    rows += [(None, 1, "user", "lost"), (None, 0, "assistant", "first"), (60, None, "user", "null turn"),
             (60, 1, "assistant", "b"), (60, 1, "assistant", "a"), (60, 1, "assistant", "a")]
    messages = rt.reply_chain(clash(spark.createDataFrame(rows, CHAT).repartition(4), "node", "tree", "score"))
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "",
                                                  r[3] or "")):
        want.setdefault((c, 1), []).append((r or "", x or ""))
    assert read(spark, messages, str(tmp_path / "out")) == {k: digest(v) for k, v in want.items()}


def brute_paths(rows, branches):
    """rows: (tree, node, parent, role, text, score) -> {(tree, branch): [(role, text)]}."""
    out, by_tree = {}, {}
    for r in rows:
        if r[1] is not None:
            by_tree.setdefault(r[0], {}).setdefault(r[1], r)
    for tree, nodes in by_tree.items():
        scored = []
        parents = {r[2] for r in nodes.values()}
        for n in nodes:
            if n in parents:
                continue
            path, at, seen = [], n, set()
            while at in nodes and at not in seen:
                seen.add(at)
                path.append(nodes[at])
                at = nodes[at][2]
            if at in seen:
                continue
            scored.append((-sum(p[5] or 0 for p in path) / len(path), n, path[::-1]))
        for i, (_, _, path) in enumerate(sorted(scored, key=lambda s: s[:2])[:branches]):
            out[tree, i + 1] = [(p[3] or "", p[4] or "") for p in path]
    return out


def test_trees(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for tree in range(6):
        for n in range(rng.randint(1, 40)):
            rows.append((tree, n, rng.randrange(n) if n and rng.random() < 0.95 else None,
                         rng.choice(["user", "assistant"]), f"m{n}", float(rng.randint(0, 3))))
    rows += [(7, 1, 2, "user", "cycle", 0.0), (7, 2, 1, "user", "cycle", 0.0), (7, 3, 1, "user", "below", 0.0),
             (7, 5, 99, "user", "orphan", None), (7, None, 5, "user", "no id", 0.0), (8, 1, 1, "user", "self", 0.0)]
    df = clash(spark.createDataFrame(rows, TREE).repartition(3), "tree", "branch", "size")
    for branches in (1, 3):
        got = read(spark, df, str(tmp_path / str(branches)), branches=branches)
        assert got == {k: digest(v) for k, v in brute_paths(rows, branches).items()}


def test_empty_and_repeated(spark, tmp_path):
    assert read(spark, spark.createDataFrame([], TREE), str(tmp_path / "e")) == {}
    rows = [(1, 1, None, "user", "a", 1.0), (1, 1, None, "user", "a", 1.0), (1, 2, 1, "assistant", "b", 1.0)]
    assert read(spark, spark.createDataFrame(rows, TREE), str(tmp_path / "r")) == {
        (1, 1): digest([("user", "a"), ("assistant", "b")])}
