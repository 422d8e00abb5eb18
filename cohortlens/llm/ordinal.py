"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Binary hashed features of a whole text (its words and their starts, how large
a part of them has a given shape or repeats the word before, repeated lines) share one weight vector; ordered
thresholds turn the score s = w.x into P(grade <= g) = sigmoid(t_g - s). The
expected grade and the tail probability P(grade >= wanted) select documents.

The model is fitted on at most ``sample`` graded rows, those of smallest id
hash; every document is scored over its whole text.

Defined results: a null or empty text has the single feature "no words".
Grades may be any integers; a row with a null grade or id is ignored, and of
repeated ratings the lowest holds; of repeated documents with a rating one
row is fitted. Without ratings every document has the
tail probability 1 and an expected grade of 0. Repeated rows and null ids are
scored row by row. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import slices, token_lists

BUCKET_BITS = 22        # hashed features, as a power of two
SAMPLE = 12_000         # graded rows that the fit uses at most
EPOCHS = 25
BATCH = 64
RATE = 0.7
THRESHOLD_RATE = 0.1
LEAST_GAP = 0.1         # between neighbouring thresholds
DECAY = 1e-5
LEAST_DOCS = 4          # a feature seen in fewer sample rows has no weight,
LEAST_SHIFT = 0.3       # nor one whose rows differ less from the rest in P(grade <= g),
LEAST_Z = 7.0           # or by fewer standard errors
SHARES = (0.0, 0.02, 0.1, 0.3, 0.6)  # steps of a shape's share of the words
START_BYTES = 5         # of a word that make a feature beside the word itself
SLICE_BYTES = 4 << 20

# fixed values of the selection: the lowest grade that is wanted, and its least probability
# as a share of that of a document without any telling feature
WANTED = 2
KEEP = 0.8

_PUNCTUATION = b".,!?;:\"'()[]"
_SHAPE = str.maketrans({**{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"},
                        **{c: "0" for c in "0123456789"}})
_RUNS = re.compile(r"(.)\1+", re.S)


def _bucket(kind: str, name: bytes) -> int:
    return xxhash.xxh64_intdigest(name, seed=xxhash.xxh32_intdigest(kind)) >> (64 - BUCKET_BITS)


def shape(word: str) -> str:
    """Upper case, lower case and digits as A, a, 0; other letters as a; runs once."""
    mapped = "".join("a" if c >= "\x80" else c for c in word.translate(_SHAPE)) if not word.isascii() else \
        word.translate(_SHAPE)
    return _RUNS.sub(r"\1", mapped)[:8]


def features(texts: pa.Array, dense: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature bucket) pairs of all texts, sorted by text.

    With ``dense`` weights, only the pairs whose bucket has a weight.
    """
    offsets, words = token_lists(texts)
    n, sizes = len(texts), np.diff(offsets)
    coded = words.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    text_of, codes = np.repeat(np.arange(n), sizes), coded.indices.to_numpy().astype(np.int64)
    pairs = []

    def add(texts_: np.ndarray, buckets) -> None:
        buckets = np.broadcast_to(buckets, texts_.shape)
        if dense is not None:
            has = dense[buckets] != 0
            texts_, buckets = texts_[has], buckets[has]
        pairs.append((texts_.astype(np.int64) << BUCKET_BITS) | buckets)

    if len(codes):
        both, counts = np.unique(text_of * len(distinct) + codes, return_counts=True)
        doc, code = both // len(distinct), both % len(distinct)
        plain = [w.encode().lower().strip(_PUNCTUATION) for w in distinct]
        add(doc, np.array([_bucket("word", w) for w in plain])[code])
        add(doc, np.array([_bucket("start", w[:START_BYTES]) for w in plain])[code])
        # how large a part of the words has each shape, or repeats the word before, in steps
        shapes: dict[str, int] = {}
        word_shape = np.array([shapes.setdefault(shape(w), len(shapes)) for w in distinct])
        of_shape, which = np.unique(doc * len(shapes) + word_shape[code], return_inverse=True)
        doc, kind = of_shape // len(shapes), of_shape % len(shapes)
        share = np.bincount(which, weights=counts) / sizes[doc]
        again = np.flatnonzero((codes[1:] == codes[:-1]) & (text_of[1:] == text_of[:-1])) + 1
        stutter = np.bincount(text_of[again], minlength=n) / np.maximum(1, sizes)
        for step, least in enumerate(SHARES):
            bucket = np.array([_bucket(f"shape{step}", s.encode()) for s in shapes])
            add(doc[share > least], bucket[kind[share > least]])
            add(np.flatnonzero(stutter > least), _bucket(f"again{step}", b""))
    for i, text in enumerate(texts):
        lines = [x for x in (text.as_py() or "").split("\n") if x.strip()]
        repeated = len(lines) - len(set(lines))
        if not lines:
            add(np.array([i]), _bucket("none", b""))
        for step, least in enumerate(SHARES):
            if lines and repeated > least * len(lines):
                add(np.array([i]), _bucket(f"lines{step}", b""))
    found = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return found >> BUCKET_BITS, found & ((1 << BUCKET_BITS) - 1)


@dataclass
class OrdinalModel:
    """Sparse weights of the feature buckets, thresholds between the grades, and the grades."""

    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BUCKET_BITS, dtype=np.float32)
        w[self.buckets] = self.weights
        return w

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """P(grade) per score and grade."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))
        edges = np.concatenate((np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))), axis=1)
        return np.diff(edges, axis=1)


def bar(model: OrdinalModel, wanted: int = WANTED, keep: float = KEEP) -> float:
    """The tail probability from which documents are kept.

    It is relative to a document of score 0, so a model that few ratings have
    taught little keeps what it knows nothing against.
    """
    if not len(model.grades):
        return 0.0
    return keep * float(model.chances(np.zeros(1))[0, model.grades >= wanted].sum())


def _telling(column: np.ndarray, starts: np.ndarray, y: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Features whose presence shifts some P(grade <= g) by ``LEAST_SHIFT`` and ``LEAST_Z`` standard errors."""
    of = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(starts))
    n, best = len(y), np.zeros(len(seen))
    for level in range(y.max()):
        low = y <= level
        share = low.mean()
        shift = np.bincount(column, weights=low[of], minlength=len(seen)) - share * seen
        error = np.sqrt(np.maximum(share * (1 - share) * seen * (1 - seen / (n + 1)), 1e-9))
        best = np.maximum(best, np.where(np.abs(shift) >= LEAST_SHIFT * seen, np.abs(shift) / error, 0))
    return best >= LEAST_Z


def fit(starts: np.ndarray, buckets: np.ndarray, grades: np.ndarray, epochs: int = EPOCHS) -> OrdinalModel:
    """Maximum likelihood with a little weight decay, by Adagrad over small batches.

    ``starts`` marks where each text's buckets begin (one more at the end);
    ``grades`` are the ratings in the same order, which is also the order of
    the passes.
    """
    levels, y = np.unique(grades, return_inverse=True)
    if len(levels) < 2:
        return OrdinalModel(np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0), levels)
    seen = np.bincount(buckets, minlength=1 << BUCKET_BITS)
    known = np.flatnonzero(seen)
    place = np.zeros(1 << BUCKET_BITS, dtype=np.int32)
    place[known] = np.arange(len(known))
    column, seen = place[buckets], seen[known]
    kept = _telling(column, starts, y, seen) & (seen >= LEAST_DOCS)
    column = np.where(kept[column], column, np.int32(len(known)))
    w, g2 = np.zeros(len(known) + 1), np.full(len(known) + 1, 1e-3)  # the last one stands for rare features
    below = np.cumsum(np.bincount(y))[:-1] / len(y)
    t, t2 = np.log(below / (1 - below)), np.full(len(levels) - 1, 1e-3)
    texts = len(y)
    for epoch in range(epochs):
        order = np.random.default_rng(epoch).permutation(texts)
        for i in range(0, texts, BATCH):
            rows = order[i:i + BATCH]
            parts = [column[starts[r]:starts[r + 1]] for r in rows]
            sizes = np.array([len(p) for p in parts])
            cols, of = np.concatenate(parts), np.repeat(np.arange(len(rows)), sizes)
            s = np.bincount(of, weights=w[cols], minlength=len(rows))
            edge = np.concatenate(([-np.inf], t, [np.inf]))
            hi, lo = (1 / (1 + np.exp(-np.clip(edge[y[rows] + k] - s, -60, 60))) for k in (1, 0))
            slope = hi + lo - 1                                     # d log P / d s
            chance = np.maximum(hi - lo, 1e-3)                      # bounds a single text's pull
            grad = np.bincount(cols, weights=slope[of], minlength=len(w))
            touched = np.unique(cols)
            touched = touched[touched < len(known)]
            step = grad[touched] - DECAY * BATCH * w[touched]
            g2[touched] += step * step
            w[touched] += RATE * step / np.sqrt(g2[touched])
            dt = np.zeros(len(t) + 2)
            np.add.at(dt, y[rows] + 1, hi * (1 - hi) / chance)
            np.add.at(dt, y[rows], -lo * (1 - lo) / chance)
            dt = dt[1:-1]
            t2 += dt * dt
            t = t + THRESHOLD_RATE * dt / np.sqrt(t2)
            gaps = np.maximum(np.diff(t), LEAST_GAP)                # strictly ordered
            t = t[-1] - np.concatenate((np.cumsum(gaps[::-1])[::-1], [0.0]))
    used = np.flatnonzero(w[:-1])
    return OrdinalModel(known[used], w[used].astype(np.float32), t, levels)


def fit_ratings(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rating_id: str = "doc_id", grade_col: str = "grade", sample: int = SAMPLE) -> OrdinalModel:
    """Fit on at most ``sample`` rated documents (smallest id hashes)."""
    rated = ratings.filter(F.col(rating_id).isNotNull() & F.col(grade_col).isNotNull()).groupBy(
        F.col(rating_id).cast("long").alias("rated_id")).agg(F.min(F.col(grade_col).cast("long")).alias("grade"))
    chosen = rated.orderBy(F.xxhash64("rated_id"), "rated_id").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            doc, bucket = features(batch.column("text"))
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            packed = [bucket[a:b].astype("<i4").tobytes() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"),
                                              pa.array(packed, pa.binary())], names=["doc_id", "grade", "buckets"])

    # one row per chosen id: the text of the smallest hash (of equal hashes, the smallest text)
    matched = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("rated_id"))
    single = matched.groupBy("doc_id").agg(F.min("grade").alias("grade"), F.min_by(
        "text", F.struct(F.xxhash64("text"), F.coalesce("text", F.lit("")))).alias("text"))
    rows = single.select("doc_id", "grade", "text").mapInArrow(
        run, "doc_id long, grade long, buckets binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["buckets"]))
    grades = np.array([r["grade"] for r in rows], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum([len(r["buckets"]) // 4 for r in rows]))).astype(np.int64)
    buckets = np.frombuffer(b"".join(r["buckets"] for r in rows), "<i4")
    del rows
    return fit(starts, buckets, grades)


def _scores(texts: pa.Array, dense: np.ndarray) -> np.ndarray:
    doc, bucket = features(texts, dense)
    return np.bincount(doc, weights=dense[bucket], minlength=len(texts))


def judge(docs: DataFrame, model: OrdinalModel, wanted: int, text_col: str = "text",
          extra: tuple[str, str] = ("expected_grade", "tail_prob")) -> DataFrame:
    """All rows and columns of ``docs`` with the expected grade and P(grade >= wanted).

    The two columns take the names in ``extra``; a column of ``docs`` with
    such a name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(*extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        dense = m.dense()
        for batch in slices(batches, text_col, SLICE_BYTES):
            if len(m.grades):
                p = m.chances(_scores(batch.column(text_col), dense))
                mean, tail = p @ m.grades, p[:, m.grades >= wanted].sum(axis=1)
            else:
                mean, tail = np.zeros(batch.num_rows), np.ones(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mean.astype(float)), pa.array(tail.astype(float))],
                                             names=[*batch.schema.names, *extra])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in extra)])
    return docs.mapInArrow(run, schema)


def label_grades(labels: DataFrame) -> DataFrame:
    """Ratings from the labels table: 0 poor, 1 sound but toxic, 2 sound and clean."""
    quality, toxic = F.col("quality").cast("int"), F.col("toxic").cast("int")
    return labels.select("doc_id", F.when(quality == 0, 0).when(toxic == 1, 1).when(
        (quality == 1) & (toxic == 0), 2).alias("grade"))
