"""Order-preserving packing by dynamic programming.

The documents of a partition form one stream of tokens, in input order. The
stream is cut into windows of at most ``window`` tokens. Cuts are allowed at
document ends, at sentence ends (for a penalty) and, inside sentences longer
than a quarter window, every quarter window (for a larger penalty). The cost
of a window is its padding plus the penalty of its end; the cheapest cuts come
from f(j) = min f(i) + window - (x_j - x_i) + penalty(j) over the cuts i at
most a window before j, where a monotone queue holds the candidates, so a
transition takes constant amortised time.

Partitions are packed side by side, without a shuffle, and a stream is solved
in stretches of about ``STRETCH`` tokens, whose last windows are carried into
the next; so memory is bounded by the stretch and the longest document.

Defined results: a null or empty text is the end token alone. Repeated rows
and null ids are packed row by row. Other columns are ignored. An empty table
gives an empty result. Sequence ids hold the partition in their high bits.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tokens import tokenizer

# fixed values of the contract
WINDOW = 1024
END_ID = 0

SENTENCE_PENALTY = 16   # tokens of padding that a cut at a sentence end is worth
INSIDE_PENALTY = 96     # the same for a cut inside a long sentence
STRETCH = 1 << 20       # tokens that are solved together

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")


def candidates(stream: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray,
               window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts of the stream, ascending from 0, and the penalty of each."""
    sentence = np.flatnonzero(ends[stream]) + 1
    cuts = np.unique(np.concatenate(([0], sentence, doc_ends)))
    penalty = np.full(len(cuts), SENTENCE_PENALTY)
    quarter = max(1, window // 4)
    gaps = np.diff(cuts)
    wide = np.flatnonzero(gaps > quarter)
    if len(wide):
        extra = np.concatenate([np.arange(cuts[i] + quarter, cuts[i + 1], quarter) for i in wide])
        cuts, penalty = np.concatenate((cuts, extra)), np.concatenate((penalty, np.full(len(extra), INSIDE_PENALTY)))
        order = np.argsort(cuts, kind="stable")
        cuts, penalty = cuts[order], penalty[order]
    penalty[np.isin(cuts, doc_ends, assume_unique=True)] = 0
    return cuts, penalty


def best_cuts(cuts: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """The cheapest window ends (ascending, the last is the stream's end)."""
    x, cost = cuts.tolist(), penalty.tolist()
    came = [0] * len(x)
    queue: deque = deque([(0, 0, 0)])  # (f(i) + x_i, x_i, i): values rise, so the head is the least
    for j in range(1, len(x)):
        here = x[j]
        while queue[0][1] < here - window:
            queue.popleft()
        value, _, came[j] = queue[0]
        value += window + cost[j]      # f(j) + x_j
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, here, j))
    out, j = [], len(x) - 1
    while j > 0:
        out.append(x[j])
        j = came[j]
    return out[::-1]


class _Stream:
    """The tokens of one partition that are not yet in a finished window."""

    def __init__(self, partition: int, window: int, ends: np.ndarray):
        self.next_sequence = partition << 33
        self.window, self.ends = window, ends
        self.docs: list[tuple] = []     # (doc_id, tokens before, ids left, tokens in all)
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, 0, ids, len(ids)))
        self.held += len(ids)

    def pack(self, last: bool) -> pa.RecordBatch:
        """Pieces of the finished windows; unless ``last``, two windows are kept back."""
        stream = np.concatenate([d[2] for d in self.docs])
        doc_ends = np.cumsum([len(d[2]) for d in self.docs])
        windows = best_cuts(*candidates(stream, doc_ends, self.ends, self.window), self.window)
        if not last:
            windows = windows[:-2]
        done = windows[-1] if windows else 0
        edges = np.unique(np.concatenate(([0], windows, doc_ends[doc_ends <= done]))).astype(np.int64)
        a, b = edges[:-1], edges[1:]
        doc = np.searchsorted(doc_ends, a, side="right")
        doc_start = np.concatenate(([0], doc_ends))[doc]
        window = np.searchsorted(windows, a, side="right")
        window_start = np.concatenate(([0], windows)).astype(np.int64)[window]
        before = np.array([d[1] for d in self.docs], dtype=np.int64)[doc]
        batch = pa.RecordBatch.from_arrays([
            pa.array([self.docs[i][0] for i in doc], pa.int64()),
            pa.array(a - doc_start + before), pa.array(b - a),
            pa.array([zlib.crc32(stream[i:j]) for i, j in zip(a, b)], pa.int64()),
            pa.array([self.docs[i][3] for i in doc], pa.int64()),
            pa.array(window + self.next_sequence), pa.array(a - window_start)],
            names=[c.split()[0] for c in PIECES.split(", ")])
        self.next_sequence += len(windows)
        if last:
            return batch
        first = int(np.searchsorted(doc_ends, done, side="right"))
        left = self.docs[first:]
        if left:
            cut = done - (int(doc_ends[first - 1]) if first else 0)
            doc_id, start, ids, total = left[0]
            left[0] = (doc_id, start + cut, ids[cut:], total)
        self.docs, self.held = left, len(stream) - done
        return batch


def pack(docs: DataFrame, tokenizer_file: str, rank_file: str, pattern: str, id_col: str = "doc_id",
         text_col: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document in a sequence of at most ``window`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_file, rank_file, pattern)
        stream = _Stream(TaskContext.get().partitionId(), window, tok.ends)
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                stream.add(doc_id, np.concatenate((tok.encode(text), end)) if text else end)
                if stream.held >= STRETCH:
                    yield stream.pack(last=False)
        if stream.docs:
            yield stream.pack(last=True)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES)
