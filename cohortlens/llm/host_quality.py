"""Host-level quality rules.

Every document is measured by simple rules. Rule failures are summed by host
(here the ``source`` column), the failure rate of a host is shrunk towards the
corpus with an empirical beta prior, and the host's verdict is joined back: a
document stays if it passes its own rules and its host's shrunk rate is at
most ``max_host_rate``.

Defined results: a null text has no words and fails; an empty text likewise.
A null host is a host of its own. Repeated rows are measured one by one. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import SPACES, attach
from cohortlens.session import materialize

# fixed values of the base rules
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# fixed value of the host rule: a host whose shrunk failure rate is higher goes
MAX_HOST_RATE = 0.5

_STATS = ("doc_id long, host string, n_words long, word_chars long, n_symbols long, "
          "n_dup_lines long, n_repeat_words long")


def repeated_words(words: list, width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i:i + n] for i in range(width))))
    if len(set(windows)) == n:
        return 0
    counts = Counter(windows)
    covered = until = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + width - max(i, until)
            until = i + width
    return covered


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()  # splits at SPACES only, as bytes
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats = [text_stats(x.as_py()) for x in batch.column("text")]
        columns = [pa.array(c, pa.int64()) for c in zip(*stats)] or [pa.array([], pa.int64())] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), *columns],
            names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                   "n_repeat_words"])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            host_col: str = "source") -> DataFrame:
    """One row of base counts per document, with the base verdict."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"),
                         F.col(host_col).cast("string").alias("host"))
    stats = picked.mapInArrow(_measure, _STATS)
    short = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return stats.withColumns({"fails_short": short, "fails_repeats": repeats,
                              "base_failed": short | repeats})


def host_rates(stats: DataFrame) -> DataFrame:
    """Failures by host and the rate shrunk with an empirical beta prior.

    The prior's mean m is the corpus rate; its strength s comes from the
    method of moments on the host rates (weighted by documents, binomial
    noise removed): s = m (1 - m) / variance - 1, kept within [1, 1e6]. The
    shrunk rate of a host is (failures + s m) / (documents + s).
    """
    hosts = materialize(
        stats.groupBy("host").agg(
            F.count(F.lit(1)).alias("host_docs"),
            F.sum(F.col("base_failed").cast("long")).alias("host_failed"),
            F.sum(F.col("fails_short").cast("long")).alias("host_short"),
            F.sum(F.col("fails_repeats").cast("long")).alias("host_repeats")),
        "host-failures")
    n, f = F.col("host_docs"), F.col("host_failed")
    total = hosts.agg(F.sum(n).alias("n"), F.sum(f).alias("f"), F.count(F.lit(1)).alias("h")).first()
    docs, failed, count = total["n"] or 0, total["f"] or 0, total["h"]
    mean = failed / docs if docs else 0.0
    spread = hosts.agg(F.sum(n * (f / n - F.lit(mean)) ** 2).alias("v")).first()["v"] or 0.0
    noise = mean * (1 - mean) * count
    variance = max(0.0, (spread - noise) / docs) if docs else 0.0
    strength = min(1e6, max(1.0, mean * (1 - mean) / variance - 1)) if variance > 0 else 1e6
    return hosts.withColumn("host_rate", (f + F.lit(strength * mean)) / (n + F.lit(strength)))


def host_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 host_col: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Base counts, base verdict, the host's shrunk rate and the joint verdict per document."""
    stats = materialize(measure(docs, id_col, text_col, host_col), "host-stats")
    hosts = host_rates(stats)
    joined = attach(stats, hosts.select("host", "host_docs", "host_failed", "host_rate"),
                    "host", hosts.count())
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate))
