"""SimHash near-duplicates with pivot distance tables.

A document's fingerprint has 64 bits: a bit is 1 if it is set in over half of
the XXH64 values (seed 42) of its word shingles. Documents whose fingerprints
differ in at most ``max_bits`` bits are linked; groups are the connected
components.

Equal fingerprints are merged first, so exact copies cost one row. Candidate
runs come from block keys: the 64 bits are cut into ``max_bits + r`` blocks,
two fingerprints within the distance agree on at least r blocks, and so meet
under the key of those r blocks (r follows the number of fingerprints and
changes no result). Within a run every fingerprint gets its Hamming distances
to the reference fingerprints; pairs whose largest coordinate difference
exceeds ``max_bits`` are discarded, and the survivors are verified bit by
bit. Runs longer than ``SCAN_RUN`` are searched breadth first, which gives a
spanning forest instead of all pairs; runs longer than ``MAX_RUN`` are first
dealt out as pairs of parts, so that no task holds an unbounded run.

(The pivot table alone cannot make the candidates: distances of random
64-bit values to any reference lie within 32 +- 4, so a window of +-4 keeps
over half of all pairs per coordinate.)

Defined results: a null or empty text has fingerprint zero, which is linked
like any other. Repeated rows share a group; a null id is its own group's
member and never names it unless the group has no other id. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import attach, free_names
from cohortlens.llm.components import components
from cohortlens.session import materialize

# fixed values of the contract
SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42

REFERENCES = 16     # size of the pivot table
SCAN_RUN = 64       # longer runs are searched breadth first
MAX_RUN = 16_384    # longer runs are dealt out as pairs of parts
KEY_LOAD = 32       # fingerprints a block key may expect to hold


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_per_shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends)]
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[s:e], SEED) for s, e in zip(starts, ends[words_per_shingle - 1:])],
                      dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) per document; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), words_per_shingle) for x in batch.column("text")],
                           dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())],
                                             names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


# --- candidate keys ---------------------------------------------------------------

def _blocks(count: int) -> list[tuple[int, int]]:
    """(shift, width) of ``count`` blocks that cover 64 bits."""
    edges = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def block_keys(fps: int, max_bits: int = MAX_BITS) -> list[list[tuple[int, int]]]:
    """For each key the blocks that it holds, so that a key expects at most
    ``KEY_LOAD`` of ``fps`` fingerprints (as far as 64 bits allow)."""
    kept = 1
    while kept < 6 and fps >> (64 * kept // (max_bits + kept)) > KEY_LOAD:
        kept += 1
    return [list(c) for c in combinations(_blocks(max_bits + kept), kept)]


def _keyed(fps: DataFrame, keys: list[list[tuple[int, int]]]) -> DataFrame:
    """(key, fp) for each fingerprint and each of its block keys."""
    parts = []
    for number, blocks in enumerate(keys):
        bits = [F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)) for shift, width in blocks]
        parts.append(F.xxhash64(F.lit(number), *bits))
    return fps.select(F.explode(F.array(*parts)).alias("key"), "fp")


# --- verification within runs -------------------------------------------------------

def pivot_table(fps: np.ndarray, references: int = REFERENCES) -> np.ndarray:
    """Hamming distances of each fingerprint to the reference fingerprints."""
    refs = np.random.default_rng(7).integers(0, 2**63, references, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def _near(fps, table, i, j, max_bits):
    """Which of the pairs (i, j) are within the distance: table first, then bit by bit."""
    keep = np.abs(table[i] - table[j]).max(axis=1) <= max_bits
    keep[keep] = np.bitwise_count(fps[i[keep]] ^ fps[j[keep]]) <= max_bits
    return keep


def _search(fps: np.ndarray, table: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one long run."""
    links, left = [], np.arange(len(fps))
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = _near(fps, table, np.full(len(left), at), left, max_bits)
            found = left[near]
            links += [(at, x) for x in found]
            todo += list(found)
            left = left[~near]
    return links


def run_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the runs of equal keys (keys are sorted)."""
    unsigned = fps.view(np.uint64)
    table = pivot_table(unsigned)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    lengths = np.diff(np.concatenate((starts, [len(keys)])))
    a, b = [], []
    for s, n in zip(starts[lengths > SCAN_RUN], lengths[lengths > SCAN_RUN]):
        for i, j in _search(unsigned[s:s + n], table[s:s + n], max_bits):
            a.append([s + i])
            b.append([s + j])
    room = np.repeat(starts + lengths, lengths)  # where the run of each row ends
    room[np.repeat(lengths > SCAN_RUN, lengths)] = 0
    rows = np.arange(len(keys))
    for step in range(1, SCAN_RUN):
        i = rows[rows + step < room]
        if not len(i):
            break
        i = i[_near(unsigned, table, i, i + step, max_bits)]
        a.append(i)
        b.append(i + step)
    if not a:
        return fps[:0], fps[:0]
    return fps[np.concatenate(a).astype(np.int64)], fps[np.concatenate(b).astype(np.int64)]


def _link_batches(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)

        def links(k, f):
            a, b = run_links(k, f, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate((keys, batch.column("key").to_numpy()))
            fps = np.concatenate((fps, batch.column("fp").to_numpy()))
            cut = np.searchsorted(keys, keys[-1]) if len(keys) else 0  # the last run may go on
            if cut:
                yield links(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield links(keys, fps)

    return run


def links(fps: DataFrame, count: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Enough links (a, b) between the distinct fingerprints ``fps`` to connect
    all that are within the distance; ``count`` is their number."""
    keyed = _keyed(fps, block_keys(count, max_bits))
    long_runs = materialize(keyed.groupBy("key").count().filter(F.col("count") > MAX_RUN), "simhash-long-runs")
    number = long_runs.count()
    if number:
        keyed = attach(keyed, long_runs, "key", number)
        parts = F.ceil(2 * F.col("count") / F.lit(MAX_RUN)).cast("int")
        part = F.pmod(F.xxhash64("fp"), parts).cast("int")
        dealt = F.transform(F.sequence(F.lit(0), parts - 1),
                            lambda p: F.xxhash64(F.col("key"), F.least(p, part), F.greatest(p, part)))
        keyed = keyed.select(F.explode(F.when(F.col("count").isNull(), F.array("key")).otherwise(dealt))
                             .alias("key"), "fp")
    return (keyed.repartition("key").sortWithinPartitions("key", "fp")
            .mapInArrow(_link_batches(max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every document."""
    return _grouped(docs, id_col, text_col, words_per_shingle, max_bits)[0]


def _grouped(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int,
             max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The documents' groups, and (fp, first_id, copies, root) per fingerprint."""
    rows = materialize(fingerprints(docs, id_col, text_col, words_per_shingle), "simhash-docs")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")),
                      "simhash-fps")
    found = links(fps.select("fp"), fps.count(), max_bits)
    roots = components(found, "a", "b")                       # (node, root) of linked fingerprints
    grouped = fps.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    ids = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(
        grouped.filter(F.col("node").isNotNull() | (F.col("copies") > 1)).select("fp", "root")
        .join(ids, "root").select("fp", "component_id"), "simhash-groups")
    out = attach(rows, named, "fp", named.count())
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id")), grouped


def _marked(docs: DataFrame, text_col: str, words_per_shingle: int, name: str) -> DataFrame:
    """All rows and columns of ``docs`` with the fingerprint as ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), words_per_shingle) for x in batch.column(text_col)],
                           dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.int64())],
                                             names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per group: of its smallest id, then of its smallest fingerprint.

    Where no id is repeated, an id tells the row; else rows are told apart by
    fingerprint and id. Rows without an id cannot be told apart by it and all stay.
    """
    fp, first_id, gone_id, is_chosen = free_names(docs, "__fp", "__id", "__gone", "__chosen")
    groups, grouped = _grouped(docs, id_col, text_col, words_per_shingle, max_bits)
    groups = materialize(groups.select("doc_id", "component_id"), "simhash-decisions")
    if groups.groupBy("doc_id").count().filter((F.col("count") > 1) & F.col("doc_id").isNotNull()).isEmpty():
        gone = groups.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(gone_id))
        return docs.join(gone, F.col(id_col).cast("long") == F.col(gone_id), "left_anti")
    first = F.min(F.struct(F.col("first_id").isNull().alias("last"), "first_id", "fp")).alias("first")
    chosen = materialize(grouped.groupBy("root").agg(first).select(
        F.col("first.fp").alias(fp), F.col("first.first_id").alias(first_id), F.lit(True).alias(is_chosen)),
        "simhash-chosen")
    marked = _marked(docs.filter(F.col(id_col).isNotNull()), text_col, words_per_shingle, fp)
    found = attach(marked, chosen, fp, chosen.count())
    kept = found.filter(F.col(is_chosen) & (F.col(id_col).cast("long") == F.col(first_id)))
    return kept.dropDuplicates([fp, first_id]).select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))
