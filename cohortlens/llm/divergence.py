"""Source divergence audit: how far apart the term distributions of sources are.

Each language keeps the terms that stand in at least ``min_docs`` of its
documents. A source gives a kept term the smoothed share
``1 + floor(scale * (count + smooth) / (N + smooth * V))`` (N: its occurrences
of kept terms, V: kept terms of the language), and so does the whole
language. Two sources are as far apart as the sum of the absolute
differences over all kept terms; a source's own terms are those with a
larger share than in the language. All arithmetic is exact.

1. Every task indexes its documents in one pass: a block of postings
   (language, source, term -> occurrences, documents) grows in memory until
   it holds ``BLOCK_POSTINGS``, then it is spilled as a run sorted by term, cut
   by hash shard into pieces of ``PIECE_POSTINGS``.
2. A shard's task heap-merges the sorted pieces of all runs into
   frequencies. Pieces arrive in the order of their first term, so only those
   that overlap the current term are open. A posting's shard is the hash of
   its whole key, so a frequent term or a large source is spread out.
3. Pair distances start from the distance of the two floors (the shares of
   an absent term) times V. The kept frequencies then stream corrections:
   tasks hold the shares of a bounded set of terms and two bounded blocks of
   sources, and add ``|p - q| - |floor p - floor q|`` for the terms that occur.

Defined results: a null text, language or source is read as empty. Rows are
documents, repeated ones too. Whole texts are indexed, a very long one by
itself. Every occurring (language, source) has its rows,
also without terms; a language with one source has no pairs, and one without
kept terms has distance 0 and no terms. Ties go to the smaller item in UTF-8
order. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import BROADCAST_ROWS, slices, token_lists
from cohortlens.session import materialize

MIN_DOCS = 30
SMOOTH = 5
SCALE = 10**9
TOP_TERMS = 50

BLOCK_POSTINGS = 400_000    # postings of a block in memory, about 40 MB (several times that while it is sorted)
PIECE_POSTINGS = 4096       # postings of a spilled piece
MERGE_POSTINGS = 100_000    # postings that are added up together
SLICE = 4 << 20             # bytes of whole texts that are indexed together
SOURCE_BLOCK = 128          # sources of a block in the pair sums
TERM_BLOCK = 4096           # terms whose shares a task holds
LEAST_TERM_BLOCK = 256      # fewer terms together for smaller tables, so that all cores work
LEAST_GROUPS = 32

#: bytes of terms: letters (A-Z lower-cased) and whatever is not ASCII; the rest separates
_TERM_BYTES = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)],
                       dtype=np.uint8)


# --- 1: blocks of postings, spilled as sorted runs ------------------------------------

class _Block:
    """Postings in memory: (term, group, occurrences, documents); a group is a (language, source)."""

    def __init__(self):
        self.groups: dict[tuple[bytes, bytes], int] = {}
        self.tables: list[pa.Table] = []
        self.size = 0

    def add(self, langs: pa.Array, sources: pa.Array, texts: pa.Array) -> None:
        """Index some whole documents."""
        offsets, words = token_lists(_letters(texts))
        coded = words.dictionary_encode()
        group = np.array([self.groups.setdefault(g, len(self.groups))
                          for g in zip(langs.to_pylist(), sources.to_pylist())], dtype=np.int64)
        n, terms = len(group), max(1, len(coded.dictionary))
        doc = np.repeat(np.arange(n), np.diff(offsets))
        # one sort by (group, term, document): runs of equal values are counted, runs of equal (group, term) summed
        key = np.sort((group[doc] * terms + coded.indices.to_numpy()) * n + doc)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times, posting = np.diff(np.append(first, len(key))), key[first] // max(1, n)
        start = np.flatnonzero(np.diff(posting, prepend=-1))
        if not len(start):
            return
        self.tables.append(pa.table({
            "term": coded.dictionary.cast(pa.binary()).take(pa.array(posting[start] % terms)),
            "group": pa.array(posting[start] // terms), "n": pa.array(np.add.reduceat(times, start)),
            "docs": pa.array(np.diff(np.append(start, len(posting))))}))
        self.size += len(start)

    def full(self, limit: int) -> bool:
        """Whether the postings fill the block even when equal ones are added up."""
        if self.size < limit:
            return False
        self.tables = [_summed(pa.concat_tables(self.tables), ["term", "group"])]
        self.size = self.tables[0].num_rows
        return self.size >= limit // 2

    def run(self, shards: int) -> Iterator[pa.RecordBatch]:
        """The postings sorted by term, cut into pieces per shard."""
        if not self.size:
            return
        postings = _summed(pa.concat_tables(self.tables), ["term", "group"])
        names = sorted(self.groups)
        rank = np.empty(len(names), dtype=np.int64)     # of each group number among the sorted names
        rank[[self.groups[g] for g in names]] = np.arange(len(names))
        postings = postings.set_column(1, "group", pa.array(rank[postings["group"].to_numpy()]))
        postings = postings.take(pc.sort_indices(postings, [("term", "ascending"), ("group", "ascending")]))
        group, coded = postings["group"].to_numpy(), postings["term"].combine_chunks().dictionary_encode()
        of_term = np.array([crc32(t) for t in coded.dictionary.to_pylist()], dtype=np.uint64)
        of_group = np.array([crc32(source, crc32(lang)) for lang, source in names], dtype=np.uint64)
        mixed = of_term[coded.indices.to_numpy()] * np.uint64(2654435761) + of_group[group] * np.uint64(40503)
        shard = ((mixed >> np.uint64(16)) % np.uint64(shards)).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        shard, postings = shard[order], postings.take(pa.array(order)).combine_chunks()
        group = pa.array(group[order])
        edges = [0]
        for end in [*(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(order)]:
            edges += range(edges[-1] + PIECE_POSTINGS, end, PIECE_POSTINGS)
            edges.append(end)
        starts, ends = pa.array(edges[:-1]), pa.array(edges[1:])
        term = postings["term"].combine_chunks()
        columns = [term, pa.array([g[0] for g in names], pa.binary()).take(group),
                   pa.array([g[1] for g in names], pa.binary()).take(group),
                   postings["n"].combine_chunks(), postings["docs"].combine_chunks()]
        offsets = pa.array(edges, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard[edges[:-1]]), term.take(starts), term.take(pc.subtract(ends, 1)),
             *(pa.ListArray.from_arrays(offsets, c) for c in columns)], names=["shard", "first", "last", *_POSTING])


_POSTING = {"term": pa.binary(), "lang": pa.binary(), "source": pa.binary(), "n": pa.int64(), "docs": pa.int64()}
_RUN = ("shard int, first binary, last binary, term array<binary>, lang array<binary>, source array<binary>, "
        "n array<long>, docs array<long>")


def _letters(texts: pa.Array) -> pa.Array:
    """The texts with every byte that is in no term as a space, and A-Z lower-cased."""
    texts = pa.concat_arrays([texts]).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return pa.array([""] * len(texts), pa.large_string())
    data = _TERM_BYTES[np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]]
    return pa.Array.from_buffers(pa.large_string(), len(texts), [
        None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(data)])


def _summed(postings: pa.Table, keys: list[str]) -> pa.Table:
    """Postings of equal keys added up."""
    sums = postings.group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.rename_columns([c.removesuffix("_sum") for c in sums.column_names]).select([*keys, "n", "docs"])


def _index(shards: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in slices(batches, "text", SLICE):
            block.add(batch.column("lang"), batch.column("source"), batch.column("text"))
            if block.full(limit):
                yield from block.run(shards)
                block = _Block()
                pa.default_memory_pool().release_unused()
        yield from block.run(shards)
        block = None
        pa.default_memory_pool().release_unused()   # a waiting worker keeps no memory of this task
    return run


# --- 2: heap merge of the runs of a shard -----------------------------------------------

def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequencies of each (term, language, source); pieces come ordered by first term.

    A heap holds the open pieces by last term. Those that end before the next
    piece starts are popped; when they hold ``MERGE_POSTINGS``, all open postings
    before that start are complete, and are added up and returned together.
    """
    heap: list[tuple[bytes, int]] = []      # (last term, postings) of the open pieces
    opened: list[pa.Table] = []
    ended = 0

    def complete(before: bytes | None) -> Iterator[pa.RecordBatch]:
        nonlocal opened
        postings = pa.concat_tables(opened)
        opened = []
        if before is not None:
            done = pc.less(postings["term"], pa.scalar(before, pa.binary()))
            opened, postings = [postings.filter(pc.invert(done))], postings.filter(done)
        yield from _summed(postings, ["term", "lang", "source"]).to_batches()

    for batch in batches:
        firsts, lasts = batch.column("first").to_pylist(), batch.column("last").to_pylist()
        edges, taken = batch.column("term").offsets.to_numpy(), 0
        flat = pa.table({c: batch.column(c).flatten() for c in _POSTING})
        for i, (first, last) in enumerate(zip(firsts, lasts)):
            while heap and heap[0][0] < first:
                ended += heapq.heappop(heap)[1]
            if ended >= MERGE_POSTINGS:
                opened.append(flat.slice(edges[taken] - edges[0], edges[i] - edges[taken]))
                yield from complete(first)
                taken, ended = i, 0
            heapq.heappush(heap, (last, int(edges[i + 1] - edges[i])))
        opened.append(flat.slice(edges[taken] - edges[0]))
    if opened:
        yield from complete(None)
    pa.default_memory_pool().release_unused()


def frequencies(docs: DataFrame, block_postings: int = BLOCK_POSTINGS, shards: int | None = None) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of
    every source, from (lang, source, text) without nulls."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(*(F.col(c).cast("binary").alias(c) for c in ("lang", "source", "text")))
    runs = rows.mapInArrow(_index(shards, block_postings), _RUN)
    merged = (runs.repartitionById(shards, F.col("shard")).sortWithinPartitions("first")
              .mapInArrow(_merge, "term binary, lang binary, source binary, n long, docs long"))
    return merged.select(*(F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")), "n", "docs")


# --- 3: shares, terms and pairs ----------------------------------------------------------

def _share(count: str, total: str, scale: int, smooth: int) -> Column:
    """1 + floor(scale * (count + smooth) / (total + smooth * v)), exactly."""
    return F.expr(f"1L + (CAST({scale} AS DECIMAL(10, 0)) * CAST({count} + {smooth} AS DECIMAL(20, 0))) "
                  f"div CAST({total} + {smooth} * v AS DECIMAL(20, 0))")


def _corrections(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """What the occurring terms add to the distance of the floors, for two blocks of sources.

    left: shares (block, source, term, p) of a set of terms; right: all sources of
    both blocks (lang, block, source, floor, low_block, high_block).
    """
    low, high = right["low_block"].iloc[0], right["high_block"].iloc[0]
    sides = []
    terms = pd.unique(left["term"])
    place = pd.Index(terms)
    for block in (low, high):
        members = right[right["block"] == block].drop_duplicates("source").sort_values("source")
        part = left[left["block"] == block]
        sides.append((members["source"].to_numpy(), members["floor"].to_numpy(np.int64),
                      place.get_indexer(part["term"]), pd.Index(members["source"]).get_indexer(part["source"]),
                      part["p"].to_numpy(np.int64)))
    added = np.zeros((len(sides[0][0]), len(sides[1][0])), dtype=np.int64)
    floors = np.abs(sides[0][1][:, None] - sides[1][1][None, :])
    for at in range(0, len(terms), 512):
        width = min(512, len(terms) - at)
        shares = []
        for names, floor, row, column, p in sides:
            dense = np.repeat(floor[:, None], width, axis=1)
            mine = (row >= at) & (row < at + width)
            dense[column[mine], row[mine] - at] = p[mine]
            shares.append(dense)
        for i in range(len(added)):
            added[i] += np.abs(shares[1] - shares[0][i]).sum(axis=1)
        added -= width * floors
    i, j = np.nonzero(np.ones_like(added)) if low != high else np.triu_indices(len(added), 1)
    return pd.DataFrame({"lang": right["lang"].iloc[0], "one": sides[0][0][i], "other": sides[1][0][j],
                         "floors": floors[i, j], "added": added[i, j]})


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               min_docs: int = MIN_DOCS, smooth: int = SMOOTH, scale: int = SCALE, top_terms: int = TOP_TERMS,
               block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source: part ``pair`` has its
    distance to each other source, part ``term`` its own terms."""
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counted = materialize(frequencies(plain, block_postings), "divergence-frequencies")
    terms = counted.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).filter(
        F.col("docs") >= min_docs).drop("docs")
    kept = materialize(counted.drop("docs").join(terms, ["lang", "term"]), "divergence-kept")

    # one row per source: its and its language's sums, and how the pair sums are dealt
    langs = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("n").alias("n_lang"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_source"))
    groups = plain.select("lang", "source").distinct()
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SOURCE_BLOCK).cast("int").alias("blocks"))
    spread = F.least(F.ceil(F.col("v") / LEAST_TERM_BLOCK), F.ceil(LEAST_GROUPS / (F.col("blocks") * F.col("blocks"))))
    sources = materialize(
        groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").join(blocks, "lang").na.fill(0)
        .withColumn("floor", F.when(F.col("v") > 0, _share("0L", "n_source", scale, smooth)).otherwise(F.lit(0)))
        .withColumn("block", F.pmod(F.xxhash64("source"), "blocks").cast("int"))
        .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("v") / TERM_BLOCK), spread).cast("int")),
        "divergence-sources")
    known = sources if sources.count() > BROADCAST_ROWS else F.broadcast(sources)  # beyond: AQE splits hot sources
    shares = kept.join(known, ["lang", "source"]).withColumn("p", _share("n", "n_source", scale, smooth))

    more = shares.withColumn("value", F.col("p") - _share("total", "n_lang", scale, smooth)).filter("value > 0")
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = more.select("lang", "source", F.col("term").alias("item"), "value").withColumn(
        "rank", F.row_number().over(first)).filter(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))

    def dealt(rows: DataFrame) -> DataFrame:
        """Rows of a source for each block that its own block is paired with."""
        return rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
            {"low_block": F.least("block", "with"), "high_block": F.greatest("block", "with")})

    keys = ["lang", "low_block", "high_block", "set"]
    left = dealt(shares.withColumn("set", F.pmod(F.xxhash64("term"), "parts").cast("int"))).select(
        *keys, "block", "source", "term", "p")
    members = sources.select(*(F.col(c).alias(c) for c in sources.columns))  # own column ids beside ``left``
    right = dealt(members.withColumn("set", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))).select(
        *keys, "block", "source", "floor")
    added = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _corrections, "lang string, one string, other string, floors long, added long")
    apart = added.groupBy("lang", "one", "other").agg(F.max("floors").alias("floors"), F.sum("added").alias("added"))
    size = langs.select("lang", "v")
    apart = apart.join(size, "lang", "left").withColumn(
        "value", F.coalesce("v", F.lit(0)) * F.col("floors") + F.col("added"))
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
                             F.struct(F.col("other").alias("source"), F.col("one").alias("item"))))
    pairs = apart.select("lang", "value", both.alias("p")).select("lang", "p.*", "value").withColumn(
        "rank", F.row_number().over(first)).withColumn("part", F.lit("pair"))
    return pairs.unionByName(own).select(
        "lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
