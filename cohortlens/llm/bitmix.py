"""Language-model scores by online logistic context mixing.

Tokens are lower-cased words plus one end per text. A token has a code
of 12 to 14 bits (5 from its last two bytes, the others from the whole token);
its bits are predicted one by one from three hashed contexts: none, the token before, and
the endings of the two tokens before. Each context slot counts zeros and
ones; the stretched predictions are mixed by weights that a gate picks (bit
position and how often the contexts were seen), and an adaptive probability
map refines the result. Among the tokens of one code a token has the share
(count + 1) / (sum of counts + 1 + 1 for all unseen ones). So the
probabilities of all known tokens and of the unseen class sum to one, and the
score of a text is the log10 of the product over its tokens.

How it runs: texts are dealt to training parts of about ``PART_BYTES`` by a hash of id and
text, sorted by it, and turned into chunks of token codes (written once), so parts and
chunks do not depend on the files or partitions of the input.
Exact corpus counts come from one shuffle of the distinct tokens per chunk
and go back to their chunks. Training reads the chunks of every part
online: it predicts each portion first, then corrects the weights by the
error, and counts the portions block by block. The slot counts of all parts are added, the
weights averaged. Code bits follow the counted distinct tokens, context slots
the counted distinct (context, node) pairs, each up to a largest size, at
which the model still may be broadcast.

Defined results: a null or empty text is the end alone. Repeated rows and
null ids are scored row by row; a null id counts as a text "" for the split. Copies of one
row (same id and text) that alone would fill a part are dealt over all parts, at random with a
fixed seed; only then the score depends slightly on the layout of the input.
Without training tokens every base probability is 1. An empty table gives an
empty result. Other columns are ignored. Tokens are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import slices, token_lists
from cohortlens.session import materialize

DEPTH, MAX_DEPTH = 12, 14       # bits of a token's code, at least and at most
SUFFIX_BITS = 5                 # of which from its last two bytes
NODES = 1 << DEPTH
SLOT_BITS, MAX_SLOT_BITS = 18, 21  # slots of a hashed context, as a power of two
LEVELS = 4                      # how often a context was seen: 0, 1-3, 4-31, more
GATES = DEPTH * LEVELS * LEVELS
INPUTS = 4                      # three contexts and a constant
BINS = 32                       # of the probability map, per bit position
BLOCK = 32_768                  # tokens predicted before they are counted
PORTION = 4_096                 # tokens mixed at a time, before the weights move
SLICE = 1 << 18                 # tokens sorted at a time when scoring
TWO_BITS = 11                   # of the third context: two endings of 0 to 32, the first times 40
CHUNK_BYTES = 8 << 20           # text of one chunk (a longer text is a chunk alone)
PART_BYTES = 32 << 20           # text of one training part, about
ROW_BYTES = 16                  # counted for a row beside its text
RATE = 0.02

_TABLES = ("c0", "c1", "c2")
PIECE = 1 << 14                 # numbers per merged row


def sizes_of(depth: int = DEPTH, bits1: int = SLOT_BITS, bits2: int = SLOT_BITS) -> dict[str, int]:
    """The arrays of a model and their sizes."""
    return {"c0": 2 << depth, "c1": 2 << bits1, "c2": 2 << bits2, "weights": depth * LEVELS * LEVELS * INPUTS,
            "map_ones": depth * BINS, "map_all": depth * BINS, "tokens": 1}


_END = b"\n"                    # not a word, so never equal to one
_CHUNK = ("part int, chunk long, doc_ids array<long>, train array<boolean>, sizes array<long>, bytes array<long>, "
          "codes binary, hashes binary, symbols binary")


# --- training parts ---------------------------------------------------------------------

def deal(rows: DataFrame) -> DataFrame:
    """(doc_id, text, train) with ``part``: one Spark partition a part, sorted by hash.

    The copies of a row that would fill a part alone are few kinds (at most the
    table's bytes / ``PART_BYTES``), so these are broadcast.
    """
    hashed = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    kinds = materialize(hashed.groupBy("h").agg(F.sum(size).alias("size"), F.count(F.lit(1)).alias("n")), "lm-kinds")  # read twice
    parts = max(1, math.ceil((kinds.agg(F.sum("size")).first()[0] or 0) / PART_BYTES))
    hot = kinds.filter((F.col("n") > 1) & (F.col("size") > PART_BYTES)).select("h", F.lit(True).alias("hot"))
    salt = F.when(F.col("hot"), F.floor(F.rand(7) * parts)).otherwise(0)
    dealt = hashed.join(F.broadcast(hot), "h", "left").withColumn(
        "part", F.pmod(F.pmod("h", F.lit(parts)) + salt, F.lit(parts)).cast("int"))
    return dealt.repartitionById(parts, "part").sortWithinPartitions("h").select("part", "doc_id", "text", "train")


# --- chunks of token codes -----------------------------------------------------------

def _symbols(words: pa.Array, hashes: np.ndarray) -> np.ndarray:
    """The code of each distinct token at ``MAX_DEPTH`` bits; a shorter code is its beginning."""
    tails = pc.binary_slice(words.cast(pa.large_binary()), -2).dictionary_encode()
    tail = np.array([xxhash.xxh32_intdigest(t) for t in tails.dictionary.to_pylist()], dtype=np.uint32)
    tail = tail[tails.indices.to_numpy()] if len(tail) else np.zeros(0, np.uint32)
    low = MAX_DEPTH - SUFFIX_BITS
    return ((tail % (1 << SUFFIX_BITS)).astype(np.uint16) << low) | (hashes % np.uint64(1 << low)).astype(np.uint16)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 20
    for batch in slices(batches, "text", CHUNK_BYTES):
        offsets, words = token_lists(batch.column("text"), lower=True)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        end = len(distinct)
        codes = np.insert(coded.indices.to_numpy().astype(np.int32), offsets[1:], end)
        distinct = pa.concat_arrays([distinct.cast(pa.large_binary()), pa.array([_END], pa.large_binary())])
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct.to_numpy(zero_copy_only=False)), np.uint64, len(distinct))
        sizes = np.diff(offsets) + 1
        length = pc.fill_null(pc.binary_length(batch.column("text")), 0)
        yield pa.RecordBatch.from_pylist([{
            "part": batch.column("part")[0].as_py(), "chunk": number, "doc_ids": batch.column("doc_id").to_pylist(),
            "train": batch.column("train").to_pylist(), "sizes": sizes.tolist(), "bytes": length.to_pylist(),
            "codes": pa.compress(codes.astype("<i4").tobytes(), "zstd", asbytes=True), "hashes": hashes.astype("<u8").tobytes(),
            "symbols": _symbols(distinct, hashes).astype("<u2").tobytes()}], schema=_CHUNK_ARROW)
        number += 1


_CHUNK_ARROW = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())),
    ("sizes", pa.list_(pa.int64())), ("bytes", pa.list_(pa.int64())),
    ("codes", pa.binary()), ("hashes", pa.binary()), ("symbols", pa.binary())])


def _plain(row: dict) -> dict:
    """A row of the chunk table with its codes as they were before compression."""
    return {**row, "codes": pa.decompress(row["codes"], 4 * sum(row["sizes"]), "zstd", asbytes=True)}


class _Chunk:
    """One chunk's arrays; codes of ``coded`` bits are shortened to ``depth``."""

    def __init__(self, row: dict, depth: int = DEPTH, coded: int = DEPTH):
        self.depth = depth
        self.number, self.part = row["chunk"], row["part"]
        self.doc_ids, self.train = row["doc_ids"], np.array(row["train"], dtype=bool)
        self.sizes, self.bytes = np.array(row["sizes"], dtype=np.int64), np.array(row["bytes"], dtype=np.int64)
        self.codes = np.frombuffer(row["codes"], "<i4")
        self.hashes = np.frombuffer(row.get("hashes", b""), "<u8")
        self.symbols = np.frombuffer(row["symbols"], "<u2") >> np.uint16(coded - depth)

    def contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token its code's symbol and its two context hashes; a text starts afresh."""
        symbol = self.symbols[self.codes].astype(np.uint32)
        first = np.cumsum(self.sizes) - self.sizes
        before = np.empty_like(symbol)
        before[1:] = symbol[:-1] + 1
        before[first] = 0
        tail = (before + ((1 << (self.depth - SUFFIX_BITS)) - 1)) >> (self.depth - SUFFIX_BITS)
        tail2 = np.empty_like(tail)
        tail2[1:] = tail[:-1]
        tail2[first] = 0
        return symbol, before, tail * 40 + tail2


def _rows(batches: Iterator[pa.RecordBatch], depth: int = MAX_DEPTH) -> Iterator[_Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Chunk(_plain(batch.slice(i, 1).to_pylist()[0]), depth, MAX_DEPTH)


# --- exact counts ---------------------------------------------------------------------

def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, at, n): a chunk's distinct tokens; ``at`` is chunk and slot, ``n`` training count and code."""
    for c in _rows(batches):
        counted = np.bincount(c.codes[np.repeat(c.train, c.sizes)], minlength=len(c.hashes))
        slot = np.arange(len(c.hashes), dtype=np.int64)
        for i in range(0, len(slot), 100_000):
            s = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([
                pa.array(c.hashes[s].view(np.int64)), pa.array(np.full(len(slot[s]), c.number)),
                pa.array(slot[s].astype(np.int32)), pa.array((counted[s] << MAX_DEPTH) + c.symbols[s])],
                names=["hash", "chunk", "slot", "n"])


def corpus_counts(chunks: DataFrame) -> DataFrame:
    """(chunk, slot, c, symbol): the corpus count of every chunk's distinct tokens;
    symbol is set on one row per token and null on its others."""
    found = chunks.mapInArrow(_distinct, "hash long, chunk long, slot int, n long")
    same = Window.partitionBy("hash").orderBy("chunk")  # one order for both, so one sort
    total = F.sum(F.shiftright("n", MAX_DEPTH)).over(same.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    first = F.row_number().over(same) == 1
    return found.select("chunk", "slot", total.alias("c"),
                        F.when(first, F.col("n").bitwiseAND(F.lit((1 << MAX_DEPTH) - 1))).cast("int").alias("symbol"))


def _pairs(depth: int, enough: int | None = None):
    """Distinct (context, node) pairs of each part's training tokens, a column per context.

    A context that has more than ``enough`` pairs in a part alone is counted no further there: it gets one row
    that says so (``many_one``, ``many_two``) in place of its pairs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunks in groupby(_rows(batches, depth), key=lambda c: c.part):
            begins = [np.zeros(0, np.uint32)] * 2  # 2 * MAX_DEPTH + 1 bits at most
            many = [False, False]
            for c in chunks:
                if all(many):
                    continue
                use = np.repeat(c.train, c.sizes)
                symbol, *contexts = (a[use] for a in c.contexts())
                for i, context in enumerate(contexts):
                    context <<= np.uint32(depth)
                    context |= symbol
                    begins[i] = _once(np.concatenate((begins[i], _once(context))))
                    many[i] = enough is not None and len(begins[i]) > enough  # those of the last bit alone
                del use, symbol, contexts, context
            del c
            if any(many):
                yield _pair_rows([np.zeros(0, np.int64)] * 2, many)
                begins = [begin[:0] if m else begin for begin, m in zip(begins, many)]
            for d in reversed(range(depth)):  # sorted, so equal beginnings are neighbours
                for i in range(2):
                    begins[i] >>= np.uint32(1)
                    begins[i] = _neighbours_once(begins[i])
                for i in range(0, max(map(len, begins)), 100_000):
                    yield _pair_rows([_pair(begin[i:i + 100_000].astype(np.int64), d, depth) for begin in begins])

    return run


def _pair_rows(pairs: list[np.ndarray], many: list[bool] | None = None) -> pa.RecordBatch:
    rows = max(1 if many else 0, *map(len, pairs))
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays([pa.array(both), pa.nulls(rows - len(both), pa.int64())]) for both in pairs]
        + [pa.array([m] * rows) for m in many or (False, False)], names=["one", "two", "many_one", "many_two"])


def _pair(begin: np.ndarray, d: int, depth: int) -> np.ndarray:
    """Context and node of a context with the first ``d`` bits of a code behind it."""
    return ((begin >> d) << depth) | (1 << d) | (begin & ((1 << d) - 1))


def _once(keys: np.ndarray) -> np.ndarray:
    """The distinct keys, sorted; sorts ``keys`` in place, which takes no memory beside it."""
    keys.sort()
    return _neighbours_once(keys)


def _neighbours_once(keys: np.ndarray) -> np.ndarray:
    return keys[np.concatenate((keys[:1] == keys[:1], keys[1:] != keys[:-1]))]


def model_shape(chunks: DataFrame, distinct: int) -> tuple[int, int, int]:
    """Code bits for so many distinct tokens, and slot bits for twice the counted (context, node) pairs."""
    depth = min(MAX_DEPTH, max(DEPTH, math.ceil(math.log2(max(1, distinct)))))
    enough = 1 << (MAX_SLOT_BITS - 2)   # more than these need the largest size, however many they are
    found = chunks.mapInArrow(_pairs(depth, enough), "one long, two long, many_one boolean, many_two boolean").agg(*[
        f(c).alias(c) for c, f in (("one", F.approx_count_distinct), ("two", F.approx_count_distinct),
                                   ("many_one", F.bool_or), ("many_two", F.bool_or))]).first()
    return depth, *(MAX_SLOT_BITS if found[f"many_{c}"] else min(MAX_SLOT_BITS, max(SLOT_BITS, math.ceil(
        math.log2(max(1, 2 * found[c]))))) for c in ("one", "two"))


# --- the mixer --------------------------------------------------------------------------

_PRIOR = np.float32(0.4)


def _stretch(zeros, ones):
    return np.log((ones + _PRIOR) / (zeros + _PRIOR))


def _level(seen: np.ndarray) -> np.ndarray:
    return (seen > 0).astype(np.int8) + (seen > 3) + (seen > 31)


def new_state(*shape: int) -> dict[str, np.ndarray]:
    state = {k: np.zeros(n, dtype=np.float64 if k == "weights" else np.float32) for k, n in sizes_of(*shape).items()}
    state["weights"].reshape(-1, INPUTS)[:] = (0.6, 0.2, 0.2, 0.0)
    state["map_all"] += 4.0
    centre = 1 / (1 + np.exp(-(np.arange(BINS) - BINS / 2 + 0.5) / 2))
    state["map_ones"] += np.tile(4 * centre, len(state["map_all"]) // BINS).astype(np.float32)
    return state


def _shape(state: dict[str, np.ndarray], per_slot: int) -> tuple[int, int, int]:
    """Code bits and slot bits of a model with so many numbers per slot."""
    return tuple((len(state[k]) // per_slot).bit_length() - 1 for k in _TABLES)


def _slots(node, one, two, shape):
    """The slot of each context for nodes of the code tree (32-bit arithmetic)."""
    mixed = node * np.uint32(0x9E3779B1)
    h1 = ((one * np.uint32(0x85EBCA6B) + mixed) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - shape[1])
    h2 = ((two * np.uint32(0x27D4EB2F) + mixed) * np.uint32(0x165667B1)) >> np.uint32(32 - shape[2])
    return node.astype(np.int64), h1.astype(np.int64), h2.astype(np.int64)


_BASE_GATE = (np.arange(MAX_DEPTH, dtype=np.int64) * LEVELS * LEVELS)[:, None]
_BASE_BIN = (np.arange(MAX_DEPTH, dtype=np.int64) * BINS)[:, None]


def _mix(weights, xs, level1, level2, base):
    """Mixed stretch and gate of bits, whose position's first gate is ``base`` (32-bit arithmetic)."""
    gate = base + (level1 * np.int8(LEVELS) + level2)
    dot = weights[3].take(gate)
    for w, x in zip(weights, xs):
        dot += w.take(gate) * x
    return gate, dot


def _squash(dot: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-dot))


def _bins(dot: np.ndarray, base) -> np.ndarray:
    return base + np.clip(dot * 2 + np.float32(BINS / 2), 0, BINS - 1).astype(np.int64)


def learn(state: dict[str, np.ndarray], chunk: _Chunk, seen: np.ndarray) -> None:
    """One online pass over a chunk's training tokens; ``seen`` sums squared gradients."""
    use = np.repeat(chunk.train, chunk.sizes)
    symbol, one, two = (a[use] for a in chunk.contexts())
    shape, weights = _shape(state, 2), state["weights"].reshape(-1, INPUTS)
    d = np.arange(shape[0], dtype=np.uint32)[:, None]
    for i in range(0, len(symbol), BLOCK):
        used: list[list[np.ndarray]] = [[], []]
        unhashed = np.zeros(len(state["c0"]), np.int64)
        stretched = _stretch(state["c0"][0::2], state["c0"][1::2])    # a small table: once a block
        for j in range(i, min(i + BLOCK, len(symbol)), PORTION):
            p = slice(j, min(j + PORTION, i + BLOCK))
            node = (np.uint32(1) << d) | (symbol[p] >> (shape[0] - d))
            bit = ((symbol[p] >> (shape[0] - 1 - d)) & np.uint32(1)).astype(np.int64)
            slots = _slots(node, one[p], two[p], shape)
            counts = [state[k].view(np.complex64).take(s) for k, s in zip(_TABLES[1:], slots[1:])]  # zeros and ones at once
            xs = [stretched.take(slots[0]), *(_stretch(c.real, c.imag) for c in counts)]
            gate, dot = _mix(weights.T.astype(np.float32), xs, *(_level(c.real + c.imag) for c in counts), _BASE_GATE[:shape[0]])
            place, flat = _bins(dot, _BASE_BIN[:shape[0]]).ravel(), gate.ravel()
            error = bit.astype(np.float32) - _squash(dot)
            for n, x in enumerate((*xs, None)):
                gain = error if x is None else error * x
                slope = np.bincount(flat, weights=gain.ravel(), minlength=len(weights))
                seen[:, n] += slope * slope
                weights[:, n] += RATE * slope / np.sqrt(seen[:, n] + 1e-6)
            seen_bits = np.bincount(2 * place + bit.ravel(), minlength=2 * len(state["map_all"])).reshape(-1, 2)
            state["map_ones"] += seen_bits[:, 1]
            state["map_all"] += seen_bits.sum(axis=1)
            unhashed += np.bincount((2 * slots[0] + bit).ravel(), minlength=len(unhashed))
            for list_, s in zip(used, slots[1:]):
                list_.append((2 * s + bit).ravel())
        state["c0"] += unhashed.astype(np.float32)
        for k, list_ in zip(_TABLES[1:], used):
            for places in list_:
                np.add.at(state[k], places, np.float32(1))
    state["tokens"] += len(symbol)


_PARTS = "part long, places binary, small binary, large binary"
_PARTS_ARROW = pa.schema([("part", pa.int64()), ("places", pa.binary()), ("small", pa.binary()), ("large", pa.binary())])


def _part(part: int, numbers: np.ndarray) -> pa.RecordBatch:
    """A row of the numbers that are not 0: a bit a place, a byte for each count below 256 (0: the next of ``large``)."""
    used = numbers != 0
    values = numbers[used].astype("<f8")
    fits = (values > 0) & (values < 256) & (values % 1 == 0)
    return pa.RecordBatch.from_pylist([{
        "part": part, "places": np.packbits(used).tobytes(), "small": np.where(fits, values, 0).astype(np.uint8).tobytes(),
        "large": values[~fits].tobytes()}], schema=_PARTS_ARROW)


def _numbers(row) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of such a row."""
    values = np.frombuffer(row["small"], np.uint8).astype(np.float64)
    values[values == 0] = np.frombuffer(row["large"], "<f8")
    return np.flatnonzero(np.unpackbits(np.frombuffer(row["places"], np.uint8))), values


def _train(shape: tuple[int, int, int]):
    """Each part's counts and weighted weights as rows of ``PIECE`` numbers.

    A task may read several parts, whose chunks follow each other; each starts afresh.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunks in groupby(_rows(batches, shape[0]), key=lambda c: c.part):
            state = new_state(*shape)
            seen = np.zeros((len(state["weights"]) // INPUTS, INPUTS))
            for chunk in chunks:
                learn(state, chunk, seen)
            if not state["tokens"][0]:
                continue
            state["weights"] = state["weights"] * state["tokens"][0]
            for number, numbers in enumerate(state.values()):
                for i in range(0, len(numbers), PIECE):
                    if numbers[i:i + PIECE].any():
                        yield _part((number << 32) + i, numbers[i:i + PIECE])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of each part; the rows come sorted by part and are added one by one."""
    part, total = None, np.zeros(PIECE)
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                if part is not None:
                    yield _part(part, total)
                part, total = row["part"], np.zeros(PIECE)
            places, numbers = _numbers(row)
            total[places] += numbers
    if part is not None:
        yield _part(part, total)


def train(chunks: DataFrame, shape: tuple[int, int, int]) -> dict[str, np.ndarray]:
    """The model of all parts: summed counts, token-weighted mean weights (sizes of ``shape``)."""
    parts = chunks.mapInArrow(_train(shape), _PARTS).repartition("part").sortWithinPartitions("part").mapInArrow(
        _add, _PARTS)
    total = {k: np.zeros(n) for k, n in sizes_of(*shape).items()}
    names = list(total)
    for row in parts.toLocalIterator():
        name, i = names[row["part"] >> 32], row["part"] & 0xFFFFFFFF
        places, numbers = _numbers(row)
        total[name][i + places] = numbers
    if not total["tokens"][0]:
        return _frozen(new_state(*shape))
    total["weights"] /= total["tokens"][0]
    return _frozen(total)


def _frozen(state: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """What scoring looks up: stretched predictions, levels, weights, map."""
    out = {"weights": np.ascontiguousarray(state["weights"].reshape(-1, INPUTS).T.astype(np.float32)),
           "map": ((state["map_ones"] + 0.5) / (state["map_all"] + 1)).astype(np.float32)}
    for k in _TABLES:
        zeros, ones = state[k][0::2], state[k][1::2]
        out[k] = _stretch(zeros, ones).astype(np.float32)
        out[k + "_level"] = _level(zeros + ones).astype(np.int8)
    return out


def code_log10(model: dict[str, np.ndarray], chunk: _Chunk) -> np.ndarray:
    """log10 probability of every token's code given its contexts."""
    symbol, one, two = chunk.contexts()
    out = np.empty(len(symbol))
    for i in range(0, len(symbol), SLICE):
        s = slice(i, i + SLICE)
        out[s] = _sorted_log10(model, symbol[s], one[s], two[s])
    return out


def _sorted_log10(model: dict[str, np.ndarray], symbol: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Sorted by contexts and code, tokens with the same contexts and beginning are neighbours: each such bit is
    predicted once."""
    shape, n = _shape(model, 1), len(symbol)
    depth, place_bits = shape[0], np.uint64(SLICE.bit_length() - 1)
    key = ((one.astype(np.uint64) << np.uint64(TWO_BITS) | two) << np.uint64(depth) | symbol) << place_bits
    key |= np.arange(n, dtype=np.uint64)
    key.sort()
    at = (key & np.uint64(SLICE - 1)).astype(np.int64)
    key >>= place_bits
    # from the first bit in which a key differs from the one before; contexts come before the code
    differs = np.minimum(key[1:] ^ key[:-1], np.uint64(1 << depth)).astype(np.uint16)
    total = np.zeros(n)
    for d in range(depth):
        first = np.concatenate(([0], np.flatnonzero(differs >= np.uint16(1 << (depth - 1 - d))) + 1))
        begin = key[first] >> np.uint64(depth - 1 - d)
        each = np.empty(len(begin), np.float32)
        for i in range(0, len(begin), PIECE):
            each[i:i + PIECE] = _bit_log10(model, begin[i:i + PIECE], d, shape)
        total += np.repeat(each, np.diff(first, append=n))
    out = np.empty(n)
    out[at] = total
    return out


def _bit_log10(model: dict[str, np.ndarray], begin: np.ndarray, d: int, shape: tuple[int, int, int]) -> np.ndarray:
    """log10 probability of the bit at position ``d``, the last of ``begin``, given those before it and both contexts."""
    bit, begin = (begin & np.uint64(1)).astype(bool), begin >> np.uint64(1)
    node = np.uint32(1 << d) | begin.astype(np.uint32) & np.uint32((1 << d) - 1)
    two = (begin >> np.uint64(d)).astype(np.uint32) & np.uint32((1 << TWO_BITS) - 1)
    one = (begin >> np.uint64(d + TWO_BITS)).astype(np.uint32)
    slots = _slots(node, one, two, shape)
    xs = [model[k].take(s) for k, s in zip(_TABLES, slots)]
    _, dot = _mix(model["weights"], xs, model["c1_level"].take(slots[1]), model["c2_level"].take(slots[2]), _BASE_GATE[d])
    p = np.clip((_squash(dot) + model["map"].take(_bins(dot, _BASE_BIN[d]))) / 2, 1e-6, 1 - 1e-6)
    return np.log10(np.where(bit, p, 1 - p))


# --- scores -------------------------------------------------------------------------------

_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
           "score double, bits_per_byte double")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7,
          fold: int = 2) -> DataFrame:
    """Base and model score of every text; texts with crc32(id as text) mod ``folds`` equal
    to ``fold`` are held out of all counts and of training."""
    spark = docs.sparkSession
    fold_of = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         (fold_of != fold).alias("train"))
    chunks = materialize(deal(picked).mapInArrow(_chunks, _CHUNK), "lm-chunks")
    counts = materialize(corpus_counts(chunks), "lm-counts")
    known = counts.filter(F.col("symbol").isNotNull() & (F.col("c") > 0)).groupBy("symbol").agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()  # at most 2^MAX_DEPTH rows
    tokens, distinct = sum(r["c"] for r in known), sum(r["v"] for r in known)
    shape = model_shape(chunks, distinct)
    room = np.ones(1 << shape[0])
    for r in known:
        room[r["symbol"] >> (MAX_DEPTH - shape[0])] += r["c"] + r["v"]
    shared = spark.sparkContext.broadcast({"model": train(chunks, shape), "room": np.log10(room)})
    base = math.log10(tokens + distinct + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk(_plain(left.to_pylist()[0]), shape[0], MAX_DEPTH)
        order = np.argsort(right.column("slot").to_numpy(), kind="stable")
        c = right.column("c").to_numpy()[order]
        more = np.log10(c + 1.0)
        of_code = more - shared.value["room"][chunk.symbols]
        model_log = code_log10(shared.value["model"], chunk) + of_code[chunk.codes]
        first = np.cumsum(chunk.sizes) - chunk.sizes

        def per_doc(values):
            return np.add.reduceat(values, first) if len(first) else values

        scores = per_doc(model_log)
        n = len(chunk.doc_ids)
        return pa.table([
            pa.array(chunk.doc_ids, pa.int64()), pa.array(~chunk.train), pa.array(chunk.sizes),
            pa.array(per_doc((c > 0)[chunk.codes].astype(np.int64))), pa.array(np.full(n, tokens, dtype=np.int64)),
            pa.array(per_doc(more[chunk.codes]) - base * chunk.sizes), pa.array(scores),
            pa.array(-scores / math.log10(2) / np.maximum(1, chunk.bytes))],
            names=[x.split()[0] for x in _SCORES.split(", ")])

    return chunks.drop("hashes").groupBy("chunk").cogroup(counts.select("chunk", "slot", "c").groupBy("chunk")).applyInArrow(
        run, _SCORES)
