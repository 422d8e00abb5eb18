"""Chat formatting of reply trees.

Messages name their parent. Root-to-leaf paths come from iterative self-joins
by pointer doubling: round k knows each message's 2^k-th ancestor with the
score and length of the path to it, so the rounds are the logarithm of the
depth. Leaves are ranked within their tree by the mean score of their path,
the best ``branches`` are chosen, and the rounds played backwards spread each
chosen path into its messages. Each path is formatted as one conversation and
written, in order, as a table of segments (one per turn) that is dealt by
range of (tree, branch, turn), so a very long conversation lies in several
files. The reader streams files: a conversation belongs to the file in which
it starts, and its reader goes on into the files that follow.

Template: ``<|im_start|>role\\n text <|im_end|>\\n`` (no blanks around the
text). Inside roles and texts every ``<``, backslashes, ``|`` gets one more
backslash, so a text never shows a control string; reading back takes it out
again. In roles, line ends and backslashes are escaped as well. The loss mask
covers the texts of ``loss_role``.

Defined results: null roles and texts are empty; null scores are 0; a null
tree is a tree of its own; rows without a message id take no part; of rows
with the same tree and id the smallest (parent, role, text) stays. A message
whose parent is missing is a root. Messages on or below a cycle have no path
to a root and are left out. Ties between branches go to the smaller leaf id.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.warc import open_folder
from cohortlens.session import materialize, scratch_root

START, END = "<|im_start|>", "<|im_end|>"
BUCKET = 4096           # turns that are numbered together
ROWS_PER_FILE = 100_000


# --- template ------------------------------------------------------------------------

def escaped(col: Column) -> Column:
    """The text with one more backslash in every control-like string."""
    return F.regexp_replace(col, r"<(\\*)\|", r"<\\$1|")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(col: Column) -> Column:
    return escaped(F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def segment(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escaped_role(role), F.lit("\n"), escaped(text), F.lit(END + "\n"))


def parse_segment(value: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    role, _, text = value[len(START):-len(END) - 1].partition("\n")
    return unescape_role(role), unescape(text)


# --- messages of a linear log ---------------------------------------------------------

def reply_chain(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """Turns as messages that reply to the turn before: (conv_id, node, parent, role, text, score).

    Turns are numbered by (turn, role, text), null turns first, within
    buckets of turn numbers; the buckets' offsets come from their sizes. So a
    conversation with a third of all turns is numbered in many tasks.
    """
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("bucket", F.coalesce(F.floor(F.col("turn") / BUCKET), F.lit(-(1 << 62))))
    inside = Window.partitionBy("conv_id", "bucket").orderBy("turn", "role", "text")
    before = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(F.col("conv_id").alias("c"), F.col("bucket").alias("b")).count().select(
        "c", "b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    numbered = rows.withColumn("place", F.row_number().over(inside)).join(
        offsets, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("bucket") == F.col("b")))
    node = F.col("offset") + F.col("place") - 1
    return numbered.select("conv_id", node.alias("node"), F.when(node > 0, node - 1).alias("parent"), "role", "text",
                           F.lit(0.0).alias("score"))


# --- paths ------------------------------------------------------------------------------

def _step(df: DataFrame, rows: int, name: str) -> DataFrame:
    return materialize(df.coalesce(max(6, rows // 200_000)), name)


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, branch, leaf, pos, node): the messages of each tree's best paths, pos from the root."""
    nodes = materialize(messages.select("tree", "node", "parent", "score"), "reply-nodes")
    count = nodes.count()
    up = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    state = _step(nodes.join(up, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("p")), "left").select(
        "tree", "node", F.col("p").alias("anc"), F.coalesce("score", F.lit(0.0)).alias("score"),
        F.lit(1).cast("long").alias("depth")), count, "reply-round")
    parents = state.filter(F.col("anc").isNotNull()).select("tree", F.col("anc").alias("node")).distinct()
    jumps = []
    while len(jumps) <= count.bit_length() and not (active := state.filter(F.col("anc").isNotNull())).isEmpty():
        jumps.append(state)
        far = state.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("anc").alias("next"),
                           F.col("score").alias("s"), F.col("depth").alias("d"))
        on = (F.col("tree") == F.col("t")) & (F.col("anc") == F.col("n"))
        longer = active.join(far, on).select("tree", "node", F.col("next").alias("anc"),
                                             (F.col("score") + F.col("s")).alias("score"),
                                             (F.col("depth") + F.col("d")).alias("depth"))
        state = _step(state.filter(F.col("anc").isNull()).union(longer), count, "reply-round")
    leaves = state.filter(F.col("anc").isNull()).join(parents, ["tree", "node"], "left_anti")
    rank = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / F.col("depth")), "node")
    best = leaves.withColumn("branch", F.row_number().over(rank)).filter(F.col("branch") <= branches)
    paths = _step(best.select("tree", "branch", F.col("node").alias("leaf"), (F.col("depth") - 1).alias("pos"), "node",
                              F.col("depth").alias("size")), count, "reply-paths")
    for k in reversed(range(len(jumps))):  # split pieces longer than 2^k at the 2^k-th ancestor
        half = 1 << k
        jump = jumps[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("anc"))
        split = paths.filter(F.col("size") > half).join(
            jump, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n"))).select(
            "tree", "branch", "leaf", (F.col("pos") - half).alias("pos"), F.col("anc").alias("node"),
            (F.col("size") - half).alias("size"))
        paths = _step(paths.withColumn("size", F.least("size", F.lit(half))).union(split), count, "reply-paths")
    return paths.drop("size")


def _one_per_id(messages: DataFrame) -> DataFrame:
    """Rows with ids, one per (tree, id)."""
    fields = ("parent", "role", "text", "score")
    return messages.filter(F.col("node").isNotNull()).groupBy("tree", "node").agg(
        F.min(F.struct(*fields)).alias("m")).select("tree", "node", *(F.col("m")[f].alias(f) for f in fields))


def format_trees(messages: DataFrame, folder: str, branches: int = 1, loss_role: str = "assistant",
                 tree_col: str = "conv_id", id_col: str = "node", parent_col: str = "parent", role_col: str = "role",
                 text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Write the chosen paths below ``folder`` as a table of formatted turns; returns that table.

    Columns: tree_id, branch, pos, segment, loss_start, loss_end (code points
    within the segment, null outside the mask).
    """
    spark = messages.sparkSession
    known = messages.select(
        F.coalesce(F.col(tree_col).cast("long").cast("string"), F.lit("")).alias("tree"),
        F.col(id_col).cast("long").alias("node"), F.col(parent_col).cast("long").alias("parent"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(score_col).cast("double").alias("score"))
    known = materialize(_one_per_id(known), "reply-messages")
    paths = chosen_paths(known, branches)
    turns = paths.join(known.select("tree", "node", "role", "text"), ["tree", "node"])
    head = F.length(F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")))
    masked = F.col("role") == loss_role
    out = turns.select(
        F.when(F.col("tree") != "", F.col("tree").cast("long")).alias("tree_id"), "branch", "pos",
        segment(F.col("role"), F.col("text")).alias("segment"),
        F.when(masked, head).alias("loss_start"),
        F.when(masked, head + F.length(escaped(F.col("text")))).alias("loss_end"))
    files = max(8, known.count() // ROWS_PER_FILE)
    order = ("tree_id", "branch", "pos")
    out.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(folder)
    return spark.read.parquet(folder)


# --- reading back -------------------------------------------------------------------------

def _turns(folder: str, path: str) -> Iterator[dict]:
    """The formatted turns of one file, in order and in small portions."""
    fs, top = open_folder(folder)
    with fs.open_input_file(f"{top}/{path}") as f:
        for batch in pq.ParquetFile(f).iter_batches(batch_size=2000):
            yield from batch.to_pylist()


def read_conversations(formatted: DataFrame, folder: str, fold: type) -> DataFrame:
    """One row per conversation: ``fold`` is made per conversation, gets every
    turn's (segment, loss_start, loss_end) in order by ``add`` and gives the
    row by ``row``; ``fold.SCHEMA`` is its schema after tree_id and branch.

    Only file names, first and last keys and boundaries pass the driver.
    """
    spark = formatted.sparkSession
    key = F.struct(F.col("tree_id").isNotNull().alias("a"), F.coalesce("tree_id", F.lit(0)).alias("b"), "branch")
    edges = formatted.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("path")).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.min_by("pos", F.struct(key, "pos")).alias("first")).collect()
    edges = sorted(edges, key=lambda e: (tuple(e["lo"]), e["first"]))
    work = []
    for i, e in enumerate(edges):
        inside = e["first"] > 0                 # its first conversation starts in an earlier file
        if inside and e["lo"] == e["hi"]:
            continue                            # and goes on beyond it: nothing starts here
        more = []                               # files that go on with its last conversation
        for later in edges[i + 1:]:
            if not later["first"] or later["lo"] != e["hi"]:
                break
            more.append(later["path"])
            if later["lo"] != later["hi"]:
                break
        work.append((e["path"], inside, more))
    schema = f"tree_id long, branch int, {fold.SCHEMA}"
    if not work:
        return spark.createDataFrame([], schema)
    names = [c.strip().split()[0] for c in schema.split(",")]

    def conversations(task: dict) -> Iterator[tuple]:
        at, state = None, None
        for number, path in enumerate([task["path"], *task["more"]]):
            for t in _turns(folder, path):
                here = (t["tree_id"], t["branch"])
                if here != at:
                    if state is not None:
                        yield (*at, *state.row())
                        state = None
                    if number:
                        return                  # what follows belongs to a later file
                    at, state = here, None if at is None and task["inside"] else fold()
                if state is not None:
                    state.add(t["segment"], t["loss_start"], t["loss_end"])
        if state is not None:
            yield (*at, *state.row())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.to_pylist():
                rows = conversations(task)
                while part := [dict(zip(names, r)) for r in islice(rows, 5000)]:
                    yield pa.RecordBatch.from_pylist(part, schema=_arrow(names, fold))

    files = spark.createDataFrame(work, "path string, inside boolean, more array<string>")
    return files.repartition(len(work)).mapInArrow(run, schema)


def _arrow(names: list[str], fold: type) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([("tree_id", pa.int64()), ("branch", pa.int32())] + [
        (n, kinds[c.split()[1]]) for n, c in zip(names[2:], fold.SCHEMA.split(", "))])


class Digest:
    """Turn and loss digests of one conversation, from its formatted turns."""

    SCHEMA = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = 0

    def add(self, value: str, loss_start: int | None, loss_end: int | None) -> None:
        role, text = parse_segment(value)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        self.formatted += len(value)
        if loss_start is not None:
            masked = unescape(value[loss_start:loss_end])
            self.loss.update(masked.encode())
            self.loss_chars += len(masked)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted


def output_folder(spark: SparkSession) -> str:
    """A fresh folder for formatted conversations below the scratch folder of this application."""
    return f"{scratch_root(spark)}/chat-{uuid.uuid4().hex}"
