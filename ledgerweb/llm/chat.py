"""Reply trees to formatted conversations.

A tree's messages point at their parents.  Iterative self-joins enumerate the root-to-leaf
paths: round by round every message learns its ancestor twice as far up, its distance to the
root and the sum of the scores on the way, so a path of n messages takes log2(n) joins and only
ids are carried.  A tree's leaves are ranked by the mean score of their path; the best ones are
chosen and their paths are laid out by the same jump tables.

Each message is formatted by itself and turns are numbered by ranges, so a conversation that holds
a third of all rows is numbered and formatted by many tasks.  A conversation is the joined text of
its turns; it is read back by a parser that takes that text in pieces cut anywhere and knows
nothing of rows.  Its digests are sequential, so that one conversation streams in order through
one task, which keeps digests, counters and one turn and never the conversation.

Template: ``### role:\\n text </turn>\\n``.  Within role and text a backslash goes before every
backslash, ``### `` and ``</turn>`` (in a role also before colon and line feed), so a control
string without a backslash before it is always the template's and reading back is exact.  The
loss mask covers the texts of the assistant's turns.

Defined results
* null text or role: empty; null scores: 0
* equal mean scores: the longer path, then the smaller leaf id
* a message whose parent is missing is a root; messages that only reach each other in a circle
  are on no path
* repeated ids of one tree: joined as they are; the callers number rows, so theirs are unique
* repeated rows: turns of their own, one after the other
* a very long text is one turn, whole; columns beside those named are not looked at
* empty table: no rows
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, partitions, release, small_batches

LEARNED_ROLE = "assistant"
HEAD, END = "### ", "</turn>"

_escape_text = r"(\\|### |</turn>)"
_escape_role = r"(\\|### |</turn>|:|\n)"
_unescape = re.compile(r"\\(.)", re.S)


def jump_tables(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``nodes(tree, node, parent, score)``: tables of the ancestor 1, 2, 4, ... steps up, and for
    every message that reaches a root its depth (a root's is 1) and the sum of scores down to it."""
    ids = nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    there = ids.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    state = ids.join(there, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("depth"), "score")
    state = cut(state, "jump")
    count, tables, ended = state.count(), [], None
    while True:
        # only messages that still climb are joined again, with all they may meet
        climbing, top = state.where("up is not null"), state.where("up is null")
        ended = top if ended is None else ended.unionByName(top)
        # a table as long as all nodes is a circle that never ends
        if climbing.isEmpty() or 1 << len(tables) > 2 * count:
            break
        tables.append(climbing.select("tree", "node", "up"))
        above = ended.unionByName(climbing).select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("score").alias("s2"))
        state = climbing.join(above, ["tree", "up"]).select("tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"), (F.col("score") + F.col("s2")).alias("score"))
        state = cut(state, "jump")
    return tables, ended.select("tree", "node", "depth", "score")


def choose_paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(tree, path, node, place): the messages of the best paths of each tree, place 0 at the root.

    ``path`` is the rank of the leaf's branch, from 1.
    """
    tables, depths = jump_tables(nodes)
    parents = nodes.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = depths.join(parents, ["tree", "node"], "left_anti").withColumn("mean", F.col("score") / F.col("depth"))
    rank = Window.partitionBy("tree").orderBy(F.desc("mean"), F.desc("depth"), F.asc("node"))
    chosen = leaves.withColumn("path", F.row_number().over(rank)).where(F.col("path") <= best)
    on_path = chosen.select("tree", "path", "node")
    for table in reversed(tables):
        on_path = on_path.union(on_path.join(table, ["tree", "node"]).select("tree", "path", F.col("up").alias("node")))
        on_path = cut(on_path, "paths")
    return on_path.distinct().join(depths.select("tree", "node", (F.col("depth") - 1).alias("place")), ["tree", "node"]).select("tree", "path", "node", "place")


def formatted_turn(role: str = "role", text: str = "text"):
    """A turn in the template, as a column."""
    r = F.regexp_replace(F.coalesce(F.col(role), F.lit("")), _escape_role, r"\\$1")
    t = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _escape_text, r"\\$1")
    return F.concat(F.lit(HEAD), r, F.lit(":\n"), t, F.lit(END + "\n"))


def format_trees(messages: DataFrame, best: int = 1) -> DataFrame:
    """``messages(tree, node, parent, role, text, score)`` to (tree, path, place, formatted).

    A conversation is the ``formatted`` values of one tree and path in order of place.
    """
    paths = choose_paths(messages.select("tree", "node", "parent", "score"), best)
    turns = paths.join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    return turns.select("tree", "path", "place", formatted_turn().alias("formatted"))


class Reader:
    """Takes a conversation's text piece by piece and gives its turns as they end."""

    def __init__(self):
        self.held: list[str] = []  # of the turn that has not ended
        self.tail = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.tail += piece
        at = start = 0
        while (end := self.tail.find(END + "\n", at)) >= 0:
            slashes = end - start - len(self.tail[start:end].rstrip("\\"))
            if slashes == end - start and self.held:
                before = "".join(self.held)
                slashes += len(before) - len(before.rstrip("\\"))
            at = end + 1
            if slashes % 2 == 0:
                at = end + len(END) + 1
                yield self._turn("".join([*self.held, self.tail[start:end]]))
                self.held, start = [], at
        # what may be the beginning of the end stays
        cut_at = max(start, len(self.tail) - len(END))
        self.held.append(self.tail[start:cut_at])
        self.tail = self.tail[cut_at:]

    @staticmethod
    def _turn(shown: str) -> tuple[str, str]:
        parts = re.match(r"### ((?:[^\\:]|\\.)*):\n", shown, re.S)
        if not parts:
            raise ValueError(f"not in the template: {shown[:80]!r}")
        return _unescape.sub(r"\1", parts[1]), _unescape.sub(r"\1", shown[parts.end():])

    def close(self) -> None:
        if any(self.held) or self.tail:
            raise ValueError("the conversation ends within a turn")


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a conversation."""
    reader = Reader()
    out = list(reader.feed(formatted))
    reader.close()
    return out


_OUT = pa.schema([("conv_id", pa.int64()), ("path", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(formatted: DataFrame) -> DataFrame:
    """What each conversation's output holds: turns, and all text under the loss mask."""
    small_batches(formatted.sparkSession)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        turns = loss_chars = chars = 0
        all_sha = loss_sha = reader = None
        for b in batches:
            for tree, path, text in zip(*(c.to_pylist() for c in b.columns)):
                if key != (tree, path) or all_sha is None:
                    if all_sha is not None:
                        reader.close()
                        rows.append((*key, turns, all_sha.hexdigest(), loss_chars, loss_sha.hexdigest(), chars))
                    key, turns, loss_chars, chars = (tree, path), 0, 0, 0
                    all_sha, loss_sha, reader = hashlib.sha256(), hashlib.sha256(), Reader()
                chars += len(text)
                for role, said in reader.feed(text):
                    turns += 1
                    all_sha.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    if role == LEARNED_ROLE:
                        loss_chars += len(said)
                        loss_sha.update(said.encode("utf-8", "surrogatepass"))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_OUT)], schema=_OUT)
                rows = []
        if all_sha is not None:
            reader.close()
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, turns, all_sha.hexdigest(), loss_chars, loss_sha.hexdigest(), chars), _OUT)], schema=_OUT)

    ordered = formatted.select("tree", "path", "place", "formatted").repartition("tree", "path").sortWithinPartitions("tree", "path", "place")
    ddl = "conv_id long, path long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.select("tree", F.col("path").cast("long"), "formatted").mapInArrow(stream, ddl)


def linear_trees(conversations: DataFrame) -> DataFrame:
    """Conversations told turn by turn as trees of one branch: each turn answers the one before.

    Rows of one turn follow each other by role, then text.  They are dealt by ranges of that order,
    numbered within their range, and moved on by the rows that earlier ranges hold of their
    conversation: one small row for each range and conversation.
    """
    spark = conversations.sparkSession
    # a null conversation is one too; ids of trees must join
    tree = F.struct(F.col("conv_id").isNull().alias("n"), F.coalesce("conv_id", F.lit(0)).alias("v"))
    rows = conversations.select(tree.alias("tree"), "turn", "role", "text")
    # the bounds of ranges hold beginnings of texts only; texts of one turn that begin alike share a range
    dealt = rows.repartitionByRange(partitions(spark), "tree", "turn", "role", F.substring("text", 1, 256))
    # written, so that the ranges stay as they are
    rows = cut(dealt.withColumn("range", F.spark_partition_id()), "ranges")
    held = rows.groupBy("tree", "range").agg(F.count("*").alias("own"))
    before = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("tree", "range", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("tree", "range").orderBy("turn", "role", "text")
    numbered = rows.withColumn("at", F.row_number().over(order).cast("long")).join(held, ["tree", "range"]).withColumn("node", F.col("before") + F.col("at"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return numbered.select("tree", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    messages = cut(linear_trees(conversations), "messages")
    out = cut(format_trees(messages), "formatted")
    release(messages)
    plain = out.withColumn("tree", F.when(~F.col("tree.n"), F.col("tree.v")))
    return read_back(plain).drop("path")
