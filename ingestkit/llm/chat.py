"""Chat formatting of reply trees.

Messages point to the message they answer. Iterative self-joins double the reach of every message's
ancestor pointer, so a tree of depth ``d`` takes ``log2 d`` joins; they give each message its root, its
depth and the score of the path to it. Leaves are the ends of root-to-leaf paths; the branches of a tree
are ranked by score and the best are taken. The same pointers, from the longest reach to the shortest,
list the messages on each chosen path, and each path becomes one conversation.

Template: every turn is ``<|turn|>role<|text|>text<|end|>``. In roles and texts a backslash follows each
``<`` and ``[`` and doubles itself, so neither the template's marks nor others of the form ``<...>`` or
``[...]`` occur in them, and the text can be read back. The loss mask is a list of spans over the
formatted text, one per assistant turn.

A turn is formatted in its own row. Turns are then sorted by path and streamed into parts of about
``PART_CHARS`` characters that end with a turn (almost always one part per conversation), so no
conversation is held as a whole, however long; digests are carried from part to part when reading back.

Defined results: null texts and roles are empty; a message whose parent does not exist starts a tree; a
cycle of parents is an error; equal scores go to the smaller leaf. Turns are ordered by turn (null
first), then role and text; repeated rows are turns of their own. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ingestkit.llm.common import global_order, tidy, written

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNT = "assistant"
PART_CHARS = 1 << 20


def escaped(x: Column) -> Column:
    out = F.coalesce(x, F.lit(""))
    for a, b in (("\\", "\\\\"), ("<", "<\\"), ("[", "[\\")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def unescaped(x: str) -> str:
    return re.sub(r"([\\<\[])\\", r"\1", x)


def reply_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """(path, node, depth) of the ``best`` root-to-leaf paths of each tree of ``messages`` (node, parent,
    score), ranked by the sum of the scores on the path. ``messages`` is a written table."""
    rows = messages.select("node", "parent", "score")
    known = rows.select(F.col("node").alias("parent"))
    start = written(
        rows.join(known.select("parent", F.lit(True).alias("there")), "parent", "left").select(
            "node", F.when(F.col("there"), F.col("parent")).alias("anc"), F.col("node").alias("top"),
            F.col("score").cast("double").alias("score"), F.lit(1).cast("long").alias("depth"),
        ),
        "reach",
    )
    reach, open_ = start.where("anc is null"), start.where("anc is not null")  # arrived at the root, on the way
    jumps = []
    rounds = max(rows.count(), 1).bit_length() + 1
    while not open_.isEmpty():
        if len(jumps) == rounds:
            raise ValueError("the parents of some messages form a cycle")
        jumps.append(open_.select("node", "anc"))
        far = reach.unionByName(open_).toDF("anc", "anc2", "top2", "score2", "depth2")
        step = written(
            open_.join(far, "anc").select(
                "node", F.col("anc2").alias("anc"), F.col("top2").alias("top"),
                (F.col("score") + F.col("score2")).alias("score"), (F.col("depth") + F.col("depth2")).alias("depth"),
            ),
            "reach",
        )
        reach, open_ = reach.unionByName(step.where("anc is null")), step.where("anc is not null")
    parents = rows.select(F.col("parent").alias("node")).where("node is not null")
    leaves = reach.join(parents, "node", "left_anti")
    rank = F.row_number().over(W.partitionBy("top").orderBy(F.desc("score"), "node"))
    on = leaves.withColumn("rank", rank).where(F.col("rank") <= best).select(F.col("node").alias("path"), "node")
    on = written(on, "paths")
    for jump in reversed(jumps):
        up = on.join(jump, "node").select("path", F.col("anc").alias("node"))
        on = written(on.unionByName(up), "paths")
    return on.join(reach.select("node", "depth"), "node").select("path", "node", "depth")


def chains(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as messages: every turn answers the one before."""
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")]
    rows = written(global_order(conversations.select("conv_id", "turn", "role", "text"), order, index="node"), "turns")
    before = rows.select((F.col("node") + 1).alias("node"), F.col("conv_id").alias("conv"), F.lit(True).alias("any"))
    linked = rows.join(before, "node", "left")
    parent = F.when(F.col("any") & F.col("conv").eqNullSafe(F.col("conv_id")), F.col("node") - 1)
    return written(
        linked.select("conv_id", "node", parent.alias("parent"), F.lit(1.0).alias("score"), "role", "text"), "messages"
    )


def formatted(messages: DataFrame, best: int = 1, part_chars: int = PART_CHARS) -> DataFrame:
    """(path, conv_id, part, text, loss) of the best paths of ``messages`` (conv_id, node, parent, score,
    role, text), a written table. ``loss`` holds the spans (start, stop) of the learnt text of the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, size, texts, loss = None, 0, 0, [], []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"path": key[0], "conv_id": key[1], "part": part, "text": "".join(texts), "loss": loss}],
                pa.schema([("path", pa.int64()), ("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()),
                           ("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]),
            )

        for b in batches:
            for r in b.to_pylist():
                if key is not None and (key[0] != r["path"] or size >= part_chars):
                    yield out()
                    part = part + 1 if key[0] == r["path"] else 0
                    size, texts, loss = 0, [], []
                key = (r["path"], r["conv_id"])
                if r["learnt"]:
                    stop = size + len(r["turn"]) - len(END)
                    loss.append({"start": stop - r["chars"], "stop": stop})
                texts.append(r["turn"])
                size += len(r["turn"])
        if key is not None:
            yield out()

    text = escaped(F.col("text"))
    turn = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT), text, F.lit(END))
    turns = reply_paths(messages, best).join(messages, "node").select(
        "path", F.col("conv_id").cast("long").alias("conv_id"), "depth", turn.alias("turn"),
        F.coalesce(F.col("role") == LEARNT, F.lit(False)).alias("learnt"), F.char_length(text).cast("long").alias("chars"),
    )
    return (
        turns.repartition("path")
        .sortWithinPartitions("path", "depth")
        .mapInArrow(tidy(run), "path long, conv_id long, part long, text string, loss array<struct<start:long,stop:long>>")
    )


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    for turn in text.split(END)[:-1]:
        role, _, body = turn.removeprefix(TURN).partition(TEXT)
        yield unescaped(role), unescaped(body)


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of the conversations of a formatted table, read from its texts and spans."""
    fields = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, row, turns, loss = None, None, None, None

        def out() -> pa.RecordBatch:
            done = row | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}
            return pa.RecordBatch.from_pylist([done], pa.schema([
                ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

        for b in batches:
            for r in b.to_pylist():
                if row is None or r["path"] != path:
                    if row is not None:
                        yield out()
                    path, turns, loss = r["path"], hashlib.sha256(), hashlib.sha256()
                    row = {"conv_id": r["conv_id"], "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
                for role, body in turns_of(r["text"]):
                    turns.update(f"{role}\n{body}\n".encode())
                    row["n_turns"] += 1
                for span in r["loss"]:
                    learnt = unescaped(r["text"][span["start"] : span["stop"]])
                    loss.update(learnt.encode())
                    row["loss_chars"] += len(learnt)
                row["formatted_chars"] += len(r["text"])
        if row is not None:
            yield out()

    return parts.repartition("path").sortWithinPartitions("path", "part").mapInArrow(tidy(run), fields)


def _esc_len(x: str) -> str:
    c = f"coalesce({x}, '')"
    return f"(2 * length({c}) - length(translate({c}, '\\<[', '')))"


ORACLE = f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn, role, text) FILTER (role = '{LEARNT}'), '') AS learnt,
  CAST(sum({len(TURN + TEXT + END)} + {_esc_len("role")} + {_esc_len("text")}) AS BIGINT) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars FROM g"""
