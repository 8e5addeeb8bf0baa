"""Conversations from reply trees.

Iterative self-joins enumerate root-to-leaf paths. Each round joins the table of
jumps with itself, so that a jump skips twice as many messages; walking the jumps
from the longest to the shortest then gives every leaf all messages above it, once
each, in a number of rounds that is logarithmic in the depth. Branches are ranked
by score, and each chosen path is formatted as one conversation.

The template marks turns with control strings. Inside roles and texts a backslash
is doubled and one is put into every ``<|``, so no text can end a turn, and reading
a conversation back gives the texts as they were.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vayumark.llm.common import stage

START, END = "<|im_start|>", "<|im_end|>"
TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def format_turns(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """A conversation of (role, text) turns, and the spans of what role ``learn`` says (code points, end exclusive)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = START + escape(role).replace("\n", "\\n") + "\n"
        body = escape(text)
        if role == learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    return [(unescape(role), unescape(body)) for role, body in TURN.findall(text)]


def chains(conversations: DataFrame) -> DataFrame:
    """Messages of ``conversations`` (conv_id, turn, role, text): each replies to the one before.

    Turns are ordered by turn, role and text, nulls first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        F.col("conv_id").alias("tree"),
        F.row_number().over(order).cast("long").alias("node"),
        (F.row_number().over(order) - 1).cast("long").alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def paths(messages: DataFrame) -> DataFrame:
    """tree, leaf, node and ``above`` (messages between node and leaf, and the node) of every root-to-leaf path.

    ``messages`` has tree (not null), node and parent.
    """
    nodes = stage(messages.select("tree", "node", "parent").dropDuplicates(["tree", "node"]), "nodes")
    known = nodes.select("tree", F.col("node").alias("parent"))
    first = nodes.filter("parent is not null").join(known, ["tree", "parent"], "left_semi")
    jumps = [stage(first.select("tree", "node", F.col("parent").alias("up")), "jumps")]
    most = max(1, nodes.count()).bit_length()
    lost = None
    while not jumps[-1].isEmpty():
        if len(jumps) > most:  # jumps longer than any path go round in circles
            lost = jumps[-1].select("tree", "node")
            break
        far = jumps[-1].select("tree", F.col("node").alias("up"), F.col("up").alias("further"))
        jumps.append(
            stage(jumps[-1].join(far, ["tree", "up"]).select("tree", "node", F.col("further").alias("up")), "jumps")
        )
    inner = jumps[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = nodes.select("tree", "node").join(inner, ["tree", "node"], "left_anti")
    if lost is not None:
        leaves = leaves.join(lost, ["tree", "node"], "left_anti")
    walked = stage(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above")), "walked")
    for k in range(len(jumps) - 2 if lost is None else len(jumps) - 1, -1, -1):
        step = walked.join(jumps[k], ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above"))
        walked = stage(walked.union(step), "walked")
    return walked


def format_trees(messages: DataFrame, top: int = 1) -> DataFrame:
    """The ``top`` best branches of every tree of ``messages`` (tree, node, parent, role, text, score), formatted.

    A branch is a path from a root (no parent, or one that is not there) to a leaf;
    its score is the sum of its messages' (null: 0), ties go to the smaller leaf.
    Returns tree, rank, leaf, score, turns (array of role and text), text and loss
    (array of start and end, code points).

    A null role or text counts as empty, a null tree is a tree of its own, and a node
    that occurs twice in a tree counts once. Messages that reply in a circle have no
    root and are left out. Other columns are ignored. An empty table gives an
    empty result.
    """
    kind = dict(messages.dtypes)["tree"]
    key = F.coalesce(F.col("tree").cast("string"), F.lit(""))  # joins need a key that is not null
    tagged = stage(
        messages.select(
            F.concat(F.when(F.col("tree").isNull(), "-").otherwise("+"), key).alias("tree"),
            F.col("tree").alias("name"),
            "node",
            "parent",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        ).dropDuplicates(["tree", "node"]),
        "messages",
    )
    walked = paths(tagged)
    scored = (
        walked.join(tagged.select("tree", "node", "score"), ["tree", "node"])
        .groupBy("tree", "leaf")
        .agg(F.sum("score").alias("total"))
    )
    order = Window.partitionBy("tree").orderBy(F.col("total").desc(), "leaf")
    chosen = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    told = (
        walked.join(chosen, ["tree", "leaf"])
        .join(tagged.select("tree", "node", "name", "role", "text"), ["tree", "node"])
        .groupBy("tree", "leaf", "rank", "total")
        .agg(F.first("name").alias("name"), F.sort_array(F.collect_list(F.struct(-F.col("above"), "role", "text"))).alias("turns"))
        .select("name", "rank", "leaf", "total", F.transform("turns", lambda x: F.struct(x["role"], x["text"])).alias("turns"))
    )

    def run(batches):
        for batch in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in batch.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([text for text, _ in made], pa.string()),
                    pa.array(
                        [[{"start": a, "end": b} for a, b in spans] for _, spans in made],
                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                    ),
                ],
                names=["tree", "rank", "leaf", "score", "turns", "text", "loss"],
            )

    return told.mapInArrow(
        run,
        f"tree {kind}, rank int, leaf {dict(messages.dtypes)['node']}, score double, turns array<struct<role:string,text:string>>,"
        " text string, loss array<struct<start:bigint,end:bigint>>",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """tree with counts and digests of what is read back from ``text`` and ``loss``."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, loss in zip(batch.column("text").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                turns = read_turns(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                learned = "".join(unescape(text[x["start"] : x["end"]]) for x in loss)
                rows.append(
                    (
                        len(turns),
                        hashlib.sha256(said.encode()).hexdigest(),
                        len(learned),
                        hashlib.sha256(learned.encode()).hexdigest(),
                        len(text),
                    )
                )
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kind = dict(formatted.dtypes)["tree"]
    return formatted.select("tree", "text", "loss").mapInArrow(
        run,
        f"tree {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
