"""Chat formatting of reply trees.

Messages point at the message they reply to. Iterative self-joins enumerate the path from every leaf to its root by
doubling; branches of a tree are ranked by the sum of their messages' scores, and each chosen branch is formatted as one
conversation: ``<|im_start|>role<|im_sep|>text<|im_end|>\\n`` a turn. Control strings inside roles and texts are escaped
reversibly (a backslash doubles, ``<|`` becomes ``<\\|``), so a marker in the output is always a real one. Spans of
assistant texts are returned as the loss mask.

Null text and null role count as empty. All messages with a null tree id are one tree. Texts are formatted whole, however
long; branches of equal scores are ranked by their leaves. Repeated rows are messages of their own.
Messages whose chain of parents never ends at a root (a cycle, or a parent that is missing) reach no root and give no
branch. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, stored

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turns(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[int], list[int]]:
    """The formatted conversation, and starts and ends of the texts under the loss mask (code points)."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEP, escape(text)
        if role == learn:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += (head, body, END, "\n")
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), starts, ends


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts back from a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def branches(messages: DataFrame, top: int | None = None) -> DataFrame:
    """Root-to-leaf branches of messages (tree, node, parent, score): rows (tree, leaf, branch, height, node).

    height counts from the leaf (0) to the root. branch ranks the tree's branches by score, from 1, ties by leaf.
    A chain of d messages takes 2 log2(d) self-joins: first each message learns its ancestor 1, 2, 4, ... levels up, then
    branches, which begin with their leaf alone, are refined by these jumps from the longest to the shortest."""
    nodes = stored(messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "nodes")
    same = lambda a, b, c, d: F.col(a).eqNullSafe(F.col(b)) & (F.col(c) == F.col(d))
    parents = nodes.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaf = nodes.join(parents, same("tree", "t", "node", "p"), "left_anti")
    # No chain is longer than its tree has messages, which also ends the search in a cycle.
    deepest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    named = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    up = nodes.where("parent is not null").join(named, same("tree", "t", "parent", "n"), "left_semi")
    jumps = [stored(up.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("parent").alias("up")), "jump")]
    while 1 << len(jumps) < deepest:
        step = jumps[-1].select(F.col("t").alias("t2"), F.col("n").alias("n2"), F.col("up").alias("up2"))
        more = stored(jumps[-1].join(step, same("t", "t2", "up", "n2")).select("t", "n", F.col("up2").alias("up")), "jump")
        if more.isEmpty():
            break
        jumps.append(more)
    path = leaf.select("tree", F.col("node").alias("leaf"), F.lit(0).cast("long").alias("height"), "node")
    for k in range(len(jumps) - 1, -1, -1):
        higher = path.join(jumps[k], same("tree", "t", "node", "n")).select("tree", "leaf", (F.col("height") + (1 << k)).alias("height"), F.col("up").alias("node"))
        path = stored(path.unionByName(higher), "path")
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), "parent", "score")
    scored = path.join(known, same("tree", "t", "node", "n")).groupBy("tree", "leaf").agg(
        F.sum("score").alias("sum"), F.max(F.col("parent").isNull()).alias("rooted")
    )
    w = Window.partitionBy("tree").orderBy(F.desc("sum"), "leaf")
    ranked = scored.where("rooted").select(F.col("tree").alias("t"), F.col("leaf").alias("l"), F.row_number().over(w).alias("branch"))
    if top is not None:
        ranked = ranked.where(F.col("branch") <= top)
    return path.join(ranked, same("tree", "t", "leaf", "l")).select("tree", "leaf", "branch", "height", "node")


def format_trees(messages: DataFrame, top: int | None = None) -> DataFrame:
    """Stored conversations of messages (tree, node, parent, role, text, score): tree, branch, formatted, loss spans."""
    messages = stored(messages.select("tree", "node", "parent", "role", "text", "score"), "messages")
    chosen = branches(messages, top)
    said = messages.select(
        F.col("tree").alias("t"), F.col("node").alias("n"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = chosen.join(said, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    whole = turns.groupBy("tree", "branch").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("height")).alias("at"), "role", "text"))).alias("turns")
    )

    def run(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        for trees, ranks, all_turns in batches:
            done = [format_turns([(x["role"], x["text"]) for x in t]) for t in all_turns]
            yield [trees, ranks, *([d[i] for d in done] for i in range(3))]

    schema = "tree long, branch int, formatted string, loss_start array<long>, loss_end array<long>"
    return stored(map_rows(whole.select(F.col("tree").cast("long"), "branch", "turns"), run, schema), "conversations")


def linear_trees(rows: DataFrame) -> DataFrame:
    """Conversations in rows (conv_id, turn, role, text) as trees: each row replies to the one before it by turn."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(w).cast("long")
    return rows.select(F.col("conv_id").cast("long").alias("tree"), node.alias("node"), "role", "text").select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.when(F.length("text") > 0, 1.0).otherwise(0.0).alias("score"),
    )


def digest(conversations: DataFrame) -> DataFrame:
    """What reading the formatted conversations back gives."""

    def run(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        for trees, texts, starts, ends in batches:
            out = []
            for text, ss, es in zip(texts, starts, ends, strict=True):
                turns = parse_turns(text)
                said = "".join(f"{role}\n{own}\n" for role, own in turns)
                loss = "".join(unescape(text[s:e]) for s, e in zip(ss, es, strict=True))
                sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (said, loss)]
                out.append((len(turns), sha[0], len(loss), sha[1], len(text)))
            yield [trees, *map(list, zip(*out, strict=True))] if out else [trees, [], [], [], [], []]

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_rows(conversations.select("tree", "formatted", "loss_start", "loss_end"), run, schema)
