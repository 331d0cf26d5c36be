"""Chat formatting of reply trees.

Messages name the message they answer. Iterative self-joins, each doubling the reach,
give every message its distance from the root and the score of its path. Leaves are the
ends of branches; the best-scored branches of a tree are walked back to the root by the
same tables, and every chosen path becomes one formatted conversation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.common import in_slices, mapped, saved

#: The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escaped(text: str) -> str:
    """Breaks up every ``<|``, so that a text never holds a control string; backslashes are doubled."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans of code points under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{escaped(role).replace('\n', chr(92) + '\n')}\n"
        body = escaped(text)
        if role == LEARNED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescaped(m[1]), unescaped(m[2])) for m in TURN.finditer(formatted)]


def masked_text(formatted: str, spans: list[tuple[int, int]]) -> str:
    """All text under the loss mask, unescaped, without anything between."""
    return "".join(unescaped(formatted[a:b]) for a, b in spans)


def _doubled(nodes: DataFrame, rounds: int) -> list[DataFrame]:
    """Tables of every message's 2 ** i-th ancestor, with the number and score of the messages below it."""
    up = nodes.select("tree", "node", F.col("parent").alias("above"), F.lit(1).cast("long").alias("steps"), F.col("score").alias("sum"))
    tables = [saved(up, "ancestors")]
    for _ in range(rounds):
        near, settled = tables[-1].filter("above is not null"), tables[-1].filter("above is null")
        same = (F.col("n.tree") == F.col("f.tree")) & (F.col("n.above") == F.col("f.node"))
        up = near.alias("n").join(tables[-1].alias("f"), same).select(
            "n.tree", "n.node", "f.above", (F.col("n.steps") + F.col("f.steps")).alias("steps"), (F.col("n.sum") + F.col("f.sum")).alias("sum")
        )
        tables.append(saved(up.union(settled), "ancestors"))
    return tables


def best_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """tree, leaf, place, node: the messages of the ``keep`` best branches of every tree, from the root down.

    ``messages`` holds tree, node, parent, score. A branch scores the sum of its messages;
    ties go to the smaller leaf. A message whose parent is null or missing is a root.
    Messages in a circle belong to no path. Rows of one tree and node count once, with
    the smallest parent and score; rows without a tree or node are left out.
    """
    nodes = messages.filter("tree is not null and node is not null").groupBy("tree", "node").agg(
        F.min(F.struct(F.col("parent").isNull(), "parent", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("r")
    )
    nodes = nodes.select("tree", "node", "r.parent", "r.score")
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    nodes = nodes.join(known, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("p")), "left")
    nodes = saved(nodes.select("tree", "node", F.col("p").alias("parent"), "score"), "messages")
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 1
    tables = _doubled(nodes, max(1, (largest - 1).bit_length()))
    rooted = tables[-1].filter("above is null").select("tree", "node", "steps", "sum")
    answered = nodes.filter("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = rooted.join(answered, ["tree", "node"], "left_anti")
    if keep == 1:
        chosen = leaves.groupBy("tree").agg(F.min(F.struct(-F.col("sum"), "node", "steps")).alias("b")).select("tree", "b.node", "b.steps")
    else:
        order = Window.partitionBy("tree").orderBy(F.desc("sum"), "node")
        chosen = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep).select("tree", "node", "steps")
    path = saved(chosen.select("tree", F.col("node").alias("leaf"), "node"), "leaves")
    for table in reversed(tables[:-1]):
        above = table.filter("above is not null").select(F.col("tree").alias("t"), F.col("node").alias("n"), "above")
        joined = path.join(above, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n")))
        # Written at every step: a plan that holds itself twice would double each time.
        path = saved(path.union(joined.select("tree", "leaf", F.col("above").alias("node"))), "paths")
    return path.join(rooted.select("tree", "node", F.col("steps").alias("place")), ["tree", "node"])


def format_trees(messages: DataFrame, keep: int = 1) -> DataFrame:
    """tree, leaf, formatted, loss_starts, loss_ends: one row per chosen branch.

    ``messages`` holds tree, node, parent, score, role, text; other columns are left out.
    Null roles and texts count as empty. The paths are those of ``best_paths``; of
    repeated rows of a node the smallest role and text are kept. An empty table gives no rows.
    """
    messages = saved(messages.select("tree", "node", "parent", "score", "role", "text"), "replies")
    said = messages.groupBy("tree", "node").agg(
        F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("m")
    )
    paths = best_paths(messages, keep).join(said, ["tree", "node"])
    turns = paths.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("place", "m.role", "m.text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 64):
            texts, starts, ends = [], [], []
            for path in batch.column(2).to_pylist():
                formatted, spans = format_turns([(t["role"], t["text"]) for t in path])
                texts.append(formatted)
                starts.append([a for a, _ in spans])
                ends.append([b for _, b in spans])
            lists = [pa.array(c, pa.list_(pa.int64())) for c in (starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), *lists],
                names=["tree", "leaf", "formatted", "loss_starts", "loss_ends"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}
    ddl = f"tree {kinds['tree']}, leaf {kinds['leaf']}, formatted string, loss_starts array<long>, loss_ends array<long>"
    return mapped(turns, run, ddl)


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Conversations without branches as trees: every row, by turn, answers the one before it.

    Rows of one turn follow each other by role and text, so none is lost; a null turn
    comes first. Rows without a conv_id are left out.
    """
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("tree"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("tree").orderBy(F.asc_nulls_first("turn"), "role", "text")
    node = F.row_number().over(order).cast("long")
    numbered = rows.withColumn("node", node)
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return numbered.select("tree", "node", parent.alias("parent"), F.lit(0.0).alias("score"), "role", "text")
