"""Chat formatting over reply trees.

A node is one message; its parent is the message it replies to.  Self-joins of
the reply links give the links over 2, 4, 8, ... replies, each table smaller than
the one before.  The paths from every leaf are then unfolded from the longest
links to the shortest: each join reaches the ancestors whose distance has that
power of two in it, so every ancestor is met exactly once, and a tree of depth d
takes about 2 log2(d) joins.  Each root's paths are ranked by the sum of their
messages' scores, and each chosen path is formatted as one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  A backslash
inside a role or text becomes two, ``<|`` becomes ``<\\|``, and a line break in
a role becomes backslash n; reading back undoes it.

Defined results: a null role or text counts as empty; a conversation with a
null id is one conversation; a null turn comes first, and rows of one turn
follow each other by role and text, repeated rows included; an empty table gives
no conversation; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_table

START, END = "<|im_start|>", "<|im_end|>"
_TURN = r"<\|im_start\|>([^\n]*)\n((?s:.*?))<\|im_end\|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    # Pairs of backslashes are set aside while backslash n becomes a line break.
    parts = F.split(role, r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(
        F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))), "\\")


def linear_tree(messages: DataFrame, conv: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text") -> DataFrame:
    """Conversations of numbered turns as reply trees: each row replies to the
    row before it.  Columns node, parent, tree, role, text, score."""
    rows = messages.select(F.col(conv).alias("tree"), F.col(turn).alias("turn"),
                           F.coalesce(F.col(role), F.lit("")).alias("role"),
                           F.coalesce(F.col(text), F.lit("")).alias("text"))
    place = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    at = F.row_number().over(place)
    return rows.withColumn("at", at).select(
        "tree", F.struct("tree", "at").alias("node"),
        F.when(F.col("at") > 1, F.struct("tree", (F.col("at") - 1).alias("at"))).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"))


def _node_key(column: str) -> Column:
    """Node ids of any type as text, so that they can be joined null-safe."""
    return F.to_json(F.struct(F.col(column).alias("n")), {"ignoreNullFields": "false"})


def ancestor_links(replies: DataFrame, nodes: int) -> list[DataFrame]:
    """Written tables (node, above) over 1, 2, 4, ... replies."""
    links = [scratch_table(replies, "links-1")]
    while links[-1].limit(1).count():
        if 1 << len(links) > 2 * nodes:
            raise ValueError("the reply links hold a cycle")
        half = links[-1]
        links.append(scratch_table(
            half.select("node", F.col("above").alias("mid")).join(
                half.select(F.col("node").alias("mid"), "above"), "mid").select("node", "above"),
            f"links-{1 << len(links)}"))
    return links[:-1]


def root_to_leaf_paths(nodes: DataFrame) -> DataFrame:
    """Every path from a root to a leaf, one row per message on it: leaf, at (0
    for the root), node (as text).

    ``nodes`` has node and parent; a parent that is null or not in the table
    makes its child a root.
    """
    keyed = scratch_table(nodes.select(
        _node_key("node").alias("node"),
        F.when(F.col("parent").isNotNull(), _node_key("parent")).alias("above")), "nodes")
    known = keyed.select(F.col("node").alias("above")).distinct()
    replies = keyed.where("above is not null").join(known, "above", "left_semi").select(
        "node", "above")
    links = ancestor_links(replies, keyed.count())
    answered = replies.select(F.col("above").alias("node")).distinct()
    paths = keyed.select("node").join(answered, "node", "left_anti").select(
        F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("up"))
    for k in reversed(range(len(links))):
        here = F.struct("leaf", "node", "up")
        there = F.when(F.col("above").isNotNull(), F.struct(
            "leaf", F.col("above").alias("node"), (F.col("up") + F.lit(1 << k)).alias("up")))
        paths = paths.join(links[k], "node", "left").select(
            F.inline(F.array_compact(F.array(here, there))))
    paths = scratch_table(paths, "paths")
    length = paths.groupBy("leaf").agg(F.max("up").alias("top"))
    return paths.join(length, "leaf").select("leaf", (F.col("top") - F.col("up")).alias("at"),
                                             "node")


def formatted_conversations(nodes: DataFrame, best: int | None = 1) -> DataFrame:
    """The ``best`` paths of each root (None: all) as conversations: tree, leaf,
    rank, formatted, and loss_spans (start from 0 and length, in characters of
    ``formatted``) of the assistant texts.  ``nodes`` has tree, node, parent,
    role, text and score; a path with a higher sum of scores comes first, then
    the longer path, then the smaller leaf."""
    spoken = nodes.select(_node_key("node").alias("node"), "tree",
                          F.coalesce("score", F.lit(0.0)).alias("score"),
                          escaped_role(F.coalesce("role", F.lit(""))).alias("e_role"),
                          escaped(F.coalesce("text", F.lit(""))).alias("e_text"),
                          F.col("role").eqNullSafe("assistant").alias("answers"))
    steps = root_to_leaf_paths(nodes).join(spoken, "node")
    turn = F.concat(F.lit(START), "e_role", F.lit("\n"), "e_text", F.lit(f"{END}\n"))
    lead = F.length("e_role") + F.lit(len(START) + 1)
    rows = steps.groupBy("leaf").agg(
        F.first("tree").alias("tree"), F.sum("score").alias("score"),
        F.max(F.when(F.col("at") == 0, F.col("node"))).alias("root"),
        F.array_sort(F.collect_list(F.struct(
            "at", turn.alias("turn"), lead.alias("lead"), F.length("e_text").alias("chars"),
            "answers"))).alias("turns"))
    order = Window.partitionBy("root").orderBy(F.desc("score"), F.desc(F.size("turns")), "leaf")
    rows = rows.withColumn("rank", F.row_number().over(order))
    if best is not None:
        rows = rows.where(F.col("rank") <= best)
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>")
                 .alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["turn"])).alias("at"),
            F.when(t["answers"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + t["lead"]).alias("start"), t["chars"].alias("length")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return rows.select("tree", "leaf", "rank",
                       F.array_join(F.transform("turns", lambda t: t["turn"]), "")
                       .alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) read from ``formatted`` and ``loss_text``, what
    lies under the loss spans, both unescaped."""
    roles = F.regexp_extract_all("formatted", F.lit(_TURN), 1)
    texts = F.regexp_extract_all("formatted", F.lit(_TURN), 2)
    turns = F.zip_with(roles, texts, lambda r, t: F.struct(
        unescaped_role(r).alias("role"), unescaped(t).alias("text")))
    under = F.transform("loss_spans", lambda s: unescaped(
        F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.withColumns({"turns": turns, "loss_text": F.array_join(under, "")})
