"""Reply trees to chat text, in DataFrame functions only.

A node is a message with a parent in the same conversation.  Root-to-leaf paths come from
self-joins that double: after step k every node knows its ancestor 2**k above, its depth
and the score summed on the way, so a conversation of m nodes takes part in log2(m) joins of
narrow rows (staged in the shared folder) and a long one costs the others nothing.  The leaves of a conversation are ranked by their path's
score; the ancestors of the chosen leaves are marked by the same jumps in reverse.

Format: every turn is ``### <role>: <text> </turn>`` and a line feed.  Inside roles and
texts a backslash stands before each backslash, before each ``#`` that follows or precedes
another one, before ``/turn>`` and, in roles, before a colon; dropping a backslash and
keeping what follows restores them.  The loss mask is a list of (start, length) in code
points of the formatted text that covers each assistant text.

Cases: null text and null role are empty strings; a parent that does not exist makes a
root; nodes in a cycle have no root and are left out; equal nodes (same conversation and
node id) are kept apart by position; a conversation without nodes has no row; an empty
table gives an empty result; columns besides the named ones are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

ASSISTANT = "assistant"


def linear_nodes(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """Conversations that are lists of turns, as trees of one path: each row's parent is
    the row before in its conversation (ties by role, then text)."""
    w = Window.partitionBy("conv").orderBy("turn", "role", "text")
    base = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                       F.col(text_col).alias("text"))
    node = F.row_number().over(w).cast("long")
    return base.withColumn("node", node).select(
        "conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"))


def best_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(conv, path, node, depth) of the ``branches`` best leaves of each conversation;
    depth counts from the root, ties go to the deeper, then the smaller leaf."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null"))
    ids = nodes.select(conv.alias("conv"), "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = ids.select("conv", F.col("node").alias("parent"), F.lit(1).alias("_known")).distinct()
    sizes = ids.groupBy("conv").agg(F.count(F.lit(1)).alias("size"))
    now = ids.join(known, ["conv", "parent"], "left").join(sizes, "conv").select(
        "conv", "node", F.when(F.col("_known").isNotNull(), F.col("parent").cast(ids.schema["node"].dataType)).alias("up"),
        F.when(F.col("_known").isNotNull(), 1).otherwise(0).cast("long").alias("depth"), "score", "size")
    now = staged(now, "tree-0")
    parents = now.where("up is not null").select("conv", F.col("up").alias("node"), F.lit(1).alias("_inner")).distinct()
    largest = now.agg(F.max("size")).first()[0] or 0
    steps, done = [], now.where("size <= 1 and up is null")
    while 1 << len(steps) < largest:
        # a path has no more nodes than its conversation, so that conversations leave when
        # 2**k reaches their size; what still points up then is in, or hangs on, a cycle
        live = now.where(F.col("size") > 1 << len(steps))
        steps.append(live.where("up is not null").select("conv", "node", "up"))
        above = live.select("conv", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"),
                            F.col("score").alias("_score"))
        nxt = live.where("up is not null").join(above, ["conv", "up"], "left").select(
            "conv", "node", F.col("_up").alias("up"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            (F.col("score") + F.coalesce("_score", F.lit(0.0))).alias("score"), "size")
        now = staged(nxt.unionByName(live.where("up is null")), f"tree-{len(steps)}")
        done = done.unionByName(now.where(F.col("up").isNull() & (F.col("size") <= 1 << len(steps))))
    leaves = done.join(parents, ["conv", "node"], "left_anti")
    rank = Window.partitionBy("conv").orderBy(F.col("score").desc(), F.col("depth").desc(), "node")
    leaves = leaves.withColumn("path", F.row_number().over(rank)).where(F.col("path") <= branches)
    leaves = staged(leaves.select("conv", "path", "node", "depth", "size"), "tree-leaves")
    found = leaves.where("size <= 1").drop("size") if not steps else None
    for k, far in reversed(list(enumerate(steps))):
        enter = leaves.where((F.col("size") > 1 << k) & (F.col("size") <= 2 << k)).drop("size")
        found = enter if found is None else found.unionByName(enter)
        # read once a step: a union with itself would double the plan every time
        here = F.struct("node", "depth")
        above = F.struct(F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))
        at = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, above))
        found = found.join(far, ["conv", "node"], "left").select("conv", "path", F.explode(at).alias("at")) \
            .select("conv", "path", "at.node", "at.depth")
    if steps:
        found = found.unionByName(leaves.where("size <= 1").drop("size"))
    return found


def escape(text: Column, role: bool = False) -> Column:
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    out = F.regexp_replace(out, r"#(?=#)|(?<=#)#", r"\\#")
    out = F.regexp_replace(out, "/turn>", r"\\/turn>")
    return F.regexp_replace(out, ":", r"\\:") if role else out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_paths(nodes: DataFrame, branches: int = 1, trained_role: str = ASSISTANT) -> DataFrame:
    """(conv, path, formatted, loss_spans): one conversation per chosen path."""
    paths = best_paths(nodes, branches)
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null"))
    texts = nodes.select(key.alias("_key"), F.col("conv").alias("_conv"), "node", "role", "text")
    rows = texts.join(paths.withColumnRenamed("conv", "_key"), ["_key", "node"])
    head = F.concat(F.lit("### "), escape(F.col("role"), True), F.lit(": "))
    rows = rows.select("_key", "_conv", "path", "depth", head.alias("head"), escape(F.col("text")).alias("body"),
                       F.coalesce(F.col("role") == trained_role, F.lit(False)).alias("train"))
    rows = rows.withColumn("turn", F.concat("head", "body", F.lit(" </turn>\n")))
    w = Window.partitionBy("_key", "path").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("turn")).over(w), F.lit(0).cast("long")))
    span = F.when(F.col("train"), F.struct((F.col("at") + F.length("head")).alias("start"),
                                           F.length("body").cast("long").alias("length")))
    out = rows.groupBy("_key", "path").agg(
        F.first("_conv").alias("conv"), F.array_sort(F.collect_list(F.struct("depth", "turn"))).alias("turns"),
        F.array_sort(F.collect_list(span)).alias("loss_spans"))
    return out.select("conv", F.col("path"), F.array_join("turns.turn", "").alias("formatted"), "loss_spans")


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted text."""
    turns = F.filter(F.split(formatted, r" </turn>\n"), lambda x: x != "")

    def one(t: Column) -> Column:
        role = F.regexp_extract(t, r"(?s)^### ((?:[^\\:]|\\.)*): ", 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(t, F.length(role) + 7)).alias("text"))
    return F.transform(turns, one)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped.  Spans are cut from fixed-width characters,
    which takes time in proportion to the text."""
    def cut(wide: Column) -> Column:
        # decode drops nothing: UTF-32 has four bytes a code point
        return F.array_join(F.transform(spans, lambda s: unescape(F.decode(
            F.substr(wide, (s["start"] * 4 + 1).cast("int"), (s["length"] * 4).cast("int")), "UTF-32"))), "")
    return F.element_at(F.transform(F.array(F.encode(formatted, "UTF-32")), cut), 1)
