"""Chat formatting of reply trees.

Messages (tree, msg, parent, role, text, score) form trees.  Root-to-leaf paths are enumerated by self-
joins that double the reach each round: a table of 2^k-th ancestors extends every path by the part it
does not have yet, so a conversation of n turns takes log2(n) rounds, each written to the shared folder.
Paths are ranked by the mean score of their messages (null scores count as 0, ties by leaf id) and each
of the best becomes one conversation.

Template.  A turn is ``<|im_start|>`` role newline text ``<|im_end|>`` newline.  Inside roles and texts a
backslash is doubled and ``<|`` is written ``<\\|``; a newline in a role is written ``\\n``.  So no text can
form a control string, and reading back restores it exactly.  ``loss`` holds the code-point spans of the
assistant texts in the formatted string.

Defined results: a null text or role is empty; a message whose parent is null or missing starts a tree of
its own path; repeated message rows count once; an empty table gives no rows; a null tree is a tree of its
own; a reply cycle is an error.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import saved

START, END = "<|im_start|>", "<|im_end|>"
NO_TREE = -(1 << 63)


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def unescape_role(role: Column) -> Column:
    """Doubled backslashes part the rest into pieces whose other escapes stand alone."""
    parts = F.transform(F.split(role, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")))
    return F.array_join(parts, "\\")


def reply_paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, msg, up): for every leaf each message on its path and the steps from the leaf up to it."""
    nodes = saved(messages.select("tree", "msg", "parent").dropDuplicates(["tree", "msg"]), "chat-nodes")
    known = nodes.select("tree", F.col("msg").alias("parent"))
    jump = saved(nodes.join(known, ["tree", "parent"], "left_semi").select("tree", "msg", F.col("parent").alias("above")), "chat-jump")
    parents = jump.select("tree", F.col("above").alias("msg"))
    paths = saved(nodes.join(parents, ["tree", "msg"], "left_anti").select("tree", F.col("msg").alias("leaf"), "msg", F.lit(0).cast("long").alias("up")), "chat-paths")
    parts, step = [paths], 1
    longest = nodes.groupBy("tree").count().agg(F.max("count").alias("n")).collect()[0]["n"] or 0
    while jump.take(1):
        if step > longest:  # an ancestor further up than the tree has messages
            raise ValueError("the replies form a cycle")
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        more = saved(every.join(jump, ["tree", "msg"]).select("tree", "leaf", F.col("above").alias("msg"), (F.col("up") + step).alias("up")), "chat-paths")
        parts.append(more)
        further = jump.select("tree", F.col("msg").alias("above"), F.col("above").alias("top"))
        jump = saved(jump.join(further, ["tree", "above"]).select("tree", "msg", F.col("top").alias("above")), "chat-jump")
        step *= 2
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every


def best_paths(messages: DataFrame, paths: DataFrame, branches: int = 1) -> DataFrame:
    """Every message of the ``branches`` best-ranked paths of each tree: (tree, leaf, branch, pos, role, text)."""
    body = messages.select("tree", "msg", "role", "text", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")) \
        .dropDuplicates(["tree", "msg"])
    turns = paths.join(body, ["tree", "msg"])
    rank = Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf")
    ranked = turns.groupBy("tree", "leaf").agg(F.avg("score").alias("mean")).withColumn("branch", F.row_number().over(rank)) \
        .where(F.col("branch") <= branches).select("tree", "leaf", "branch")
    return turns.join(ranked, ["tree", "leaf"]).select("tree", "leaf", "branch", (-F.col("up")).alias("pos"), "role", "text")


def format_paths(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(tree, branch, formatted, loss): one conversation per path; ``loss`` spans the trained role's texts."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    cut = turns.select("tree", "branch", "pos", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    cut = cut.withColumn("size", F.length("head") + F.length("body") + len(END) + 1)
    before = Window.partitionBy("tree", "branch").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("first", F.coalesce(F.sum("size").over(before), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == trained_role, F.struct(F.col("first").alias("start"), (F.col("first") + F.length("body")).alias("end")))
    grouped = cut.groupBy("tree", "branch").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.concat("head", "body", F.lit(END + "\n")).alias("piece")))).alias("pieces"),
        F.array_sort(F.collect_list(span)).alias("loss"))
    return grouped.select("tree", "branch", F.array_join("pieces.piece", "").alias("formatted"), "loss")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    bare = F.transform(pieces, lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(bare, lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substr(p, F.locate("\n", p) + 1)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask, span after span."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def thread_messages(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """Messages of linear conversations: each row replies to the one before it (by turn, then role and text)."""
    rows = conversations.select(F.coalesce(F.col(conv_col).cast("long"), F.lit(NO_TREE)).alias("tree"), F.col(turn_col).alias("turn"),
                                F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return rows.withColumn("msg", F.row_number().over(order).cast("long")) \
        .select("tree", "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def format_trees(messages: DataFrame, branches: int = 1, trained_role: str = "assistant") -> DataFrame:
    """(tree, branch, formatted, loss) for the best paths of each tree."""
    named = messages.withColumn("tree", F.coalesce(F.col("tree").cast("long"), F.lit(NO_TREE)))
    out = format_paths(best_paths(named, reply_paths(named), branches), trained_role)
    return out.withColumn("tree", F.when(F.col("tree") != NO_TREE, F.col("tree")))
