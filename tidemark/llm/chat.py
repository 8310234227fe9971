"""Chat formatting of reply trees.

Messages point to the message they reply to. Self-joins double the reach of
every message's pointer round by round (ancestor at distance 1, 2, 4, ...),
which yields each message's depth and the score of its path from the root
after as many rounds as the longest path has binary digits. The leaves of a
tree are ranked by the score of their path; the chosen paths are expanded
with the same pointer tables and each is formatted as one conversation.

A conversation is an array of segments (text, loss); joined, the segments
are the formatted text. A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``
and only texts of the assistant are under the loss. Control strings inside
texts and roles are broken with ``\\:`` after their first character and
backslashes are doubled, so the turns can be read back exactly.

Everything is DataFrame expressions. A formatted conversation is one string
and so is put together in one task; all else works on thin rows that are
dealt by message.

Defined results: a null text or role is empty; a message whose parent is
missing is a root; messages that reply in a circle raise an error; an empty
table gives no conversations. For tables of turns: rows of one turn follow
each other by role, then by digest of the text, and repeated rows are turns
of their own; a null conv_id is a conversation like any other. Other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrays import let
from .common import materialize, table

START, END = "<|im_start|>", "<|im_end|>\n"

# Control strings of common chat templates.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>",
           "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_BREAK = "([<\\[])(?=(?:" + "|".join("\\Q" + c[1:] + "\\E" for c in CONTROL) + "))"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, F.lit(_BREAK), F.lit("$1\\\\:"))


def unescape(text: Column) -> Column:
    """Inverse of escape (and of a role's line breaks as backslash n)."""
    parts = F.split(text, r"\\\\", -1)
    clean = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\:"), F.lit("")), F.lit("\\n"), F.lit("\n")))
    return F.array_join(clean, "\\")


def segments_of(role: Column, text: Column) -> Column:
    """The segments of one turn."""
    name = F.replace(escape(role), F.lit("\n"), F.lit("\\n"))
    piece = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
    return F.array(piece(F.concat(F.lit(START), name, F.lit("\n")), F.lit(False)),
                   piece(escape(text), role == "assistant"), piece(F.lit(END), F.lit(False)))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(text: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    def turn(part: Column) -> Column:
        name = F.substring_index(part, "\n", 1)
        body = F.substr(part, F.length(name) + 2, F.length(part) - F.length(name) - F.lit(1 + len(END)))
        return F.struct(unescape(name).alias("role"), unescape(body).alias("text"))

    return let(F.split(text, r"<\|im_start\|>", -1), lambda parts: F.transform(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn))


def ancestors(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """([(node, up) at distance 1, 2, 4, ...], (node, tree, depth, path_score)).

    Each round joins the pointers that have not reached a root with all
    pointers, on unique node ids.
    """
    parents = messages.select(F.col("node").alias("up"), F.lit(True).alias("_is"))
    state = materialize(
        messages.select("node", "tree", "score", F.col("parent").alias("up")).join(parents, "up", "left")
        .select("node", "tree", F.when(F.col("_is"), F.col("up")).alias("up"),
                F.when(F.col("_is"), 1).otherwise(0).cast("long").alias("depth"),
                F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("path_score")), "pointers")
    # messages that have reached their root are done; only the others go on
    done, active = [state.filter("up is null")], state.filter("up is not null")
    jumps, most = [], None
    while pending := active.count():
        most = most or pending.bit_length() + 1
        if len(jumps) > most:
            raise ValueError("messages reply to each other in a circle")
        jumps.append(active.select("node", "up"))
        far = reduce(DataFrame.unionByName, [*done, active]).select(
            F.col("node").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("path_score").alias("_score"))
        state = materialize(active.join(far, "up").select(
            "node", "tree", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"),
            (F.col("path_score") + F.col("_score")).alias("path_score")), "pointers")
        done, active = [*done, state.filter("up is null")], state.filter("up is not null")
    return jumps, reduce(DataFrame.unionByName, done).drop("up")


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(path, tree, path_score, node, depth): the nodes of the ``branches``
    best root-to-leaf paths of each tree; equal scores go to the lesser leaf."""
    jumps, state = ancestors(messages)
    inner = messages.select(F.col("parent").alias("node")).filter("node is not null").distinct()
    leaves = state.join(inner, "node", "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("path_score"), "node")
    chosen = materialize(leaves.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= branches)
                         .select(F.col("node").alias("path"), "tree", "path_score"), "chosen")
    on = chosen.select("path", F.col("path").alias("node"))
    for jump in jumps:                       # distances 0 .. 2^k - 1 become 0 .. 2^(k+1) - 1
        on = materialize(on.unionByName(on.join(jump, "node").select("path", F.col("up").alias("node"))), "paths")
    return on.join(chosen, "path").join(state.select("node", "depth"), "node")


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path: path, tree, path_score, segments.

    ``messages``: node (unique long), parent (long or null), tree, role,
    text, score.
    """
    turns = messages.select("node", segments_of(F.coalesce(F.col("role").cast("string"), F.lit("")),
                                                F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("turn"))
    rows = best_paths(messages, branches).join(turns, "node")
    ordered = F.sort_array(F.collect_list(F.struct("depth", "turn")))
    return rows.groupBy("path", "tree", "path_score").agg(ordered.alias("_t")).select(
        "path", "tree", "path_score", F.flatten(F.transform("_t", lambda x: x["turn"])).alias("segments"))


def tree_of_turns(turns: DataFrame) -> DataFrame:
    """Messages of a table (conv_id, turn, role, text): each turn replies to
    the one before it; a turn's score is the length of its text."""
    rows = materialize(turns.select(F.monotonically_increasing_id().alias("node"), F.col("conv_id").alias("tree"),
                                    "turn", F.col("role").cast("string").alias("role"),
                                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "messages")
    thin = rows.select("node", "tree", "turn", "role", F.md5(F.col("text").cast("binary")).alias("_d"))
    order = Window.partitionBy("tree").orderBy("turn", "role", "_d", "node")
    parents = thin.select("node", F.lag("node").over(order).alias("parent"))
    return materialize(rows.join(parents, "node").select("node", "parent", "tree", "role", "text",
                                                         F.length("text").alias("score")), "tree")


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: control strings as the text of both its turns."""
    said = F.lit("</s>[INST] ok [/INST]")
    return spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: every conversation formatted, written, and read back."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"),
                                                         F.col("turn").cast("long").alias("turn"), "role", "text")
    out = materialize(format_trees(tree_of_turns(turns.unionByName(probe(spark)))), "conversations")
    back = out.select(F.col("tree").alias("conv_id"), formatted(F.col("segments")).alias("text"), F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "").alias("loss")
    ).withColumn("turns", read_turns(F.col("text")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("text").cast("long").alias("formatted_chars"))
