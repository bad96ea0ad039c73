"""Reply trees to formatted conversations, with DataFrame operations only.

Messages with a parent form trees.  Paths from root to leaf are found by
self-joins on a table of jumps that doubles its reach each round: after round
i every leaf is paired with its ancestors up to distance 2^i, so a tree of
depth d takes log2(d) rounds.  Branches are ranked by the sum of their
messages' scores; each chosen path is written as one conversation:

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

A backslash inside a text is doubled and ``<|`` becomes ``<\\|``, so a text
cannot hold a control string and the original can be read back; a role's line
feeds become ``\\n`` too.  The loss mask is a list of code-point spans: the
(escaped) assistant texts.

Defined results: null text or role: empty; rows of a conversation with the same
turn are ordered by role, then text, and all kept; null turns come first; null
conv_ids form one conversation; empty table: empty result; further columns are
ignored; a parent that does not exist makes a root; a cycle raises an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # a backslash that is not itself escaped, then n
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def chain(messages: DataFrame) -> DataFrame:
    """The tree of plain conversations: each row answers the one before it by turn."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("node_id", F.row_number().over(order).cast("long"))
    return rows.select("conv_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
                       "role", "text", F.lit(0.0).alias("score"))


def _keyed(tree: DataFrame) -> DataFrame:
    """``tree`` with its conversation as a key that is never null."""
    return tree.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))


def paths(tree: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(key, leaf, node_id, up): every leaf with the messages of its path, ``up``
    steps above it.  ``tree`` has key, node_id, parent_id."""
    nodes = tree.select("key", "node_id")
    jump = (tree.where("parent_id is not null").select("key", "node_id", F.col("parent_id").alias("to"))
            .join(nodes.select("key", F.col("node_id").alias("to")).distinct(), ["key", "to"], "left_semi").checkpoint())
    parents = jump.select("key", F.col("to").alias("node_id")).distinct()
    found = nodes.join(parents, ["key", "node_id"], "left_anti").select(
        "key", F.col("node_id").alias("leaf"), "node_id", F.lit(0).cast("long").alias("up"))
    step = 1
    for _ in range(max_rounds):
        further = found.join(jump, ["key", "node_id"]).select("key", "leaf", F.col("to").alias("node_id"), (F.col("up") + step).alias("up"))
        found = found.union(further).checkpoint()
        again = jump.select("key", F.col("node_id").alias("to"), F.col("to").alias("end"))
        jump = jump.join(again, ["key", "to"]).select("key", "node_id", F.col("end").alias("to")).checkpoint()
        step *= 2
        if jump.isEmpty():
            return found
    raise ValueError("the parents of some messages form a cycle")


def best_paths(tree: DataFrame, per_conversation: int = 1) -> DataFrame:
    """Messages of the ``per_conversation`` best root-to-leaf paths: conv_id, leaf,
    rank, depth, role, text.  Ties go to the smaller leaf."""
    tree = _keyed(tree)
    steps = paths(tree)
    branch = (steps.join(tree.select("key", "node_id", "score"), ["key", "node_id"])
              .groupBy("key", "leaf").agg(F.sum("score").alias("total"), F.max("up").alias("depth")))
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc_nulls_last("total"), "leaf"))
    chosen = branch.withColumn("rank", rank).where(F.col("rank") <= per_conversation)
    kept = steps.join(chosen, ["key", "leaf"]).select("key", "leaf", "rank", "node_id", (F.col("depth") - F.col("up")).alias("depth"))
    texts = tree.select("key", "conv_id", "node_id", "role", "text")
    return kept.join(texts, ["key", "node_id"]).select("conv_id", "leaf", "rank", "depth", "role", "text")


def formatted(messages: DataFrame) -> DataFrame:
    """One row per path of ``best_paths``: conv_id, leaf, rank, formatted, loss
    (array of start and end code points, end exclusive)."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    before = Window.partitionBy("conv_id", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    parts = messages.select("conv_id", "leaf", "rank", "depth", "role", head.alias("head"), body.alias("body"))
    parts = parts.withColumn("piece", F.concat("head", "body", F.lit(END)))
    parts = parts.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == "assistant", F.struct(F.col("start"), (F.col("start") + F.length("body")).alias("end")))
    rows = parts.groupBy("conv_id", "leaf", "rank").agg(
        F.array_sort(F.collect_list(F.struct("depth", "piece", span.alias("span")))).alias("turns"))
    return rows.select("conv_id", "leaf", "rank", F.array_join(F.col("turns.piece"), "").alias("formatted"),
                       F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss"))


def read_back(conversations: DataFrame) -> DataFrame:
    """Turns and loss text recovered from ``formatted`` and ``loss`` alone, as digests."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    rows = conversations.select("conv_id", "formatted", "loss", pieces.alias("pieces"))

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        at = F.locate("\n", inner)
        role = unescape_role(F.substring(inner, F.lit(1), at - 1))
        text = unescape(F.substring(inner, at + 1, F.length(inner)))
        return F.concat(role, F.lit("\n"), text, F.lit("\n"))

    def masked(span: Column) -> Column:
        return unescape(F.substring(F.col("formatted"), (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    rows = rows.select("conv_id", F.size("pieces").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(F.transform("pieces", turn), ""), 256).alias("turns_sha256"),
                       F.array_join(F.transform("loss", masked), "").alias("loss_text"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
    return rows.select("conv_id", "n_turns", "turns_sha256", F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def format_conversations(messages: DataFrame) -> DataFrame:
    """Plain conversations (conv_id, turn, role, text) formatted and kept: the
    best path of each conversation's tree."""
    tree = chain(messages).checkpoint()
    return formatted(best_paths(tree))
