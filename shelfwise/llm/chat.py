"""Formats reply trees as conversations.

Messages name their parent. The jump tables of the tree, parents at distance 1, 2, 4, ..., come from self-joins of the
one before; the score of a path is summed along them. The leaves of a tree rank by the score of their path, and the
chosen paths grow from their leaves by the same jumps, so their rows double with each join and no path is walked step
by step. Each path is one conversation.

A turn is written as ``<|im_start|>role LF text<|im_end|> LF``. In texts and roles the characters that any mark needs are
escaped: ``&`` as ``&amp;``, ``<`` as ``&lt;``, ``[`` as ``&#91;``, and in roles a line feed as ``&#10;``; so no text can close its
turn or open another, and reading back gives the same text.

Cases: a null text is empty, a null role an empty role; a null tree id is a tree of its own; a parent that is not
there, or a null one, makes a root; a null score counts as 0; equal scores rank by message id; messages in a circle
have no root and are left out; rows of a turn table that repeat are turns of their own; very long texts are formatted
whole, a conversation is one row; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.keys import number_rows
from shelfwise.session import fresh_folder, store

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# Order matters: the sign that starts an escape goes first, and comes back last.
TEXT_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ESCAPES = (*TEXT_ESCAPES, ("\n", "&#10;"))
TRAINED_ROLE = "assistant"


def escaped(text: Column, escapes: tuple = TEXT_ESCAPES) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column, escapes: tuple = TEXT_ESCAPES) -> Column:
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def linear_tree(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as messages: each turn replies to the one before.

    Turns are numbered by a range shuffle, so a long conversation is spread over tasks.
    """
    plain = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    numbered = number_rows(plain, ["conv_id", "turn", "role", "text"], "message_id")
    first = numbered.groupBy("conv_id").agg(F.min("message_id").alias("first")).withColumnRenamed("conv_id", "_conv")
    parent = F.when(F.col("message_id") > F.col("first"), F.col("message_id") - 1)
    return numbered.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        F.col("conv_id").alias("tree_id"), "message_id", parent.alias("parent_id"), "role", "text", F.lit(None).cast("double").alias("score")
    )


def chosen_paths(messages: DataFrame, paths: int = 1) -> DataFrame:
    """(leaf_id, message_id, height): the messages of the ``paths`` best root-to-leaf paths of each tree.

    ``height`` is the distance from the leaf.
    """
    spark = messages.sparkSession
    messages = messages.select("tree_id", "message_id", "parent_id", "score")
    known = messages.select(F.col("message_id").alias("parent_id"), F.lit(True).alias("there"))
    links = messages.join(known, "parent_id", "left").select(
        "tree_id", "message_id", F.when(F.col("there"), F.col("parent_id")).alias("up"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
    # jump tables: ``up`` is the message 2^k above, ``score`` the sum from here to below it
    jumps = [store(links, fresh_folder(spark, "jumps"))]
    # no path is longer than there are messages; what still goes up then goes round in a circle
    most = messages.count().bit_length()
    while len(jumps) <= most and not jumps[-1].where("up is not null").isEmpty():
        low = jumps[-1]
        high = low.select(F.col("message_id").alias("up"), F.col("up").alias("upper"), F.col("score").alias("more"))
        # only messages that still have one above them; the others are done
        doubled = low.join(high, "up").select(
            "tree_id", "message_id", F.col("upper").alias("up"), (F.col("score") + F.col("more")).alias("score")
        )
        doubled = doubled.unionByName(low.where("up is null").select("tree_id", "message_id", "up", "score"))
        jumps.append(store(doubled, fresh_folder(spark, "jumps")))
    # score is now that of the whole path to the root
    parents = links.select(F.col("up").alias("message_id")).where("message_id is not null").distinct()
    leaves = jumps[-1].where("up is null").join(parents, "message_id", "left_anti")
    best = Window.partitionBy("tree_id").orderBy(F.desc("score"), "message_id")
    leaves = leaves.withColumn("place", F.row_number().over(best)).where(F.col("place") <= paths)
    zero = F.lit(0).cast("long")
    path = store(leaves.select(F.col("message_id").alias("leaf_id"), "message_id", zero.alias("height")), fresh_folder(spark, "paths"))
    # the jump of 2^k takes the lowest 2^k messages of a path to the next 2^k
    for k, jump in enumerate(jumps[:-1]):
        above = path.join(jump.where("up is not null").select("message_id", "up"), "message_id")
        above = above.select("leaf_id", F.col("up").alias("message_id"), (F.col("height") + (1 << k)).alias("height"))
        path = store(path.unionByName(above), fresh_folder(spark, "paths"))
    return path


def formatted(messages: DataFrame, paths: int = 1) -> DataFrame:
    """tree_id, leaf_id and ``formatted`` text of every chosen path."""
    own = messages.select("tree_id", "message_id", "role", "text")
    rows = own.join(chosen_paths(messages, paths), "message_id")
    turn = F.concat(
        F.lit(OPEN),
        escaped(F.coalesce("role", F.lit("")), ROLE_ESCAPES),
        F.lit("\n"),
        escaped(F.coalesce("text", F.lit(""))),
        F.lit(CLOSE),
    )
    placed = F.struct((-F.col("height")).alias("place"), turn.alias("turn"))
    gathered = rows.groupBy("tree_id", "leaf_id").agg(F.array_sort(F.collect_list(placed)).alias("turns"))
    return gathered.select("tree_id", "leaf_id", F.array_join("turns.turn", "").alias("formatted"))


def read_back(text: Column) -> Column:
    """Array of (role, text, trained) of a formatted conversation; ``trained`` is the loss mask."""
    # an opening mark, a role up to the line feed, a text up to the closing mark
    turns = F.filter(F.split(text, r"\Q" + OPEN + r"\E"), lambda x: x != "")
    role = lambda x: unescaped(F.substring_index(x, "\n", 1), ROLE_ESCAPES)
    body = lambda x: F.substr(
        x, F.position(F.lit("\n"), x) + 1, F.length(x) - F.position(F.lit("\n"), x) - F.lit(len(CLOSE))
    )
    return F.transform(
        turns,
        lambda x: F.struct(
            role(x).alias("role"), unescaped(body(x)).alias("text"), (role(x) == TRAINED_ROLE).alias("trained")
        ),
    )


def digests(conversations: DataFrame) -> DataFrame:
    """What a reader finds in formatted conversations: turns, and text under the loss mask."""
    read = conversations.select("tree_id", "formatted", read_back(F.col("formatted")).alias("turns"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.transform(F.filter("turns", lambda t: t["trained"]), lambda t: t["text"])
    read = read.select("tree_id", "formatted", "turns", F.array_join(trained, "").alias("loss"), F.array_join(said, "").alias("said"))
    return read.select(
        F.col("tree_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
