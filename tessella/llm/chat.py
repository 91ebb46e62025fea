"""Chat texts from reply trees: every path from a root to a leaf is a conversation.

Paths are found by self-joins that double their reach: in round k each path is joined with the
pointers to the message 2**k replies up, and the pointers with themselves, so a tree of depth d
takes about log2(d) rounds, and only ids move.  Branches are ranked by score in their tree, and the
messages of the chosen ones are then joined in and set in a template.

The template writes a turn as ``### role: text</turn>`` and a line feed.  Inside roles and texts a
backslash is doubled, ``##`` becomes ``#\\#`` and ``</turn>`` becomes ``<\\/turn>`` (in roles also
``: `` becomes ``:\\ ``), so neither mark can occur there, and leaving out each backslash that stands
before another character gives the text back.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import BROADCAST_ROWS, many_to_one, prefix_sums, written
from tessella.operators.joins import HOT_ROWS, spread_join

HEAD, COLON, END = "### ", ": ", "</turn>\n"

#: Scores are added as decimals, so that no sum depends on the order of its rows.
SCORE = "decimal(28, 9)"


def reply_paths(replies: DataFrame, best: int | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``tree, leaf, message, place, n_messages, score, rank`` for every message of each path from
    ``replies (tree, message, parent, score)``: ``place`` counts from the root, 0 on.

    ``leaf`` names the path: a message nobody answers.  ``score`` is the sum over the path's
    messages; ``rank`` orders the paths of a tree by score, the best first, ties by the smaller
    leaf; ``best`` keeps that many of each tree.  A message without a parent, or whose parent is not in its
    tree or is itself, is a root.  Rows that repeat a message are one message, with the smallest
    parent and the sum of the scores.  A null score counts 0.  A null tree is a tree of its own and a
    null message one message of its tree, which no parent names.  Messages that only lead into a
    circle have no root and are in no path.  An empty table gives an empty result.
    """
    replies = replies.select("tree", "message", "parent", "score")
    points = F.coalesce(F.expr(f"try_cast(score AS {SCORE})"), F.lit(0).cast(SCORE))
    up = F.struct(F.col("tree"), F.col("parent").alias("message"))
    answers = F.col("parent").isNotNull() & ~F.col("parent").eqNullSafe(F.col("message"))
    nodes = replies.groupBy("tree", "message").agg(F.min("parent").alias("parent"), F.sum(points).alias("points"))
    nodes = written(nodes.select(F.struct("tree", "message").alias("node"), F.when(answers, up).alias("up"), "points"), "messages")
    above = nodes.select(F.col("node").alias("up"), F.col("points").alias("up_points"))
    pointers = written(many_to_one(nodes.where("up IS NOT NULL").select("node", "up"), above, "up", "node", broadcast_rows), "pointers")
    leaves = nodes.join(pointers.select(F.col("up").alias("node")).distinct(), "node", "left_anti")
    most = nodes.groupBy("node.tree").count().agg(F.max("count")).first()[0] or 0
    levels, reach = [], 1
    while not pointers.isEmpty():
        if reach >= most:  # a way up as long as this goes round a circle
            leaves = leaves.join(pointers.select("node"), "node", "left_anti")
            break
        levels.append(pointers)
        further = pointers.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("up_points").alias("points2"))
        pointers = many_to_one(pointers.select("node", "up"), further, "up", "node", broadcast_rows)
        pointers = written(pointers.select("node", F.col("up2").alias("up"), F.col("points2").alias("up_points")), "pointers")
        reach *= 2
    paths = written(leaves.select(F.col("node").alias("leaf"), "node", F.lit(0).alias("below"), "points"), "path")
    for k, pointers in enumerate(levels):
        step = many_to_one(paths.select("leaf", "node", "below"), pointers, "node", "leaf", broadcast_rows)
        step = step.select("leaf", F.col("up").alias("node"), (F.col("below") + (1 << k)).alias("below"), F.col("up_points").alias("points"))
        paths = paths.unionByName(written(step, "path"))
    totals = paths.groupBy("leaf").agg(F.count("*").alias("n_messages"), F.sum("points").alias("score"))
    totals = totals.select("leaf", F.col("leaf.tree").alias("tree"), "n_messages", "score")
    ranked = written(prefix_sums(totals, [F.col("tree"), F.col("score").desc(), F.col("leaf")], {"before": F.lit(1)}), "ranked")
    first = ranked.groupBy("tree").agg(F.min("before").alias("first"))
    first = first.select(F.struct("tree").alias("own"), "first")
    ranked = many_to_one(ranked.withColumn("own", F.struct("tree")), first, "own", "leaf", broadcast_rows)
    ranked = ranked.select("leaf", "n_messages", "score", (F.col("before") - F.col("first") + 1).alias("rank"))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    found = paths.select("leaf", "node", "below").join(ranked, "leaf")
    return found.select(
        F.col("leaf.tree").alias("tree"), F.col("leaf.message").alias("leaf"), F.col("node.message").alias("message"),
        (F.col("n_messages") - 1 - F.col("below")).alias("place"), "n_messages", "score", "rank",
    )


def escaped(text: Column) -> Column:
    """The text with the template's marks broken up; null counts as empty."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("##"), F.lit("#\\#")), F.lit("</turn>"), F.lit("<\\/turn>"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(COLON), F.lit(":\\ "))


def unescaped(text: Column) -> Column:
    """What :func:`escaped` and :func:`escaped_role` were given."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_paths(paths: DataFrame, messages: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``tree, leaf, rank, score, n_turns, formatted, loss_spans`` for each path of
    ``paths`` (as :func:`reply_paths` gives it), with the turns of ``messages (tree, message, role, text)``.

    Rows that repeat a message are turns of it and follow each other in the order of the turns as
    formatted.  Null roles and texts count as empty.  ``loss_spans`` holds start and end, in characters of
    ``formatted``, of each text whose role is one of ``learn``.  A path without rows in
    ``messages`` gives no row.  One conversation is put together in one task, as it is one value.
    """
    node = F.struct("tree", "message")
    turns = messages.select(node.alias("node"), "role", "text")
    path = F.struct("tree", F.col("leaf").alias("message"))
    keyed = written(paths.select(node.alias("node"), path.alias("path"), "place", "rank", "score"), "paths")
    joined = spread_join(keyed, turns, ["node"], "path", HOT_ROWS)
    head = F.concat(F.lit(HEAD), escaped_role(F.col("role")), F.lit(COLON))
    body = escaped(F.col("text"))
    loss = F.coalesce(F.col("role").isin(*learn), F.lit(False))
    laid = joined.select("path", "rank", "score", "place", F.concat(head, body, F.lit(END)).alias("piece"), F.length(head).alias("head"), F.length(body).alias("body"), loss.alias("loss"))
    ahead = Window.partitionBy("path").orderBy("place", "piece").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("piece").cast("long")).over(ahead), F.lit(0)) + F.col("head")
    spans = F.when(F.col("loss"), F.struct(F.col("start"), (F.col("start") + F.col("body")).alias("stop")))
    grouped = laid.withColumn("start", at).select("path", "rank", "score", F.struct("start", "piece").alias("turn"), spans.alias("span")).groupBy("path").agg(
        F.first("rank").alias("rank"), F.first("score").alias("score"),
        F.array_sort(F.collect_list("turn")).alias("turns"), F.array_sort(F.collect_list("span")).alias("loss_spans"),
    )
    formatted = F.array_join(F.transform("turns", lambda t: t["piece"]), "")
    return grouped.select(
        F.col("path.tree").alias("tree"), F.col("path.message").alias("leaf"), "rank", "score",
        F.size("turns").cast("long").alias("n_turns"), formatted.alias("formatted"), "loss_spans",
    )


def turns_of(formatted: Column) -> Column:
    """``array<struct<role, text>>`` read back from a formatted conversation."""
    pieces = F.split(formatted, END, -1)  # the last piece is what follows the last turn: nothing
    colon = lambda piece: F.instr(piece, COLON)
    role = lambda piece: F.substring(piece, F.lit(len(HEAD) + 1), colon(piece) - len(HEAD) - 1)
    text = lambda piece: F.substring(piece, colon(piece) + len(COLON), F.length(piece))
    read = lambda piece: F.struct(unescaped(role(piece)).alias("role"), unescaped(text(piece)).alias("text"))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), read)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, read back, with nothing between."""

    def under(texts: pa.Array, spans: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), spans.to_pylist())
        return pa.array(["".join(t[s["start"] : s["stop"]] for s in own) for t, own in pairs], pa.string())

    return unescaped(F.arrow_udf(under, "string")(formatted, spans))
