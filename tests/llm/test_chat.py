import pytest
from pyspark.sql import functions as F

from tessella.llm import chat

REPLIES = "tree string, message long, parent long, score double, text string"


def _paths(tree_rows):
    """Root-to-leaf paths by following parents one at a time."""
    rows = {(t, m): p for t, m, p, _ in tree_rows}
    up = {k: (k[0], p) for k, p in rows.items() if p is not None and (k[0], p) in rows and p != k[1]}
    out = []
    for leaf in rows.keys() - set(up.values()):
        path, seen = [leaf], {leaf}
        while path[-1] in up and up[path[-1]] not in seen:
            path.append(up[path[-1]])
            seen.add(path[-1])
        if path[-1] not in up:
            out.append((leaf[0], leaf[1], [m for _, m in reversed(path)]))
    return sorted(out, key=str)


TREES = (
    [("a", 0, None, 1.0), ("a", 1, 0, 2.0), ("a", 2, 0, 5.0), ("a", 3, 1, 1.5), ("a", 4, 1, -3.0), ("a", 5, 2, float("nan")), ("a", 6, 0, None)]
    + [("b", i, i - 1, 1.0) for i in range(100, 137)]  # a chain whose first parent is not there
    + [("b", 200 + i, 110, 0.25) for i in range(30)]  # many answers to one message
    + [("c", 1, 2, 1.0), ("c", 2, 3, 1.0), ("c", 3, 1, 1.0), ("c", 9, 1, 1.0), ("c", 7, None, 1.0)]  # a circle and what leads into it
    + [("d", 5, 5, 1.0), (None, 5, None, 1.0), (None, 6, 5, 1.0), ("e", None, 5, 2.0), ("e", 5, None, 2.0)]
)


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_paths_equal_following_parents(spark, broadcast_rows):
    replies = spark.createDataFrame(TREES, "tree string, message long, parent long, score double")
    rows = chat.reply_paths(replies, broadcast_rows=broadcast_rows).collect()
    found, rank = {}, {}
    for r in rows:
        found.setdefault((r.tree, r.leaf), []).append((r.place, r.message))
        rank[r.tree, r.leaf] = (r.rank, float(r.score))
        assert r.n_messages > r.place >= 0
    got = sorted(((t, leaf, [m for _, m in sorted(p, key=lambda x: x[0])]) for (t, leaf), p in found.items()), key=str)
    assert got == _paths(TREES)
    assert {k: v for k, v in rank.items() if k[0] == "a"} == {("a", 5): (1, 6.0), ("a", 3): (2, 4.5), ("a", 6): (3, 1.0), ("a", 4): (4, 0.0)}
    assert rank["b", 136] == (1, 37.0) and [rank["b", 200 + i][0] for i in range(30)] == list(range(2, 32))


def test_best_branches_and_spans(spark):
    texts = [(t, m, p, s, f"text {m} ### </turn>\\\\") for t, m, p, s in TREES if t == "a"]
    df = spark.createDataFrame(texts, REPLIES).withColumn("role", F.when(F.col("message") % 2 == 0, "user").otherwise("assistant"))
    chats = chat.format_paths(chat.reply_paths(df, best=2), df).collect()
    assert sorted((r.leaf, r.rank) for r in chats) == [(3, 2), (5, 1)]
    told = {m: x for _, m, _, _, x in texts}
    for r in chats:
        path = {3: [0, 1, 3], 5: [0, 2, 5]}[r.leaf]
        assert r.n_turns == 3 and r.formatted.count("</turn>\n") == 3 and r.formatted.count("### ") == 3
        spans = [r.formatted[s.start : s.stop] for s in r.loss_spans]
        assert [s.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\") for s in spans] == [told[m] for m in path if m % 2]


def test_repeated_messages_are_turns_that_follow(spark):
    rows = [("x", 0, None, 1.0, "q"), ("x", 1, 0, 1.0, "b"), ("x", 1, 0, 1.0, "a"), ("x", 1, 0, 1.0, "a")]
    df = spark.createDataFrame(rows, REPLIES).withColumn("role", F.lit("assistant"))
    out = chat.format_paths(chat.reply_paths(df), df)
    read = out.select("score", chat.turns_of(F.col("formatted")).alias("t"), chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("l")).collect()
    assert [(float(r.score), [x.text for x in r.t], r.l) for r in read] == [(4.0, ["q", "a", "a", "b"], "qaab")]


def test_empty(spark):
    df = spark.createDataFrame([], REPLIES).withColumn("role", F.lit("user"))
    assert chat.format_paths(chat.reply_paths(df), df).collect() == []
