"""Near-duplicate vectors by NN-descent.

Equal vectors are one node.  First lists of neighbours come from cells of random rotations; then
each node's neighbours, both ways, are compared with each other, which improves their lists, until few
lists change.  Edges at the threshold link nodes, also those that a list has no place for: of the
links that a comparison finds a spanning forest is kept, whatever the lists hold.  A list that is full
of links is saturated, and can have no place for a link to another class: blocks of saturated nodes
of different classes are compared exactly, but for those whose balls are too far apart.  Links inside
a class are counted exactly, block by block of it, without a row for each pair.  A sample of nodes is compared with all others;
while the recall of links is under the target, further rotations and rounds follow, and links
the audit found are kept.
"""

import logging
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import components, cut

#: Nodes of a cell, or of a block of a class, that one task compares.
CELL_ROWS = 1_024
#: An audit that finds fewer links than this goes on to ``MOST_AUDITED`` nodes.
LEAST_LINKS, MOST_AUDITED = 32, 4_096
#: A result with a lower recall is not given.
LEAST_RECALL = 0.9

log = logging.getLogger(__name__)


def _unit(column) -> np.ndarray:
    """Rows of length 1 in double precision."""
    x = np.array([np.asarray(v, np.float64) for v in column.to_pylist()])
    big = np.abs(x).max(axis=1, keepdims=True)
    x = x / big  # so squares of huge or tiny components neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(seed: int, tables: int, parts: int, width: int):
    """Cell of each vector in each table: the largest coordinates of ``parts`` random rotations."""

    def cells(batches):
        turns = [[np.linalg.qr(np.random.default_rng([seed, t, p]).normal(size=(width, width)))[0] for p in range(parts)] for t in range(tables)]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column(1))
            for t in range(tables):
                code = np.zeros(len(x), np.int64)
                for turn in turns[t]:
                    y = x @ turn
                    at = np.abs(y).argmax(axis=1)
                    code = code * (2 * width) + 2 * at + (y[np.arange(len(x)), at] > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.full(len(x), t, np.int32)), pa.array(code)], ["node", "vector", "turn", "cell"]
                )

    return cells


def _best(nodes: np.ndarray, s: np.ndarray, k: int, floor: np.ndarray | None = None):
    """``a, b, similarity`` of each row's ``k`` largest entries of ``s`` above ``floor``."""
    np.fill_diagonal(s, -2)
    k = min(k, len(nodes) - 1)
    if k < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    top = np.argpartition(-s, k - 1, axis=1)[:, :k]
    near = np.take_along_axis(s, top, 1)
    keep = near > (floor[:, None] if floor is not None else -1.5)
    return np.broadcast_to(nodes[:, None], top.shape)[keep], nodes[top][keep], near[keep]


def _forest(nodes: np.ndarray, s: np.ndarray, threshold: float):
    """``a, b, similarity`` of a spanning forest of the links in ``s``."""
    np.fill_diagonal(s, -2)
    hits = s >= threshold
    left, a, b = np.ones(len(nodes), bool), [], []
    for start in np.flatnonzero(hits.any(axis=1)):
        stack = [start] if left[start] else []
        left[start] = False
        while stack:
            at = stack.pop()
            new = np.flatnonzero(hits[at] & left)
            left[new] = False
            a += [at] * len(new)
            b += new.tolist()
            stack += new.tolist()
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    return nodes[a], nodes[b], s[a, b]


#: Rows of lists, and of links whether or not a list has a place for them.
PAIRS = "a long, b long, similarity double, kept boolean"


def _compared(nodes, s, k, threshold, floor=None):
    forest, best = _forest(nodes, s, threshold), _best(nodes, s, k, floor)
    return [(*forest, np.ones(len(forest[0]), bool)), (*best, np.zeros(len(best[0]), bool))]


def _pairs_table(parts) -> pa.Table:
    a, b, s, kept = (np.concatenate(x) for x in zip(*parts)) if parts else ([], [], [], [])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(s, pa.float64()), "kept": pa.array(kept, pa.bool_())})


def _first_lists(k: int, threshold: float):
    def lists(group: pa.Table) -> pa.Table:
        x = _unit(group.column("vector"))
        return _pairs_table(_compared(group.column("node").to_numpy(), x @ x.T, k, threshold))

    return lists


def _join_locally(k: int, threshold: float):
    """Compare the neighbours of a node with each other: a row holds them, or two blocks of them."""

    def compare(batches):
        for batch in batches:
            parts = []
            for near in batch.column(0):
                nodes, side = near.values.field("b").to_numpy(), near.values.field("side").to_numpy()
                x = _unit(near.values.field("vector"))
                s = x @ x.T
                if side.any():
                    s[side[:, None] == side[None, :]] = -2
                parts += _compared(nodes, s, k, threshold, near.values.field("kth").to_numpy())
            yield from _pairs_table(parts).to_batches()

    return compare


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each node."""
    best = pairs.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b"))
    return best.withColumn("place", place).where(F.col("place") <= k).drop("place")


def _refined(pairs: DataFrame, nodes: DataFrame, k: int, rounds: int, least_change: float, threshold: float) -> DataFrame:
    """NN-descent from ``pairs (a, b, similarity, kept)``: the better lists, and ``kept`` all links found.

    All neighbours of a node, both ways, are compared with each other, those of a hub by pairs of blocks.
    """
    vectors = nodes.select(F.col("node").alias("b"), "vector")
    n = nodes.count()
    links = [pairs.where("kept")]
    lists = cut(_top(pairs.where("not kept").drop("kept"), k))
    for _ in range(rounds):
        kth = lists.groupBy("a").agg(F.count("*").alias("n"), F.min("similarity").alias("low"))
        kth = kth.select(F.col("a").alias("b"), F.when(F.col("n") >= k, F.col("low")).otherwise(F.lit(-2.0)).alias("kth"))
        back = lists.select(F.col("b").alias("a"), F.col("a").alias("b"))
        around = cut(lists.select("a", "b").union(back).distinct())
        hubs = around.groupBy("a").agg(F.ceil(F.count("*") / CELL_ROWS).alias("blocks"))
        dealt = _block_pairs(around.join(hubs.where("blocks > 1"), "a", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))), "b")
        held = dealt.join(vectors.join(kth, "b", "left").withColumn("kth", F.coalesce("kth", F.lit(-2.0))), "b")
        groups = held.groupBy("a", "one", "two").agg(F.collect_list(F.struct("b", "kth", "vector", "side")).alias("near")).select("near")
        better = cut(groups.mapInArrow(_join_locally(k, threshold), PAIRS))
        links.append(better.where("kept"))
        new = cut(_top(lists.union(better.where("not kept").drop("kept")), k))
        changed = new.join(lists, ["a", "b"], "left_anti").count()
        lists = new
        if changed <= least_change * k * n:
            break
    return reduce(DataFrame.union, links, lists.withColumn("kept", F.lit(False)))


def _block_pairs(members: DataFrame, key: str) -> DataFrame:
    """``members`` in each pair ``one, two`` of the ``blocks`` of their group that they take part in, by
    hash of ``key``; ``side`` 0 where both are one block, else 1 or 2."""
    dealt = members.withColumn("block", F.pmod(F.xxhash64(key), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    dealt = dealt.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other"), "side": side})
    return dealt.drop("block", "blocks", "other")


def _centers(group: pa.Table) -> pa.Table:
    """The ball that holds a block's vectors: a center of length 1 and the largest angle to it."""
    x = _unit(group.column("vector"))
    center = x.mean(axis=0)
    center = center / np.linalg.norm(center) if np.linalg.norm(center) > 1e-9 else x[0]
    angle = float(np.arccos(np.clip(x @ center, -1, 1)).max())
    return pa.table({"component": group.column("component")[:1], "ball": group.column("ball")[:1], "center": pa.array([center.tolist()], pa.list_(pa.float64())), "angle": [angle]})


def _near_balls(threshold: float):
    """Pairs of balls of different classes that may hold a link."""
    most = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6

    def near(group: pa.Table) -> pa.Table:
        ball, of, side = (group.column(c).to_numpy() for c in ("ball", "component", "side"))
        x, angle = np.array(group.column("center").to_pylist()), group.column("angle").to_numpy()
        close = np.arccos(np.clip(x @ x.T, -1, 1)) <= angle[:, None] + angle[None, :] + most
        close &= (of[:, None] != of[None, :]) & (ball[:, None] < ball[None, :])
        if side.any():
            close &= side[:, None] != side[None, :]
        i, j = np.nonzero(close)
        return pa.table({"ball": ball[i], "ball2": ball[j]})

    return near


def _link_across(threshold: float):
    """One link between two balls, which joins their classes, if there is any."""

    def across(group: pa.Table) -> pa.Table:
        nodes, side, x = group.column("node").to_numpy(), group.column("side").to_numpy(), _unit(group.column("vector"))
        one, two = side == 1, side == 2
        i, j = np.nonzero(x[one] @ x[two].T >= threshold)
        return pa.table({"a": nodes[one][i[:1]], "b": nodes[two][j[:1]]})

    return across


def _links_of_saturated(lists: DataFrame, nodes: DataFrame, classes: DataFrame, k: int, threshold: float) -> DataFrame | None:
    """``a, b``: links that join the classes of nodes whose lists are full of links, exactly; None without such classes.

    A link that no list holds has both ends saturated, else a list would have a place for it.
    """
    full = lists.where(F.col("similarity") >= threshold).groupBy(F.col("a").alias("node")).count().where(F.col("count") >= k)
    members = cut(full.select("node").join(classes, "node").join(nodes.select("node", "vector"), "node"))
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / CELL_ROWS).alias("blocks"))
    if sizes.limit(2).count() < 2:
        return None
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    members = cut(members.join(sizes, "component").withColumn("ball", F.xxhash64("component", block)).drop("blocks"))
    balls = cut(members.groupBy("component", "ball").applyInArrow(_centers, "component long, ball long, center array<double>, angle double"))
    shards = -(-balls.count() // CELL_ROWS)
    dealt = _block_pairs(balls.withColumn("blocks", F.lit(shards).cast("long")), "ball")
    near = cut(dealt.groupBy("one", "two").applyInArrow(_near_balls(threshold), "ball long, ball2 long"))
    side = lambda own, n: near.select(F.col(own).alias("ball"), F.col("ball").alias("one"), F.col("ball2").alias("two"), F.lit(n).alias("side"))
    groups = side("ball", 1).union(side("ball2", 2)).join(members.drop("component"), "ball")
    return cut(groups.groupBy("one", "two").applyInArrow(_link_across(threshold), "a long, b long"))


def _links_in_class(threshold: float):
    """Links of each node with the other block of its class, each weighing its copies."""

    def count(group: pa.Table) -> pa.Table:
        nodes, side = group.column("node").to_numpy(), group.column("side").to_numpy()
        copies, x = group.column("copies").to_numpy(), _unit(group.column("vector"))
        if side.min() == side.max():
            if side[0]:
                return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
            hits = x @ x.T >= threshold
            np.fill_diagonal(hits, False)
            return pa.table({"node": nodes, "links": hits @ copies})
        one, two = side == 1, side == 2
        hits = x[one] @ x[two].T >= threshold
        return pa.table({"node": np.concatenate([nodes[one], nodes[two]]), "links": np.concatenate([hits @ copies[two], hits.T @ copies[one]])})

    return count


def _class_links(nodes: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """``node, links``: exact counts inside each class, by pairs of blocks of it."""
    sizes = classes.groupBy("component").agg(F.ceil(F.count("*") / CELL_ROWS).alias("blocks"))
    members = nodes.join(classes, "node").join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = members.select("component", "node", "copies", "vector", "block", other)
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    dealt = dealt.select(
        "component", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), side.alias("side"), "node", "copies", "vector"
    )
    counted = dealt.groupBy("component", "one", "two").applyInArrow(_links_in_class(threshold), "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def _audit(nodes: DataFrame, sample: int, seed: int, threshold: float) -> DataFrame:
    """``a, b``: links of ``sample`` nodes, drawn by hash, with all nodes."""
    drawn = nodes.orderBy(F.xxhash64("node", F.lit(seed))).limit(sample).select("node", "vector").collect()  # bounded by ``sample``
    ids = np.array([r.node for r in drawn])
    x = _unit(pa.array([r.vector for r in drawn]))

    def found(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1_024):
                part = batch.slice(i, 1_024)
                at, near = np.nonzero(_unit(part.column(1)) @ x.T >= threshold)
                own = part.column(0).to_numpy()[at]
                yield from pa.table({"a": ids[near], "b": own}).filter(pa.array(ids[near] != own)).to_batches()

    return cut(nodes.select("node", "vector").mapInArrow(found, "a long, b long"))


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, k: int = 8, tables: int = 6, rounds: int = 4, least_change: float = 0.02,
    sample: int = 256, recall: float = 0.98, tries: int = 3, seed: int = 1,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors (vec_id, embedding)``.

    Rows link when their cosine in double precision is ``threshold`` or more; no pair below it is
    linked.  Rows with equal vectors link with each other and share all links, at the cost of one.
    Vectors that are null, empty, zero or hold null, NaN or infinity link with nothing, and
    vectors link with those of their own length only; lengths are worked through one after another.
    ``component_id`` is the smallest id reachable; null ids are larger than any other.  An empty
    table gives an empty result.

    The recall of links is measured on ``sample`` nodes of each length, and on more where these have
    nearly no links.  It is logged, and below ``LEAST_RECALL`` the job stops; where not even the larger
    sample has a link it cannot be measured, which is logged too.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", "embedding").withColumn("fit", F.coalesce(fit, F.lit(False)))
    usable = rows.where("fit").withColumn("node", F.xxhash64("embedding"))
    nodes = usable.groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"), F.first("embedding").alias("vector"))
    nodes = cut(nodes.withColumn("width", F.size("vector")))
    links = cut(nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    for width in sorted(r.width for r in nodes.select("width").distinct().collect()):
        own = nodes.where(F.col("width") == width)
        links = links.union(_links_of(own, width, threshold, k, tables, rounds, least_change, sample, recall, tries, seed))
    classes = components(links)
    counts = _class_links(nodes, classes, threshold)
    placed = nodes.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component", "vector")
    lowest = placed.groupBy("class").agg(F.min("first").alias("lowest"))
    placed = placed.join(lowest, "class").join(counts, "node", "left")
    info = placed.select("node", "lowest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    keyed = rows.select("vec_id", F.when(F.col("fit"), F.xxhash64("embedding")).alias("node"))
    out = keyed.join(info, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("node").isNotNull(), F.col("lowest")).otherwise(F.col("vec_id")).alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links_of(nodes, width, threshold, k, tables, rounds, least_change, sample, recall, tries, seed) -> DataFrame:
    n = nodes.count()
    parts = max(1, int(np.ceil(np.log(max(2.0, n / 256)) / np.log(2 * width + 1))))
    truth = _audit(nodes, sample, seed, threshold)
    if sample < min(n, MOST_AUDITED) and truth.limit(LEAST_LINKS).count() < LEAST_LINKS:
        truth = _audit(nodes, MOST_AUDITED, seed, threshold)
    pairs = None
    for turn in range(tries):
        kind = dict(nodes.dtypes)["vector"]
        cells = nodes.select("node", "vector").mapInArrow(
            _cells(seed + turn, tables, parts, width), f"node long, vector {kind}, turn int, cell long"
        )
        crowd = cells.groupBy("turn", "cell").agg(F.ceil(F.count("*") / CELL_ROWS).alias("deal"))
        dealt = cells.join(crowd, ["turn", "cell"]).withColumn("deal", F.pmod(F.xxhash64("node", "turn"), F.col("deal")))
        first = cut(dealt.groupBy("turn", "cell", "deal").applyInArrow(_first_lists(k, threshold), PAIRS))
        pairs = _refined(first if pairs is None else pairs.union(first), nodes, k, rounds, least_change, threshold)
        lists = pairs.where("not kept").drop("kept")
        links = cut(pairs.where(F.col("similarity") >= threshold).select("a", "b").distinct())
        classes = components(links)
        across = _links_of_saturated(lists, nodes, classes, k, threshold)
        if across is not None:
            links = links.union(across)
            classes = components(links)
        same = truth.join(classes.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(
            classes.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left"
        )
        total, hit = same.agg(F.count("*"), F.count_if(F.col("ca") == F.col("cb"))).first()
        if hit >= recall * total:
            break
    if total:
        log.info("length %d: %d of %d links of the audited nodes were found", width, hit, total)
    else:
        log.warning("length %d: no audited node has a link, so the recall of links is not known", width)
    if hit < LEAST_RECALL * total:
        raise RuntimeError(f"of {total} links of audited nodes only {hit} were found; raise k, tables or tries")
    return links.union(truth)
