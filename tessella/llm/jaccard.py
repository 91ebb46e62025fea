"""Exact Jaccard self-join of documents on word shingles, with signature trees.

First look.  Texts with too many shingles of their own are put aside (``_linkable_sets``).

Candidates.  Two sets with Jaccard similarity t or more differ in at most D = (1-t)/(1+t) (|x|+|y|)
members.  Sizes fall in classes whose limits grow by 1/t, so a pair lies in one class or in two
that follow each other; each document takes part at two levels, its own class and the next.  At a
level all documents split their hashes into the same number of blocks B, D + 1 and spare ones, by a
rule of the level alone.  D differences leave B - D blocks equal in both documents, and documents
that offer the same block are candidates.  Which blocks a document offers:
- blocks of two or more members;
- pairs of one-member blocks of the same range of ``RANGE`` blocks: if more equal blocks have one
  member than there are ranges, two of them share a range;
- one-member blocks alone, if B - D less its empty blocks is not above the number of ranges;
- empty blocks, if B - D is not above its empty blocks.
So no pair is missed, and one shingle of a common passage seldom makes candidates.  No pair is
emitted: a block's documents are linked to its smallest one, and the components of those links are
the clusters to compare.

Comparison.  Each document's hashes go once to its cluster (clusters over ``CLUSTER_ROWS`` are cut
into blocks by size, and a document goes to each pair of blocks whose sizes can match).  There a
signature tree holds the OR of token bitmaps and the range of sizes at each node.  Pairs of
nodes are walked from the root; a pair is left when its sizes are too far apart, when the most
members it can share are too few, or when all its documents are already linked.  What remains is
intersected exactly.  Links found are a spanning forest, so groups of copies cost a link each.

Sets are compared by 64-bit hashes of their shingles; texts are told apart by 64-bit hashes.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import Roller, broadcast_checked, components, give_back_memory, lowered, mix64, prefix_sums, small_batches, text_arrays, word_bounds, written

#: Documents, and hashes, that are compared in one task; larger clusters are cut into blocks.
CLUSTER_ROWS = 2_000
CLUSTER_HASHES = 4_000_000
#: Texts left by the first look that are broadcast, as ids; more are joined by shuffle.
LINKABLE_ROWS = 500_000
RANGE = 12
LEAF = 16
FANOUT = 8


def shingle_sets(texts, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of an Arrow column.

    A shingle is ``width`` words in a row; a text with fewer words is one shingle, and one
    without words has none.  A-Z count as a-z.
    """
    data, offsets = text_arrays(texts)
    out = []
    for i in range(len(offsets) - 1):
        own = lowered(data[offsets[i] : offsets[i + 1]])
        start, end = word_bounds(own)
        if not len(start):
            out.append(np.zeros(0, np.uint64))
            continue
        words = Roller(own).slices(start, end)
        k = min(width, len(words))
        total = np.full(len(words) - k + 1, k, np.uint64)
        for j in range(k):
            total = mix64(total ^ (words[j : len(words) - k + 1 + j] + np.uint64(j + 1)))
        out.append(np.unique(total))
    return out


class Levels:
    """The block plan for a similarity of ``share``/100 or more."""

    def __init__(self, share: int):
        self.share = share
        self.limits = [1]  # largest size of each class
        self._plans: dict[int, tuple[int, int]] = {}

    def of(self, size: int) -> int:
        """The class of a size."""
        while self.limits[-1] < size:
            self.limits.append(max(self.limits[-1] + 1, self.limits[-1] * 100 // self.share))
        return int(np.searchsorted(self.limits, size))

    def plan(self, level: int) -> tuple[int, int]:
        """Number of blocks, and of spare ones, at a level."""
        if level not in self._plans:
            while len(self.limits) <= level:
                self.of(self.limits[-1] + 1)
            largest = self.limits[level]
            differ = (100 - self.share) * 2 * largest // (100 + self.share)
            least = largest * self.share * self.share / 10_000  # the smallest documents that take part
            spare = 0
            # spares for the empty blocks, and the ranges, of nearly all of them
            while differ and spare < 2 * differ + 2:
                blocks = differ + 1 + spare
                empty = blocks * math.exp(-least / blocks)
                if spare >= empty + 3 * math.sqrt(empty) + blocks / RANGE + 2:
                    break
                spare += 1 + spare // 16
            self._plans[level] = (differ + 1 + spare, spare)
        return self._plans[level]


def block_keys(hashes: np.ndarray, levels: Levels) -> np.ndarray:
    """Keys of the blocks a document offers, at its two levels."""
    own = levels.of(len(hashes))
    out = []
    for level in (own, own + 1):
        blocks, spare = levels.plan(level)
        at = (hashes % np.uint64(blocks)).astype(np.int64)
        sums = np.zeros(blocks, np.uint64)
        np.add.at(sums, at, mix64(hashes ^ np.uint64(level + 1)))
        count = np.bincount(at, minlength=blocks)
        keys = mix64(sums + mix64(np.arange(blocks, dtype=np.uint64) * np.uint64(4099) + np.uint64(level)))
        equal = spare + 1 - int((count == 0).sum())  # of the blocks with members, at least
        ones = np.flatnonzero(count == 1)
        if equal > -(-blocks // RANGE):
            out.append(keys[count > 1])
        else:
            out.append(keys[count > 0] if equal > 0 else keys)
        pairs = [(ones[:-step], ones[step:]) for step in range(1, min(RANGE, len(ones)))]
        if pairs:
            left, right = (np.concatenate(x) for x in zip(*pairs))
            near = left // RANGE == right // RANGE
            out.append(mix64(keys[left[near]] * np.uint64(3) + keys[right[near]]))
    return np.concatenate(out)


def _sizes(width):
    @F.arrow_udf("long")
    def size_of(text: pa.Array) -> pa.Array:
        sizes = []
        for i in range(0, len(text), 500):  # the sets of a whole batch need not be held at once
            sizes += [len(s) for s in shingle_sets(text.slice(i, 500), width)]
        give_back_memory()
        return pa.array(sizes, pa.int64())

    return size_of


def _long_rows(keys: list[np.ndarray], nodes: pa.Array, name: str) -> pa.RecordBatch:
    """One row for each key with its node."""
    owner = np.repeat(nodes.to_numpy(zero_copy_only=False), [len(k) for k in keys])
    flat = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(flat), pa.array(owner, pa.int64())], [name, "node"])


def _sampled(width: int, share: int):
    """Hashes of a fixed part of all shingles: half as many again as may differ, in percent."""
    percent = np.uint64(min(100, (100 - share) * 3 // 2))

    def sampled(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                sets = shingle_sets(part.column(1), width)
                yield _long_rows([s[(s >> np.uint64(33)) % np.uint64(100) < percent] for s in sets], part.column(0), "hash")
            give_back_memory()

    return sampled


def _offers(share):
    def offers(batches):
        levels = Levels(share)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                sets = [np.frombuffer(s, np.uint64) for s in part.column(1).to_pylist()]
                yield _long_rows([block_keys(s, levels) for s in sets], part.column(0), "key")
            give_back_memory()

    return offers


def _sets(width):
    @F.arrow_udf("binary")
    def hashes(text: pa.Array) -> pa.Array:
        out = pa.array([s.tobytes() for s in shingle_sets(text, width)], pa.binary())
        give_back_memory()
        return out

    return hashes


# -- signature trees -----------------------------------------------------------------------------


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1).astype(np.int64)


class SignatureTree:
    """Nodes over documents in the given order; level 0 holds the leaves, the last level the root."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray, lo: int, hi: int):
        slack = sizes - _bits(bitmaps)  # members beyond one per bit
        cuts = list(range(lo, hi, LEAF))
        at = np.array(cuts) - lo
        self.levels = [
            {
                "map": np.bitwise_or.reduceat(bitmaps[lo:hi], at), "min": np.minimum.reduceat(sizes[lo:hi], at),
                "max": np.maximum.reduceat(sizes[lo:hi], at), "slack": np.maximum.reduceat(slack[lo:hi], at),
                "lo": np.array(cuts), "hi": np.array([*cuts[1:], hi]),
            }
        ]
        while len(self.levels[-1]["lo"]) > 1:
            below = self.levels[-1]
            at = np.arange(0, len(below["lo"]), FANOUT)
            self.levels.append(
                {
                    "map": np.bitwise_or.reduceat(below["map"], at), "min": np.minimum.reduceat(below["min"], at),
                    "max": np.maximum.reduceat(below["max"], at), "slack": np.maximum.reduceat(below["slack"], at),
                    "lo": below["lo"][at], "hi": np.array([*below["lo"][at[1:]], below["hi"][-1]]),
                }
            )

    def children(self, level: int, node: int) -> np.ndarray:
        return np.arange(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1]["lo"])))


def _possible(a: dict, i, b: dict, j, share: int) -> np.ndarray:
    """Whether nodes ``i`` of level ``a`` and ``j`` of level ``b`` may hold a linked pair."""
    sizes = (a["max"][i] * 100 >= b["min"][j] * share) & (b["max"][j] * 100 >= a["min"][i] * share)
    most = _bits(a["map"][i] & b["map"][j]) + np.minimum(a["slack"][i], b["slack"][j])
    return sizes & (most * (100 + share) >= share * (a["min"][i] + b["min"][j]))


def leaf_pairs(one: SignatureTree, two: SignatureTree, share: int, linked) -> list[tuple[int, int]]:
    """Pairs of leaves the dual walk cannot rule out.  ``linked(lo, hi, lo2, hi2)`` says whether
    all those documents are linked already."""
    same = one is two
    out, stack = [], [(len(one.levels) - 1, 0, len(two.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        if la == 0 and lb == 0:
            out.append((i, j))
            continue
        kids_a = one.children(la, i) if la >= lb and la else np.array([i])
        kids_b = two.children(lb, j) if lb >= la and lb else np.array([j])
        next_a, next_b = (la - 1 if la >= lb and la else la), (lb - 1 if lb >= la and lb else lb)
        x, y = (g.ravel() for g in np.meshgrid(kids_a, kids_b, indexing="ij"))
        if same:
            x, y = x[x <= y], y[x <= y]
        a, b = one.levels[next_a], two.levels[next_b]
        keep = _possible(a, x, b, y, share)
        for p, q in zip(x[keep].tolist(), y[keep].tolist()):
            if not linked(a["lo"][p], a["hi"][p], b["lo"][q], b["hi"][q]):
                stack.append((next_a, p, next_b, q))
    return out


def link_forest(nodes: np.ndarray, sets: list[np.ndarray], side: np.ndarray, share: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between documents of one cluster, found with signature trees.

    ``side`` 0 for a whole cluster; for two blocks 1 and 2, only pairs across them are looked at.
    Intersections are exact: 100 |x and y| >= share |x or y|.
    """
    sizes = np.array([len(s) for s in sets])
    first = np.array([int(s[0]) if len(s) else 0 for s in sets], np.uint64)  # near copies mostly share it
    order = np.lexsort((nodes, first, sizes, side))
    nodes, sizes, side = nodes[order], sizes[order], side[order]
    sets = [sets[i] for i in order]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    everything = np.concatenate(sets)
    _, codes = np.unique(everything, return_inverse=True)
    width = 1 << min(13, max(6, int(2 * max(1, np.percentile(sizes, 90))).bit_length()))
    bitmaps = np.zeros((len(sets), width // 64), np.uint64)
    spot = (everything >> np.uint64(20)) % np.uint64(width)
    owner = np.repeat(np.arange(len(sets)), sizes)
    np.bitwise_or.at(bitmaps, (owner, (spot >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (spot & np.uint64(63)))
    slack = sizes - _bits(bitmaps)
    label = np.arange(len(sets))
    forest = []

    def linked(lo, hi, lo2, hi2):
        own = label[lo]
        return bool((label[lo:hi] == own).all() and (label[lo2:hi2] == own).all())

    middle = int(np.searchsorted(side, 2))
    if side[0] == 0 or middle in (0, len(sets)):
        one = two = SignatureTree(bitmaps, sizes, 0, len(sets))
        if side[0] != 0:
            return []
    else:
        one, two = SignatureTree(bitmaps, sizes, 0, middle), SignatureTree(bitmaps, sizes, middle, len(sets))
    partners: dict[int, list[int]] = {}
    for i, j in leaf_pairs(one, two, share, linked):
        partners.setdefault(i, []).append(j)
    mark = np.zeros(int(codes.max()) + 1 if len(codes) else 1, bool)
    for i, others in sorted(partners.items()):
        spans = [np.arange(two.levels[0]["lo"][j], two.levels[0]["hi"][j]) for j in sorted(others)]
        reach = np.concatenate(spans)
        for x in range(one.levels[0]["lo"][i], one.levels[0]["hi"][i]):
            y = reach[reach > x] if one is two else reach
            y = y[label[y] != label[x]]
            y = y[(sizes[y] * 100 >= sizes[x] * share) & (sizes[x] * 100 >= sizes[y] * share)]
            most = _bits(bitmaps[y] & bitmaps[x]) + np.minimum(slack[y], slack[x])
            y = y[most * (100 + share) >= share * (sizes[x] + sizes[y])]
            if not len(y):
                continue
            mark[codes[offsets[x] : offsets[x + 1]]] = True
            for k in range(0, len(y), 256):
                z = y[k : k + 256]
                picked = np.concatenate([codes[offsets[v] : offsets[v + 1]] for v in z])
                ends = np.concatenate([[0], np.cumsum(sizes[z])])[:-1]
                common = np.add.reduceat(mark[picked].astype(np.int64), ends)
                for v in z[100 * common >= share * (sizes[x] + sizes[z] - common)].tolist():
                    if label[v] != label[x]:
                        forest.append((int(nodes[x]), int(nodes[v])))
                        label[label == label[v]] = label[x]
            mark[codes[offsets[x] : offsets[x + 1]]] = False
    return forest


def _compare(share):
    def compare(group: pa.Table) -> pa.Table:
        sets = [np.frombuffer(s, np.uint64) for s in group.column("hashes").to_pylist()]
        links = link_forest(group.column("node").to_numpy(), sets, group.column("side").to_numpy(), share)
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _placed(members: DataFrame, share: int) -> DataFrame:
    """``node, cluster, one, two, side`` from ``members (node, cluster, n)``: the groups each
    document is compared in."""
    totals = members.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("n").alias("hashes"))
    large = totals.where((F.col("rows") > CLUSTER_ROWS) | (F.col("hashes") > CLUSTER_HASHES)).select("cluster", "rows", "hashes")
    joined = members.join(large, "cluster", "left")
    zero = F.lit(0).cast("long")
    small = joined.where(F.col("rows").isNull()).select("node", "cluster", zero.alias("one"), zero.alias("two"), F.lit(0).alias("side"))
    big = joined.where(F.col("rows").isNotNull()).drop("rows", "hashes")
    if big.isEmpty():
        return small
    # blocks of a large cluster, by size: each has at most half of what a task compares
    ordered = prefix_sums(big, [F.col("cluster"), F.col("n"), F.col("node")], {"rows_before": F.lit(1), "hashes_before": F.col("n")})
    by_rows = F.floor(F.col("rows_before") / (CLUSTER_ROWS // 2)).alias("r")
    by_hashes = F.floor(F.col("hashes_before") / (CLUSTER_HASHES // 2)).alias("h")
    ordered = ordered.withColumn("slice", F.struct(by_rows, by_hashes))
    ranges = ordered.groupBy("cluster", "slice").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("rows_before").alias("block"))
    other = ranges.select("cluster", F.col("block").alias("two"), F.col("least").alias("least2"), F.col("slice").alias("slice2"))
    pairs = ranges.join(other, "cluster").where(
        (F.col("block") <= F.col("two")) & (F.col("least2") * share <= F.col("most") * 100)
    ).select("cluster", "slice", F.col("block").alias("one"), "two", "slice2")
    alone = F.col("one") == F.col("two")
    left = pairs.select("cluster", "slice", "one", "two", F.when(alone, 0).otherwise(1).alias("side"))
    right = pairs.where(~alone).select("cluster", F.col("slice2").alias("slice"), "one", "two", F.lit(2).alias("side"))
    spread = ordered.select("cluster", "slice", "node").join(left.union(right), ["cluster", "slice"])
    return small.union(spread.select("node", "cluster", F.col("one") + 1, F.col("two") + 1, "side"))


def near_duplicates(docs: DataFrame, width: int = 5, share: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_hash`` for every row of ``docs (doc_id, text)``.

    Rows link when the Jaccard similarity of their shingle sets is ``share``/100 or more, checked
    exactly over whole texts.  ``component_id`` is the smallest id reachable by links, itself
    included.  Null texts and texts without words have an empty set and link with nothing, also
    not with each other.  Rows with equal texts are one node, so copies cost nothing more; rows
    that repeat an id stay rows of their own; a null id is larger than any other.  An empty table
    gives an empty result.  Only the two columns are read.
    """
    docs = docs.select("doc_id", "text")
    node = F.xxhash64("text").alias("node")
    with small_batches(docs.sparkSession):
        rows = written(docs.select("doc_id", node, _sizes(width)(F.col("text")).alias("n_shingles")), "sizes")
        sets = _linkable_sets(docs, rows, width, share)
    offered = sets.select("node", "hashes").mapInArrow(_offers(share), "key long, node long")
    least = offered.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    # written, so that a hot key's offers are split over tasks
    stars = offered.join(written(least.select("key", "least"), "least").hint("merge"), "key").where("node <> least")
    clusters = components(stars.select(F.col("least").alias("a"), F.col("node").alias("b")))
    members = written(clusters.withColumnRenamed("component", "cluster").join(sets.select("node", "n").hint("merge"), "node").select("node", "cluster", "n"), "members")
    placed = written(_placed(members, share), "placed")
    groups = placed.join(sets.select("node", "hashes").hint("merge"), "node").select("cluster", "one", "two", "side", "node", "hashes")
    links = groups.groupBy("cluster", "one", "two").applyInArrow(_compare(share), "a long, b long")
    found = written(components(links).withColumnRenamed("component", "root"), "roots")
    rooted = rows.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = rooted.where("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("lowest"))
    lowest = written(lowest, "lowest")
    out = rooted.join(lowest, "root", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("node").alias("text_hash"))


def _linkable_sets(docs: DataFrame, rows: DataFrame, width: int, share: int) -> DataFrame:
    """``node, n, hashes`` of the different texts that may link with another text, written.

    Of a text's shingles at most a ``1 - share/100`` part can be missing from a text it links with.
    So one with more shingles than that which no other text has cannot link.  They are counted on a fixed
    sample of all shingles, which can only spare a text.  Most texts go here, with one narrow
    shuffle; a shingle of many texts is one row a task.
    """
    node = F.xxhash64("text").alias("node")
    sampled = docs.select(node, "text").mapInArrow(_sampled(width, share), "hash long, node long")
    single = sampled.groupBy("hash").agg(F.min("node").alias("node"), F.max("node").alias("most")).where("node = most")
    own = single.groupBy("node").agg(F.count("*").alias("own"))
    copies = rows.where("n_shingles > 0").groupBy("node", "doc_id").agg(F.max("n_shingles").alias("n"), F.count("*").alias("rows"))
    texts = copies.groupBy("node").agg(F.min(F.struct("doc_id", "rows")).alias("first"), F.max("n").alias("n"))
    left = texts.join(own.hint("merge"), "node", "left").where(F.coalesce("own", F.lit(0)) * 100 <= (100 - share) * F.col("n"))
    left = written(left.select(F.col("node").alias("_node"), F.col("first.doc_id").alias("_id"), F.col("first.rows").alias("_rows"), "n"), "linkable")
    same = (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    chosen = docs.select("doc_id", node, "text").join(broadcast_checked(left, LINKABLE_ROWS), same)
    sets = chosen.select("node", "n", "_rows", "text")
    if not left.where("_rows > 1").isEmpty():  # rows that repeat id and text
        sets = sets.where("_rows = 1").unionByName(sets.where("_rows > 1").dropDuplicates(["node"]))
    return written(sets.select("node", "n", _sets(width)(F.col("text")).alias("hashes")), "sets")
