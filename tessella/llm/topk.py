"""Exact top-k by inner product: branch and bound over a ball tree per shard.

Shards lie together in space.  A bounded number of vectors serve as pivots, every vector belongs to
the cell of its nearest pivot, and a cell above ``shard_rows`` is dealt to several shards.  By a
query q no vector of a ball with center c and radius r scores above q.c + |q| r.  That bound is taken
for cells first, so that neither a query nor a vector travels to a shard where none of the block's
queries can find anything, then in the shard's task for the nodes of its tree: a query goes down to
its most promising leaf, after which nodes are opened in order of their bounds, each for the queries
whose current k-th score it can still reach.  The rest of a tree is never looked at.

The k-th score goes from shard to shard in waves: a query's best cell first, the next best, and
then all that are left.
"""

import heapq
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import cut

LEAF = 64
SHARD_ROWS = 16_384
QUERY_ROWS = 2_048
#: Most pivots, so most cells; their vectors go to every task.
CELLS = 256
#: The cell of vectors whose length no pivot has.
APART = -1
#: Doubles hold products and sums of scaled components below this, 64-bit integers below twice MOST.
EXACT, MOST = float(2**53), float(2**61)
#: Score of a place that is not taken.
NONE = -(2**63)


class BallTree:
    """Nodes hold consecutive rows of ``order``; ``children`` of a leaf is None."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.center, self.radius, self.span, self.children = [], [], [], []
        stack = [(0, len(x), None)]
        while stack:
            lo, hi, parent = stack.pop()
            own = x[self.order[lo:hi]]
            center = own.mean(axis=0)
            away = np.linalg.norm(own - center, axis=1)
            node = len(self.center)
            self.center.append(center), self.radius.append(float(away.max())), self.span.append((lo, hi)), self.children.append(None)
            if parent is not None:
                self.children[parent] = (*(self.children[parent] or ()), node)
            if hi - lo <= LEAF or away.max() == 0 and hi - lo <= 16 * LEAF:
                continue
            one = own[away.argmax()]
            two = own[np.linalg.norm(own - one, axis=1).argmax()]
            side = own @ (two - one)
            middle = (hi - lo) // 2
            self.order[lo:hi] = self.order[lo:hi][np.argsort(side, kind="stable")]
            stack += [(lo, lo + middle, node), (lo + middle, hi, node)]

    def bound(self, node: int, q: np.ndarray, size: np.ndarray) -> np.ndarray:
        return upper_bound(q, size, self.center[node], self.radius[node])


def upper_bound(q: np.ndarray, size: np.ndarray, center: np.ndarray, radius: float) -> np.ndarray:
    """Most that ``q`` of length ``size`` can score in a ball, with room for rounding."""
    upper = q @ center + size * radius
    return np.clip(upper + 1e-9 * (1 + size * (np.linalg.norm(center) + radius)), -(2.0**63), 2.0**63)


def _floats(x: np.ndarray) -> np.ndarray:
    """Doubles near whole numbers of any size; what no double holds comes as the largest."""
    if x.dtype != object:
        return x
    most = int(np.finfo(np.float64).max)
    return np.array([[float(max(-most, min(most, v))) for v in row] for row in x])


def _comparable(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in the narrowest type in which their products are exact."""
    if q.dtype != object and x.dtype != object:
        most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
        if most < EXACT and max(np.abs(q).max(initial=0), np.abs(x).max(initial=0)) < EXACT:
            return q, x
        if most < MOST and max(np.abs(q).max(initial=0), np.abs(x).max(initial=0)) < MOST:
            return q.astype(np.int64), x.astype(np.int64)
    whole = lambda a: np.array([[int(v) for v in row] for row in a], object).reshape(a.shape)
    return whole(q), whole(x)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products, held to 64 bits."""
    score = q @ x.T
    if score.dtype == object:
        score = np.minimum(np.maximum(score, NONE + 1), 2**63 - 1)
    return score.astype(np.int64)


def search(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """``scores, ids`` (``queries x k``) of the best rows of ``x`` scoring at least ``floor``; ties go to
    the smaller id, missing places score ``NONE``, and a row with the query's id is left out."""
    with np.errstate(over="ignore", invalid="ignore"):
        return _search(q, q_ids, floor, x, ids, k)


def _search(q, q_ids, floor, x, ids, k):
    tree = BallTree(_floats(x))
    ids = ids[tree.order]
    near, (exact_q, exact_x) = _floats(q), _comparable(q, x[tree.order])
    size = np.linalg.norm(near, axis=1)
    best = np.full((len(q), k), NONE, np.int64)
    best_ids = np.full((len(q), k), np.iinfo(np.int64).max)
    home = np.full(len(q), -1)

    def open_for(upper, rows):
        # a bound that is not a number is no bound
        return ~(upper < np.maximum(best[rows, -1], floor[rows]))

    def compare(leaf: int, rows: np.ndarray) -> None:
        lo, hi = tree.span[leaf]
        score = products(exact_q[rows], exact_x[lo:hi])
        score[(ids[lo:hi][None, :] == q_ids[rows, None]) | (score < floor[rows, None])] = NONE
        names = np.where(score == NONE, np.iinfo(np.int64).max, ids[lo:hi])
        scores, names = np.hstack([best[rows], score]), np.hstack([best_ids[rows], names])
        # largest first: the complement turns the order round without leaving 64 bits
        top = np.lexsort((names, ~scores), axis=1)[:, :k]
        best[rows], best_ids[rows] = np.take_along_axis(scores, top, 1), np.take_along_axis(names, top, 1)

    descent = [(0, np.arange(len(q)))]
    while descent:
        node, rows = descent.pop()
        if tree.children[node] is None:
            compare(node, rows)
            home[rows] = node
            continue
        one, two = tree.children[node]
        first = tree.bound(one, near[rows], size[rows]) >= tree.bound(two, near[rows], size[rows])
        descent += [(c, r) for c, r in ((one, rows[first]), (two, rows[~first])) if len(r)]

    everyone = np.arange(len(q))
    queue = [(0.0, 0, everyone, np.full(len(q), np.inf))]
    while queue:
        _, node, rows, upper = heapq.heappop(queue)
        alive = open_for(upper, rows)
        rows, upper = rows[alive], upper[alive]
        if tree.children[node] is None:
            rows = rows[home[rows] != node]
            if len(rows):
                compare(node, rows)
            continue
        for child in tree.children[node] if len(rows) else ():
            own = np.fmin(upper, tree.bound(child, near[rows], size[rows]))
            alive = open_for(own, rows)
            if alive.any():
                heapq.heappush(queue, (-float(own[alive].max()), child, rows[alive], own[alive]))
    return best, best_ids


def _scaled(column, scale: float) -> np.ndarray:
    """``floor(scale * x)`` as doubles, or as Python integers where a product is beyond doubles."""
    with np.errstate(over="ignore"):
        plain = [np.asarray(v, np.float64) for v in column.to_pylist()]
        rows = np.array([np.floor(scale * v) for v in plain]) if plain else np.zeros((0, 0))
    if np.isfinite(rows).all():
        return rows
    whole = lambda raw, v: int(v) if math.isfinite(v) else math.floor(Fraction(float(raw)) * Fraction(scale))
    return np.array([[whole(raw, v) for raw, v in zip(one, two)] for one, two in zip(plain, rows)], object)


def _task(k: int, scale: float):
    def task(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 3
        if queries.num_rows and vectors.num_rows:
            q_ids = queries.column("query_id").to_numpy()
            score, ids = search(
                _scaled(queries.column("vector"), scale), q_ids, queries.column("floor").to_numpy(),
                _scaled(vectors.column("vector"), scale), vectors.column("vec_id").to_numpy(), k,
            )
            found = score > NONE
            out = [np.broadcast_to(q_ids[:, None], score.shape)[found], ids[found], score[found]]
        return pa.table([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    return task


def _pivot_groups(pivots: list, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: numbers of the pivots and their scaled vectors."""
    groups: dict[int, list] = {}
    for cell, v in enumerate(pivots):
        groups.setdefault(len(v), []).append(cell)
    return {w: (np.array(c), _floats(_scaled(pa.array([pivots[i] for i in c]), scale))) for w, c in groups.items()}


def _in_cells(pivots: list, scale: float):
    """Each vector's nearest pivot and the distance to it."""

    def assign(batches):
        groups = _pivot_groups(pivots, scale)
        for batch in batches:
            widths = batch.column(1).to_numpy()
            cell, away = np.full(len(widths), APART), np.full(len(widths), np.inf)
            for w, (cells, centers) in groups.items():
                for at in np.array_split(np.flatnonzero(widths == w), 1 + len(widths) // 256):
                    if not len(at):
                        continue
                    with np.errstate(over="ignore", invalid="ignore"):
                        x = _floats(_scaled(batch.column(2).take(pa.array(at)), scale))
                        d = np.stack([np.linalg.norm(x - c, axis=1) for c in centers], axis=1)
                    cell[at], away[at] = cells[d.argmin(axis=1)], d.min(axis=1)
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(cell, pa.int32()), pa.array(away)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "width", "vector", "cell", "away"])

    return assign


def _cell_bounds(pivots: list, radius: dict[int, float], scale: float):
    """For each query every cell of its length, with the most it can score there and the cell's place
    in that order."""

    def bounds(batches):
        groups = _pivot_groups(pivots, scale)
        for batch in batches:
            out = []
            for i, (query, w) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                cells, centers = groups.get(w, (np.zeros(0, int), None))
                cells = [int(c) for c in cells if int(c) in radius]
                if not cells:
                    out.append((query, APART, np.inf, 0))
                    continue
                q = _floats(_scaled(batch.column(2).slice(i, 1), scale))
                with np.errstate(over="ignore", invalid="ignore"):
                    size = np.linalg.norm(q, axis=1)
                    where = {int(c): n for n, c in enumerate(groups[w][0])}
                    most = np.array([float(upper_bound(q, size, centers[where[c]], radius[c])[0]) for c in cells])
                most = np.where(np.isnan(most), np.inf, most)
                order = np.argsort(-most, kind="stable")
                out += [(query, cells[j], float(most[j]), n) for n, j in enumerate(order)]
            types = [pa.int64(), pa.int32(), pa.float64(), pa.int32()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, types)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "cell", "most", "nth"])

    return bounds


def _blocks(counts: dict[int, int], query_rows: int) -> dict[int, tuple[int, int]]:
    """By cell: the first block of its queries, and in how many they are.  Small cells share a block."""
    blocks, block, room = {}, -1, 0
    for cell, n in sorted(counts.items()):
        if n > room:
            block, room = block + 1, query_rows
        parts = -(-n // query_rows)
        blocks[cell] = (block, parts)
        block, room = block + parts - 1, room - n if parts == 1 else 0
    return blocks


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors of largest inner product for each query.

    ``vectors`` and ``queries`` are ``(vec_id, embedding)``; components x count as floor(scale * x),
    and scores are exact integers whatever the size of the components; a score beyond 64 bits counts as
    the nearest that 64 bits hold.  Ties go to the smaller id; a vector with the query's own id does
    not count.  Rows whose id or vector is null, or whose vector holds null, NaN or infinity, take no
    part.  Vectors meet queries of the same length only.  Of queries that repeat an id, one takes
    part; other rows that repeat an id each count.  Empty tables give an empty result.
    """

    single = all(dict(df.dtypes)["embedding"] == "array<float>" for df in (vectors, queries))
    kind = "array<float>" if single else "array<double>"

    def usable(df):
        bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        df = df.select("vec_id", F.col("embedding").cast(kind).alias("embedding"))
        df = df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("width"), F.col("embedding").alias("vector"))

    rows = usable(vectors)
    asked = usable(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = cut(asked.select(F.col("vec_id").alias("query_id"), F.size("vector").alias("width"), "vector"))
    shards = -(-rows.count() // shard_rows)
    if shards > 1:
        mark = F.xxhash64("vec_id", F.lit(1))
        pivots = [r.vector for r in rows.orderBy(mark, "vec_id").limit(min(CELLS, shards)).select("vector").collect()]
        held = rows.mapInArrow(_in_cells(pivots, scale), f"vec_id long, width int, vector {kind}, cell int, away double")
        held = cut(held.withColumn("pick", F.monotonically_increasing_id()))
        # a row per cell
        cells = held.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()
    else:
        pivots, cells = [], []
        held = rows.withColumns({"cell": F.lit(APART), "pick": F.lit(0).cast("long")})
    radius = {r.cell: r.radius for r in cells if r.cell != APART}
    slices = {r.cell: -(-r.n // shard_rows) for r in cells} or {APART: 1}
    of_cell = F.element_at(F.create_map(*(F.lit(v) for pair in slices.items() for v in pair)), F.col("cell"))
    held = held.select("vec_id", "width", "vector", "cell", F.pmod(F.xxhash64("pick"), of_cell).alias("slice"))

    # a query whose length no vector has keeps APART, where it meets nothing
    plan = cut(asked.mapInArrow(_cell_bounds(pivots, radius, scale), "query_id long, cell int, most double, nth int"))
    homes = plan.where("nth = 0").select("query_id", F.col("cell").alias("home"))
    blocks = _blocks({r.home: r.n for r in homes.groupBy("home").agg(F.count("*").alias("n")).collect()}, query_rows) or {APART: (0, 1)}
    first, parts = (F.element_at(F.create_map(*(F.lit(v) for c, b in blocks.items() for v in (c, b[i]))), F.col("home")) for i in (0, 1))
    asked = asked.join(homes, "query_id").withColumn("block", first + F.pmod(F.xxhash64("query_id", F.lit(2)), parts)).drop("home")
    asked = cut(asked)
    keys = ["block", "cell", "slice", "width"]
    found = None
    last = plan.agg(F.max("nth")).first()[0] or 0
    for low, high in ((0, 0), (1, 1), (2, last)):
        if low > last:
            break
        here = plan.where(F.col("nth").between(low, high))
        here = here.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(of_cell, F.lit(1)).cast("long") - 1)))
        if found is not None:
            kth = found.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"))))
            kth = kth.where(F.col("place") == k).select("query_id", F.col("score").alias("floor"))
            here = here.join(kth, "query_id", "left").where(F.col("floor").isNull() | (F.col("most") >= F.col("floor").cast("double")))
        else:
            here = here.withColumn("floor", F.lit(None).cast("long"))
        here = here.withColumn("floor", F.coalesce("floor", F.lit(NONE).cast("long")))
        questions = asked.join(here.select("query_id", "cell", "slice", "floor"), "query_id")
        # a vector travels to the blocks that still ask its shard
        wanted = questions.select(*(F.col(c).alias(f"to_{c}") for c in keys)).distinct()
        dealt = held.join(wanted, [F.col(c) == F.col(f"to_{c}") for c in ("cell", "slice", "width")])
        new = questions.groupBy(*keys).cogroup(dealt.groupBy(*(f"to_{c}" for c in keys))).applyInArrow(_task(k, scale), "query_id long, vec_id long, score long")
        found = cut(new if found is None else found.union(new))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
