"""What several operators share: cut lineage, exact prefix sums, components, byte tables."""

import ctypes
import os
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.operators.joins import HOT_ROWS, spread_join

#: Most rows of a per-source or per-partition table that is broadcast.
BROADCAST_ROWS = 100_000

#: Edges or nodes of a graph that a task takes on at least, once their number is known.
GRAPH_ROWS = 200_000

#: The ASCII white space between words: space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    A local session that names none (tests) gets one of its own; a cluster session must name one.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = os.path.join(tempfile.gettempdir(), "tessella-shared")
        spark.conf.set("spark.checkpoint.dir", folder)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Like ``cut``, as Parquet.  The copy carries no partitioning, so that a join after it is
    shuffled on both sides, which lets adaptive execution split a hot key's rows."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Rows per Arrow batch while texts go through Python; the session's own setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else without."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def many_to_one(left: DataFrame, right: DataFrame, on: str, spread_by: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join with a ``right`` of narrow rows, one for each key: broadcast if it has at most
    ``max_rows`` rows, else shuffled, a hot key's left rows dealt by ``spread_by``."""
    if right.limit(max_rows + 1).count() <= max_rows:
        return left.join(F.broadcast(right), on)
    return spread_join(left, right, [on], spread_by, HOT_ROWS)


def learnable(doc_id: Column) -> Column:
    """Whether labels of the row may be learned: crc32 of the id as text, mod 4, is not 2.
    False for rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def prefix_sums(df: DataFrame, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """``df`` with one column per entry of ``values``: the sum of that value over all rows
    before the row in ``order``, over the whole table.

    Rows are range-partitioned by ``order`` and written; the totals of the partitions give each
    partition's offset, and a running sum inside a partition gives the rest, so no task sorts
    more than its range.  The result does not depend on where the ranges are cut.
    """
    parts = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    totals = parts.groupBy("_part").agg(*(F.sum(v).alias(f"_total_{k}") for k, v in values.items()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shuffle partition
    offsets = totals.select(
        "_part", *(F.coalesce(F.sum(f"_total_{k}").over(before), F.lit(0)).alias(f"_offset_{k}") for k in values)
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = parts.withColumns({k: F.coalesce(F.sum(v).over(inside), F.lit(0)) for k, v in values.items()})
    out = summed.join(F.broadcast(offsets), "_part")
    return out.withColumns({k: F.col(k) + F.col(f"_offset_{k}") for k in values}).drop(
        "_part", *(f"_offset_{k}" for k in values)
    )


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)`` that has an edge to another: the
    smallest node reachable.

    Each round every root joins its neighbour of lowest rank, by a hash that changes with the
    round, and edges are carried over to what the roots joined.  Equal edges meet and edges inside
    go, so the graph shrinks by a constant share a round, chains and stars alike.  A round writes
    which root joined which, one narrow table of all nodes' roots, and the edges left, and reads
    nothing older, so no plan spans rounds.  Joins are by sort and shuffle, so that nothing of
    the graph is collected to the driver for a broadcast.  As the graph shrinks, a round's steps run
    in as many tasks as its rows are worth, not in one for every shuffle partition.
    """
    cores = edges.sparkSession.sparkContext.defaultParallelism
    few = lambda df, rows: df.coalesce(max(cores, -(-rows // GRAPH_ROWS)))
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    roots, nodes = None, 0
    for turn in range(max_rounds):
        left = edges.count()
        if not left:
            break
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        both = edges.select("a", "b").union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min(rank("b")).alias("low")).select(F.col("a").alias("node"), F.least(F.col("low"), rank("a"))["id"].alias("to"))
        low = written(few(low, 2 * left), "low")
        at = lambda name, to: low.select(F.col("node").alias(name), F.col("to").alias(to)).hint("merge")  # noqa: B023, E731
        if roots is None:
            roots, nodes = low, low.count()
        else:
            moved = roots.join(at("to", "next"), "to", "left").select("node", F.coalesce("next", "to").alias("to"))
            roots = written(few(moved, nodes), "roots")
        kept = few(edges.join(at("a", "a2"), "a"), left).join(at("b", "b2"), "b").where("a2 <> b2")
        kept = kept.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct()
        edges = written(few(kept, left), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    lowest = written(few(roots.groupBy("to").agg(F.min("node").alias("component")), nodes), "lowest")
    return roots.join(lowest.hint("merge"), "to").select("node", "component")


def give_back_memory() -> None:
    """Return freed memory to the system: a worker that waits for its next task keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


# -- bytes in numpy ------------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Roller:
    """Hashes of any slice of a byte string from one pass of running sums, modulo 2**64."""

    BASE = 0x9E3779B97F4A7C15
    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)
    #: A fixed random value for each byte.
    VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

    def __init__(self, data: np.ndarray):
        n = len(data)
        cls = type(self)
        if len(cls._powers) < n + 1:
            size = max(n + 1, 1 << 16)
            for name, base in (("_powers", cls.BASE), ("_inverses", _inverse(cls.BASE))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(cls.VALUES[data] * cls._powers[:n], out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of ``data[start:end]``."""
        return mix64((self.sums[end] - self.sums[start]) * type(self)._inverses[start])

    def grams(self, k: int) -> np.ndarray:
        """Mixed hashes of every ``k`` bytes."""
        n = len(self.sums) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        return mix64((self.sums[k:] - self.sums[:-k]) * type(self)._inverses[: n - k + 1])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not ASCII white space."""
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    return turn[0::2], turn[1::2]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return _LOWER[data]


def text_arrays(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string column and the offsets of its rows (null: empty)."""
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
