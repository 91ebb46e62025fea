"""Statistics, a reduced basis, and ranked distances of feature vectors."""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessella.functions import vectors
from tessella.operators.joins import HOT_ROWS, spread_join
from tessella.runtime import BROADCAST_ROWS, broadcast_if_small, cut_lineage, fits_broadcast

#: Sample cells (rows times width) up to which a basis is fitted on the driver, and the most
#: cells that the driver ever holds of a Gram matrix or of the directions.
DRIVER_CELLS = 20_000_000

#: Most candidates, and most cells of their vectors or of a basis, that are broadcast.
BROADCAST_CANDIDATES = 50_000
BROADCAST_CELLS = 5_000_000

#: Rows of one candidate up to which one task ranks them.
WINDOW_ROWS = 2_000_000

#: Largest ``top`` for which Spark cuts each task's rows before a window's shuffle.
KEPT_BEFORE_SHUFFLE = 1000

#: Eigenvalues below this part of the largest one are noise.
RANK_TOLERANCE = 1e-12


@dataclass(frozen=True)
class ColumnStats:
    """Mean and population standard deviation per dimension.  As wide as one vector."""

    mean: tuple[float, ...]
    std: tuple[float, ...]

    @property
    def scale(self) -> tuple[float, ...]:
        """The standard deviation with zeros replaced by one."""
        return tuple(s or 1.0 for s in self.std)


@dataclass(frozen=True)
class Basis:
    """Directions as columns of a ``width x k`` matrix, strongest first."""

    directions: np.ndarray
    singular_values: np.ndarray


def matched_features(features: DataFrame, matches: DataFrame, id_column: str = "tile_id") -> DataFrame:
    """Features of the tiles that were matched by some candidate."""
    ids = matches.select(id_column).distinct()
    return features.join(broadcast_if_small(ids), id_column, "left_semi")


def sample_rows(df: DataFrame, n: int = 10, seed: int = 0, id_column: str = "tile_id") -> DataFrame:
    """``n`` rows without replacement, the same ones on every run; all rows if there are fewer.

    Ids are ordered by a hash of id and seed and each task offers its first ``n`` of them, counted,
    so that repeated ids fill the places of as many rows.  The rows themselves are fetched afterwards, so wide rows
    are never sorted or moved; only of an id that has more rows than places left are rows ranked, by content.
    """
    draw = F.md5(F.concat_ws(":", F.col(id_column).cast("string"), F.lit(str(seed))))
    counted = df.groupBy(id_column).agg(F.count(F.lit(1)).alias("_rows"))
    first = counted.orderBy(draw, id_column).limit(n)
    before = W.orderBy(draw, id_column).rowsBetween(W.unboundedPreceding, -1)  # of n ids at most
    places = first.withColumn("_left", F.lit(n) - F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    places = places.where("_left > 0").select(F.col(id_column).alias("_id"), "_rows", "_left")
    if n <= BROADCAST_ROWS:
        places = F.broadcast(places)
    drawn = df.join(places, F.col(id_column).eqNullSafe(F.col("_id")))
    crowded = F.col("_rows") > F.col("_left")
    whole = drawn.where(~crowded).select(*df.columns)
    content = F.xxhash64(*df.columns)
    part = drawn.where(crowded).withColumn("_nth", F.row_number().over(W.partitionBy("_id").orderBy(content)))
    return whole.unionByName(part.where(F.col("_nth") <= F.col("_left")).select(*df.columns))


# ---- statistics ---------------------------------------------------------------------


def _matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of a matrix, and where it holds a value; shorter rows end in gaps."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    flat = vectors.flatten()
    held = flat.is_valid().to_numpy(zero_copy_only=False)
    values = np.asarray(pc.fill_null(flat.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False))
    if len(values) == len(lengths) * width:
        return values.reshape(len(lengths), width), held.reshape(len(lengths), width)
    inside = np.arange(width) < lengths[:, None]
    matrix, mask = np.zeros(inside.shape), np.zeros(inside.shape, bool)
    matrix[inside], mask[inside] = values, held
    return matrix, mask


def _joined(one: tuple, two: tuple) -> tuple:
    """Counts, means and squared deviations of two sets of rows together, by pairwise updating."""
    width = max(len(one[0]), len(two[0]))
    (n1, m1, s1), (n2, m2, s2) = (tuple(np.pad(x, (0, width - len(x))) for x in part) for part in (one, two))
    n = n1 + n2
    share = n2 / np.maximum(n, 1)
    apart = m2 - m1
    return n, m1 + apart * share, s1 + s2 + apart**2 * n1 * share


_MOMENTS = "n array<double>, mean array<double>, squares array<double>"
_MOMENT_NAMES = ["n", "mean", "squares"]
_NOTHING = (np.zeros(0), np.zeros(0), np.zeros(0))


def _moment_batch(found: tuple, **more) -> pa.RecordBatch:
    lists = [pa.array([x], pa.list_(pa.float64())) for x in found]
    return pa.RecordBatch.from_arrays([*lists, *(pa.array([v]) for v in more.values())], [*_MOMENT_NAMES, *more])


def _moments_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = _NOTHING
    for batch in batches:
        matrix, mask = _matrix(batch.column(0))
        n = mask.sum(axis=0).astype(float)
        mean = np.where(mask, matrix, 0).sum(axis=0) / np.maximum(n, 1)
        squares = (np.where(mask, matrix - mean, 0) ** 2).sum(axis=0)
        total = _joined(total, (n, mean, squares))
    yield _moment_batch(total)


def _moments_of_parts(group: pa.Table) -> pa.Table:
    total = _NOTHING
    for row in zip(*(group.column(c).to_pylist() for c in _MOMENT_NAMES)):
        total = _joined(total, tuple(map(np.array, row)))
    return pa.Table.from_batches([_moment_batch(total, branch=0)])


#: Partial results that one task brings together.
BRANCHES = 64


def column_stats(df: DataFrame, column: str = "features") -> DataFrame:
    """``pos, mean, std``: mean and population standard deviation per dimension.

    Every task reads its vectors as matrices and sends one row with counts, means and squared
    deviations, which are joined pairwise, ``BRANCHES`` branches at a time.  NULLs are left out, NaN counts,
    and vectors may differ in length.
    """
    parts = df.select(F.col(column).cast("array<double>").alias("x")).mapInArrow(_moments_of_rows, _MOMENTS)
    branch = F.pmod(F.spark_partition_id(), F.lit(BRANCHES)).cast("long")
    some = parts.withColumn("branch", branch).groupBy("branch").applyInArrow(_moments_of_parts, _MOMENTS + ", branch long")
    whole = some.groupBy("branch").applyInArrow(_moments_of_parts, _MOMENTS + ", branch long")
    cells = whole.select(F.posexplode(F.arrays_zip("n", "mean", "squares")).alias("pos", "c")).where("c.n > 0")
    return cells.select("pos", "c.mean", F.sqrt(F.col("c.squares") / F.col("c.n")).alias("std"))


def fit_stats(df: DataFrame, column: str = "features") -> ColumnStats:
    """The same as driver values, one pair per dimension."""
    rows = sorted(column_stats(df, column).collect())
    return ColumnStats(tuple(r["mean"] for r in rows), tuple(r["std"] for r in rows))


def zscore(df: DataFrame, stats: ColumnStats, column: str = "features", out: str = "z") -> DataFrame:
    """``(x - mean) / std`` per dimension, with a standard deviation of zero taken as one."""
    mean, scale = vectors.vector_literal(stats.mean), vectors.vector_literal(stats.scale)
    return df.withColumn(out, vectors.standardize(F.col(column), mean, scale))


def fit_basis(sample: DataFrame, column: str = "features", k: int | None = None) -> Basis:
    """Right singular vectors of the z-scored sample; all with a singular value, or the first ``k``.

    They come from the smaller of two Gram matrices, that of the sample's rows or that of its
    columns.  A sample of at most ``DRIVER_CELLS`` cells is fitted on the driver.  Of a larger one, tall
    or wide, the tasks send partial Gram matrices, which are added up in a tree, and the driver holds
    ``min(n, width)`` squared numbers, at most ``DRIVER_CELLS``, and the directions.  Where both
    sides are larger, Spark's own SVD finds the first ``k``.
    """
    n, width = sample.agg(F.count(F.lit(1)), F.max(F.size(column))).first()
    if not n:
        raise ValueError("cannot fit a basis to an empty sample")
    if n * width <= DRIVER_CELLS:
        rows = np.array(sorted(r[0] for r in sample.select(F.col(column).cast("array<double>")).collect()))
        return basis_of_rows(rows, k)
    if min(n, width) ** 2 > DRIVER_CELLS:
        return _fit_basis_by_spark(sample, column, k or min(n, width))
    stats = fit_stats(sample, column)
    mean, scale = np.array(stats.mean), np.array(stats.scale)
    vectors = sample.select(F.col(column).cast("array<double>").alias("x"))
    if width <= n:
        singular, directions = _strongest(_gram_of_columns(vectors, mean, scale), k)
        return Basis(directions, singular)
    slices = _column_slices(vectors, width)
    singular, left = _strongest(_gram_of_rows(slices, mean, scale), k)
    if width * len(singular) > DRIVER_CELLS:
        raise ValueError(f"{len(singular)} directions of width {width} are above the driver's limit; pass a smaller k")
    return Basis(_directions(slices, mean, scale, left / singular, width), singular)


def _strongest(gram: np.ndarray, k: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and vectors from a Gram matrix, noise and all beyond the first ``k`` left out."""
    values, vectors = np.linalg.eigh(gram)
    order = np.argsort(values)[::-1]
    keep = [i for i in order if values[i] > RANK_TOLERANCE * max(values[order[0]], 0.0)][:k]
    return np.sqrt(values[keep]), vectors[:, keep]


def basis_of_rows(rows: np.ndarray, k: int | None = None) -> Basis:
    """Basis of an in-memory sample, from the smaller of its Gram matrices."""
    std = rows.std(axis=0)
    z = (rows - rows.mean(axis=0)) / np.where(std == 0, 1.0, std)
    if z.shape[1] < z.shape[0]:
        singular, directions = _strongest(z.T @ z, k)
        return Basis(directions, singular)
    singular, left = _strongest(z @ z.T, k)
    return Basis((z.T @ left) / singular, singular)


#: Columns of a wide sample that are handled together.
SLICE = 4096

_PART = "i long, branch long, v array<double>"


def _gram_rows(gram: np.ndarray, branch: int) -> pa.RecordBatch:
    n = len(gram)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), pa.array(np.full(n, branch)), pa.array(list(gram), pa.list_(pa.float64()))], ["i", "branch", "v"]
    )


def _sum_rows(group: pa.Table) -> pa.Table:
    total = sum(np.array(v) for v in group.column("v").to_pylist())
    return pa.table({"i": group.column("i")[:1], "branch": pa.array([0]), "v": pa.array([total], pa.list_(pa.float64()))})


def _summed(parts: DataFrame) -> np.ndarray:
    """Partial matrices added up row by row, in two levels; the whole on the driver."""
    some = parts.withColumn("branch", F.pmod("branch", F.lit(BRANCHES))).groupBy("i", "branch").applyInArrow(_sum_rows, _PART)
    rows = some.groupBy("i").applyInArrow(_sum_rows, _PART).collect()
    return np.array([r.v for r in sorted(rows, key=lambda r: r.i)])


def _gram_of_columns(vectors: DataFrame, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """``width x width``: every task adds up the products of its rows."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((len(mean), len(mean)))
        for batch in batches:
            z = (_matrix(batch.column(0))[0] - mean) / scale
            gram += z.T @ z
        yield _gram_rows(gram, TaskContext.get().partitionId())

    return _summed(vectors.mapInArrow(products, _PART))


def _column_slices(vectors: DataFrame, width: int) -> DataFrame:
    """``row, slice, x``: the rows cut into slices of columns.  Rows are written once, so that a task
    that is run again numbers them alike."""
    rows = cut_lineage(vectors).withColumn("row", F.monotonically_increasing_id())
    starts = F.transform(F.sequence(F.lit(0), F.lit((width - 1) // SLICE)), lambda s: F.struct(s.alias("slice"), F.slice("x", s * SLICE + 1, SLICE).alias("x")))
    return cut_lineage(rows.select("row", F.inline(starts)))


def _slice_matrix(group: pa.Table, mean: np.ndarray, scale: np.ndarray) -> tuple[int, np.ndarray]:
    """One slice of all rows, z-scored, in row order."""
    group = group.sort_by("row")
    at = group.column("slice")[0].as_py()
    own = slice(at * SLICE, (at + 1) * SLICE)
    return at, (_matrix(group.column("x").combine_chunks())[0] - mean[own]) / scale[own]


def _gram_of_rows(slices: DataFrame, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """``n x n``: the products of the rows, slice of columns by slice."""

    def products(group: pa.Table) -> pa.Table:
        at, z = _slice_matrix(group, mean, scale)
        return pa.Table.from_batches([_gram_rows(z @ z.T, at)])

    return _summed(slices.groupBy("slice").applyInArrow(products, _PART))


def _directions(slices: DataFrame, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, width: int) -> np.ndarray:
    """The rows combined by ``weights (n x k)``: ``width x k``."""

    def combine(group: pa.Table) -> pa.Table:
        at, z = _slice_matrix(group, mean, scale)
        return pa.table({"slice": pa.array([at], pa.int64()), "v": pa.array([(z.T @ weights).tobytes()], pa.binary())})

    found = slices.groupBy("slice").applyInArrow(combine, "slice long, v binary").collect()
    pieces = [np.frombuffer(r.v).reshape(-1, weights.shape[1]) for r in sorted(found, key=lambda r: r.slice)]
    return np.concatenate(pieces)[:width]


def _fit_basis_by_spark(sample: DataFrame, column: str, k: int) -> Basis:
    """The same by a distributed SVD; pass a ``k`` well below the width for wide vectors."""
    scaled = zscore(sample, fit_stats(sample, column), column)
    rows = MLUtils.convertVectorColumnsFromML(scaled.select(array_to_vector("z").alias("v")), "v")
    found = RowMatrix(rows).computeSVD(k, computeU=False, rCond=RANK_TOLERANCE**0.5)
    return Basis(found.V.toArray(), found.s.toArray())


def project(
    features: DataFrame,
    basis: Basis | np.ndarray,
    id_column: str = "tile_id",
    column: str = "features",
    out: str = "z",
) -> DataFrame:
    """``id, z``: coordinates of raw vectors in the basis, one matrix product per Arrow batch.

    A basis of at most ``BROADCAST_CELLS`` numbers is broadcast.  A larger one is cut into blocks of
    rows of that size; the vectors are cut alike and meet them by block, and the partial coordinates of
    a vector are added up.
    """
    matrix = np.asarray(basis.directions if isinstance(basis, Basis) else basis, dtype=np.float64)
    if matrix.size > BROADCAST_CELLS:
        return _project_by_blocks(features, matrix, id_column, column, out)
    shared = features.sparkSession.sparkContext.broadcast(matrix)
    kind = features.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, k = shared.value.shape
        for batch in batches:
            rows = batch.column(column).flatten().to_numpy(zero_copy_only=False)
            z = rows.reshape(batch.num_rows, width).astype(np.float64) @ shared.value
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * k)
            lists = pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(id_column), lists], [id_column, out])

    return features.select(id_column, column).mapInArrow(run, f"`{id_column}` {kind}, `{out}` array<double>")


def _project_by_blocks(features: DataFrame, matrix: np.ndarray, id_column: str, column: str, out: str) -> DataFrame:
    width, k = matrix.shape
    step = max(1, BROADCAST_CELLS // k)
    blocks = [(b, matrix[b * step : (b + 1) * step].tobytes()) for b in range(-(-width // step))]
    spark = features.sparkSession
    # each block is a task's own row of data: nothing is sent to all
    basis = spark.createDataFrame(blocks, "block int, directions binary").repartition(len(blocks), "block")
    # rows may repeat an id: they are numbered, and written first, so that numbers hold when a task is run again
    rows = cut_lineage(features.select(F.col(id_column).alias("id"), F.col(column).cast("array<double>").alias("x")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(len(blocks) - 1)),
        lambda b: F.struct(b.alias("block"), F.slice("x", b * step + 1, step).alias("x")),
    )
    cut = rows.select("id", "row", F.inline(pieces))

    def multiply(vectors: pa.Table, directions: pa.Table) -> pa.Table:
        own = np.frombuffer(directions.column("directions")[0].as_py()).reshape(-1, k)
        z = _matrix(vectors.column("x").combine_chunks())[0] @ own if vectors.num_rows else np.zeros((0, k))
        return pa.table([vectors.column("id"), vectors.column("row"), pa.array(list(z), pa.list_(pa.float64()))], ["id", "row", "z"])

    kind = features.schema[id_column].dataType.simpleString()
    # vectors of one block are dealt to as many tasks as there are partitions, each with a copy of the block
    deals = max(1, rows.rdd.getNumPartitions())
    dealt = cut.withColumn("deal", F.pmod(F.hash("row"), F.lit(deals)))
    copies = basis.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    parts = dealt.groupBy("block", "deal").cogroup(copies.groupBy("block", "deal")).applyInArrow(
        multiply, f"id {kind}, row long, z array<double>"
    )
    total = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.aggregate("parts", F.lit(0.0), lambda s, p: s + F.get(p, i)))
    summed = parts.groupBy("id", "row").agg(F.collect_list("z").alias("parts"))
    return summed.select(F.col("id").alias(id_column), total.alias(out))


def pair_distance(
    matches: DataFrame, reduced: DataFrame, id_column: str = "tile_id", column: str = "z"
) -> DataFrame:
    """``candidate, id, distance`` for the matched pairs only.

    The candidates' own vectors are joined to the pairs by candidate.  There are few of
    them as a rule: their number and width are checked and they are broadcast.  Otherwise a
    candidate with many matches is spread over several tasks.
    """
    z = reduced.select(id_column, F.col(column).alias("z"))
    wanted = matches.select(F.col("candidate").alias(id_column)).distinct()
    few = fits_broadcast(wanted, BROADCAST_CANDIDATES)
    own = z.join(F.broadcast(wanted) if few else wanted, id_column, "left_semi")
    own = own.select(F.col(id_column).alias("candidate"), F.col("z").alias("z0"))
    few = few and (own.agg(F.sum(F.size("z0"))).first()[0] or 0) <= BROADCAST_CELLS
    pairs = matches.select("candidate", id_column).join(z, id_column)
    if few:
        pairs = pairs.join(F.broadcast(own), "candidate")
    else:
        pairs = spread_join(pairs, own, ["candidate"], id_column, HOT_ROWS)
    return pairs.select("candidate", id_column, vectors.euclidean(F.col("z"), F.col("z0")).alias("distance"))


def unique_pairs(distances: DataFrame, id_column: str = "tile_id") -> DataFrame:
    """One row per (candidate, id), the nearest; needed only where tile ids repeat."""
    return distances.groupBy("candidate", id_column).agg(F.min("distance").alias("distance"))


def rank_by_distance(
    distances: DataFrame,
    id_column: str = "tile_id",
    top: int | None = None,
    window_rows: int = WINDOW_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """``candidate, id, distance, rank``: nearest first, ties by id.

    With ``top`` of at most ``KEPT_BEFORE_SHUFFLE`` each task keeps its own first rows per candidate before
    the shuffle.  Without it, or with more, candidates with more than ``window_rows`` rows are ranked by a
    range-partitioned sort instead of a window in one task.  ``largest`` is the number of
    rows of the largest candidate where the caller knows it, else it is counted.
    """
    order = ["distance", id_column]
    nearest = W.partitionBy("candidate").orderBy(*order)
    best = F.lit(True) if top is None else F.col("rank") <= top
    if top is not None and top <= KEPT_BEFORE_SHUFFLE:
        return distances.withColumn("rank", F.row_number().over(nearest)).where(best)
    if largest is None:
        sizes = distances.groupBy("candidate").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest <= window_rows:
        return distances.withColumn("rank", F.row_number().over(nearest)).where(best)
    return rank_by_ranges(distances, "candidate", order).where(best)


def rank_by_ranges(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rank`` within ``group`` without bringing a group together.

    Rows are range-partitioned by group and order, numbered within each range, and every
    range then starts where the ones before it end.  ``order`` must be unique per group.
    The rows are written before they are sampled for range bounds and again once numbered,
    so a task that is run again sees the same values and the same bounds.
    """
    ranged = cut_lineage(df).repartitionByRange(group, *order).withColumn("range", F.spark_partition_id())
    piece = W.partitionBy(group, "range").orderBy(*order)
    numbered = cut_lineage(ranged.withColumn("place", F.row_number().over(piece)))
    sizes = numbered.groupBy(group, "range").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy(group).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(group, "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    joined = numbered.join(broadcast_if_small(starts), [group, "range"])
    return joined.withColumn("rank", (F.col("start") + F.col("place")).cast("int")).drop("start", "place", "range")
