"""Equi-joins that hold up when one key has a large share of the rows, on either side or both."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.runtime import BROADCAST_ROWS, cut_lineage

#: Rows of one key above which it is spread over several tasks.
HOT_ROWS = 200_000

#: Pairs of one key above which it is spread, however few rows each side has.
HOT_PAIRS = 200_000_000


def spread_join(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: str, hot_rows: int, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """Inner equi-join in which no task gets more than about ``hot_rows`` rows of a key from
    either side, nor makes more than about ``hot_pairs`` pairs of it.

    Both sides are counted by key.  A hotter key is dealt to a grid: its left rows to slices by
    a hash of ``spread_by``, its right rows to slices by a hash of all their columns, and each slice
    is repeated for every slice of the other side.  Other keys are joined as they are.
    """
    sides = dealt_sides(left, right, on, spread_by, hot_rows, hot_pairs)
    if sides is None:
        return left.join(right, on)
    return sides[0].join(sides[1], [*on, "_row", "_col"]).drop("_row", "_col")


def dealt_sides(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: str, hot_rows: int, hot_pairs: int
) -> tuple[DataFrame, DataFrame] | None:
    """Both sides with their place ``_row, _col`` in the grid of their key; None if no key is hot.

    The list of hot keys is written and broadcast.  Were there more than ``BROADCAST_ROWS`` of them, those
    with most pairs are on it.
    """
    counted = lambda df, name: df.groupBy(*on).agg(F.count(F.lit(1)).alias(name))
    counts = counted(left, "_left").join(counted(right, "_right"), on, "full")
    rows, others = F.coalesce("_left", F.lit(1)), F.coalesce("_right", F.lit(1))
    cols = F.ceil(others / F.lit(hot_rows))
    by_rows, by_pairs = F.ceil(rows / F.lit(hot_rows)), F.ceil(rows * F.ceil(others / cols) / F.lit(hot_pairs))
    hot = counts.select(*on, F.greatest(by_rows, by_pairs).cast("int").alias("_rows"), cols.cast("int").alias("_cols"), (rows.cast("double") * others).alias("_pairs"))
    hot = cut_lineage(hot.where((F.col("_rows") > 1) | (F.col("_cols") > 1)).orderBy(F.desc("_pairs")).limit(BROADCAST_ROWS).drop("_pairs"))
    if hot.isEmpty():
        return None

    def place(df: DataFrame, own: str, other: str, at: str, across: str, hashed: list[str]) -> DataFrame:
        slices, copies = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
        placed = df.join(F.broadcast(hot), on, "left").withColumn(at, F.pmod(F.hash(*hashed), slices))
        return placed.withColumn(across, F.explode(F.sequence(F.lit(0), copies - 1))).drop("_rows", "_cols")

    return (
        place(left, "_rows", "_cols", "_row", "_col", [spread_by]),
        place(right, "_cols", "_rows", "_col", "_row", right.columns),
    )
