"""Labelled sets: membership, differences, key buckets.

Each question is one grouped aggregate with map-side partial results, so an element that
holds a third of all rows arrives at its reducer as one small row per map task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.lambdas import computed
from tessella.functions.strings import number_key_bucket, text_key_bucket


def membership(sets: DataFrame) -> DataFrame:
    """``element, label`` from ``label, elements``."""
    return sets.select(F.explode(computed(F.col("elements"))).alias("element"), "label")


def labels_per_element(members: DataFrame) -> DataFrame:
    """``element, labels``: the distinct labels that hold each element, sorted.

    Repeats are dropped first, by a hash aggregate in the map tasks; what is left to collect
    is one row per element and label.
    """
    held = members.select("element", "label").distinct()
    return held.groupBy("element").agg(F.array_sort(F.collect_list("label")).alias("labels"))


def set_difference(members: DataFrame, label: str = "R") -> DataFrame:
    """Elements whose every occurrence has the given label; repeats collapse, NULL is an element."""
    only = F.bool_and(F.col("label").eqNullSafe(label))
    return members.groupBy("element").agg(only.alias("only")).where("only").select("element")


def set_difference_once(members: DataFrame, label: str = "R") -> DataFrame:
    """Elements that occur exactly once over all sets, in the one with the given label."""
    grouped = members.groupBy("element").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("label").eqNullSafe(label)).alias("only")
    )
    return grouped.where("n = 1 and only").select("element")


def key_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with a stable ``bucket`` in ``0 .. buckets-1`` for a text or integer key."""
    is_text = dict(df.dtypes)[key] == "string"
    make = text_key_bucket if is_text else number_key_bucket
    return df.withColumn("bucket", make(F.col(key), buckets))


def bucket_report(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``bucket, n``: rows per bucket, to see the skew a key would cause."""
    return key_bucket(df.select(key), key, buckets).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
