"""Data given in memory or drawn at random."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENTS = "doc_id bigint, text string"
SETS = "label string, elements array<string>"


def from_pairs(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """Key/value pairs from driver memory, with the schema spelled out."""
    return spark.createDataFrame(list(rows), schema)


def random_subset(spark: SparkSession, n: int, p: float, seed: int) -> DataFrame:
    """Each of ``0 .. n-1`` whose uniform draw exceeds ``p``, as column ``element``."""
    return spark.range(n).where(F.rand(seed) > p).select(F.col("id").alias("element"))


def hash_subset(df: DataFrame, key: str, p: float, seed: int) -> DataFrame:
    """Rows whose key hashes above ``p``: the same rows on every run and any partitioning.

    The draw is the first 32 bits of an md5, compared as text with a fixed-width bound.
    """
    if not 0 <= p < 1:
        raise ValueError("p must be in [0, 1)")
    bound = format(int(p * 2**32), "08x")
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.where(F.substring(digest, 1, 8) > bound)
