"""Contiguous shards of near equal size from global prefix sums; all native."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import cut, prefix_sums

#: Bytes of a row besides its text.
OVERHEAD = 16
#: Rows of one group of equal rows that one task writes out.
CHUNK = 1 << 16


def _each_row(groups: DataFrame, chunk: int) -> DataFrame:
    """One row for each of the ``n`` rows of a group, with what lies before it."""

    def rows(df, first, last):
        return df.withColumn("_k", F.explode(F.sequence(first, last))).withColumns({
            "bytes_before": F.col("bytes_before") + F.col("_k") * F.col("size"), "rows_before": F.col("rows_before") + F.col("_k"),
        }).drop("_k", "n")

    last = F.col("n") - 1
    few = rows(groups.where(F.col("n") <= chunk), F.lit(0).cast("long"), last)
    starts = groups.where(F.col("n") > chunk).withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(chunk).cast("long"))))
    many = rows(starts.repartition("h", "_at"), F.col("_at"), F.least(last, F.col("_at") + (chunk - 1))).drop("_at")
    return few.unionByName(many)


def shard_by_bytes(docs: DataFrame, shards: int = 40, whole: float = 0.01, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs (doc_id, text)``.

    Rows are put in order of a hash of the text, then of the id, so equal texts lie together.
    Rows equal in both are counted first and placed as one, then written out in several tasks if
    they are more than ``chunk``.
    The running sum of the sizes is cut at equal targets: a row goes where its middle byte falls.
    Where a cut would split a group of equal texts whose bytes are at most ``whole`` of a shard,
    the group goes where the group's middle falls; larger groups are cut between rows, so shards
    stay equal whatever the groups.  ``slot`` counts a shard's rows from 0.

    Null texts have no bytes, the checksum of nothing (0), and form one group with empty texts;
    null ids come first in their group.  Equal rows may change places among themselves.  An empty
    table gives an empty result.  Only the two columns are read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long").alias("h"),
    )
    keys = ["h", "doc_id", "size", "text_crc32"]
    groups = cut(rows.groupBy(*keys).agg(F.count("*").alias("n")))
    total = groups.agg(F.sum(F.col("size") * F.col("n"))).first()[0] or 1
    groups = prefix_sums(groups, [F.col(k) for k in keys], {"bytes_before": F.col("size") * F.col("n"), "rows_before": F.col("n")})
    placed = _each_row(groups, chunk)

    def shard_of(start, size):
        middle = (start.cast("double") + size / 2) * F.lit(float(shards)) / F.lit(float(total))
        return F.least(F.lit(shards - 1), F.floor(middle)).cast("int")

    placed = cut(placed.withColumn("shard", shard_of(F.col("bytes_before"), F.col("size"))))
    # the groups at the cuts: at most one per shard
    firsts = placed.groupBy("shard").agg(F.min_by("h", "rows_before").alias("h")).select("h").distinct()
    groups = placed.join(F.broadcast(firsts), "h").groupBy("h").agg(
        F.min("bytes_before").alias("group_start"), F.sum("size").alias("group_size")
    )
    small = groups.where(F.col("group_size") <= F.lit(whole * total / shards)).select(
        "h", shard_of(F.col("group_start"), F.col("group_size")).alias("group_shard")
    )
    moved = placed.join(F.broadcast(small), "h", "left").withColumn("shard", F.coalesce("group_shard", "shard"))
    begins = moved.groupBy("shard").agg(F.min("rows_before").alias("begin"))
    return moved.join(F.broadcast(begins), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rows_before") - F.col("begin")).alias("slot")
    )
