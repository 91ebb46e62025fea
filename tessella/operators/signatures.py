"""Hashed signatures, banding, and tiles that share a band with a candidate."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import hashing
from tessella.operators.joins import HOT_ROWS, spread_join
from tessella.runtime import fits_broadcast

#: Most candidates whose buckets are broadcast.
BROADCAST_CANDIDATES = 10_000


def signatures(
    features: DataFrame, id_column: str = "tile_id", m: int = 128, cover_tail: bool = False
) -> DataFrame:
    """``id, bits``."""
    return features.select(id_column, hashing.signature(F.col("features"), m, cover_tail).alias("bits"))


def buckets_per_tile(signed: DataFrame, m: int = 128, b: int = 11, id_column: str = "tile_id") -> DataFrame:
    """``id, buckets``: all (band, bucket) pairs of a tile in one array."""
    return signed.select(id_column, hashing.band_buckets(F.col("bits"), m, b).alias("buckets"))


def lsh_buckets(signed: DataFrame, m: int = 128, b: int = 11, id_column: str = "tile_id") -> DataFrame:
    """``id, band, bucket``: one row per band."""
    return signed.select(id_column, F.inline(hashing.band_buckets(F.col("bits"), m, b)))


def candidate_frame(buckets: DataFrame, candidates: Sequence | DataFrame, id_column: str) -> DataFrame:
    """Candidates as a one-column DataFrame named like the id."""
    if isinstance(candidates, DataFrame):
        return candidates.select(F.col(candidates.columns[0]).alias(id_column)).distinct()
    kind = dict(buckets.dtypes)[id_column]
    rows = [(c,) for c in dict.fromkeys(candidates)]
    return buckets.sparkSession.createDataFrame(rows, f"{id_column} {kind}")


def similar_to(
    buckets: DataFrame,
    candidates: Sequence | DataFrame,
    id_column: str = "tile_id",
    max_broadcast: int = BROADCAST_CANDIDATES,
    hot_rows: int = HOT_ROWS,
    own: DataFrame | None = None,
) -> DataFrame:
    """``candidate, id``: tiles that share at least one (band, bucket) with a candidate.

    One equi-join for all candidates; a candidate matches itself.  Few candidates are
    broadcast, so the tiles are never shuffled by bucket and a bucket that holds a third
    of them costs nothing extra.  Many candidates are joined by shuffle with hot buckets
    spread out, see :func:`tessella.operators.joins.spread_join`.  ``own`` holds the
    candidates' buckets where the caller has made them from the candidates alone, which
    spares hashing all tiles a second time.
    """
    wanted = candidate_frame(buckets, candidates, id_column)
    few = fits_broadcast(wanted, max_broadcast)
    if own is None:
        own = buckets.join(F.broadcast(wanted) if few else wanted, id_column, "left_semi")
    own = own.withColumnRenamed(id_column, "candidate")
    if few:
        joined = buckets.join(F.broadcast(own), ["band", "bucket"])
    else:
        joined = spread_join(buckets, own, ["band", "bucket"], id_column, hot_rows)
    return joined.select("candidate", id_column).distinct()


def matched_any(matches: DataFrame, id_column: str = "tile_id") -> DataFrame:
    """Tiles matched by at least one candidate."""
    return matches.select(id_column).distinct()


def match_counts(matches: DataFrame) -> DataFrame:
    """``candidate, n``."""
    return matches.groupBy("candidate").agg(F.count(F.lit(1)).alias("n"))


def band_sweep(
    signed: DataFrame, candidates: Sequence | DataFrame, bands: Sequence[int], m: int, id_column: str = "tile_id"
) -> DataFrame:
    """``b, candidate, n``: matches per candidate for several band sizes, to choose one.

    All sizes are bucketed in one pass and joined at once.
    """

    def sized_buckets(b: int) -> Column:
        def entry(x: Column) -> Column:
            return F.struct(F.lit(b).alias("b"), x["band"].alias("band"), x["bucket"].alias("bucket"))

        return F.transform(hashing.band_buckets(F.col("bits"), m, b), entry)

    per_size = F.array(*(sized_buckets(b) for b in bands))
    sized = signed.select(id_column, F.inline(F.flatten(per_size)))
    wanted = candidate_frame(signed, candidates, id_column)
    few = fits_broadcast(wanted, BROADCAST_CANDIDATES)
    own = sized.join(F.broadcast(wanted) if few else wanted, id_column, "left_semi")
    own = own.withColumnRenamed(id_column, "candidate")
    keys = ["b", "band", "bucket"]
    if few:
        joined = sized.join(F.broadcast(own), keys)
    else:
        joined = spread_join(sized, own, keys, id_column, HOT_ROWS)
    pairs = joined.select("b", "candidate", id_column).distinct()
    return pairs.groupBy("b", "candidate").agg(F.count(F.lit(1)).alias("n"))
