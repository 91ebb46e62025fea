"""Similar image tiles: features, signatures, matches, ranked distances."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import reduced as V
from tessella.operators import signatures as L
from tessella.operators.tiles import features_of_scan, rejects_of_scan, scan_archives
from tessella.runtime import Stages, broadcast_if_small, save
from tessella.sources.archives import Decoder, archive_bytes, decode_tiff
from tessella.sources.rasters import scan_folder


@dataclass(frozen=True)
class Settings:
    """``m`` signature bits, bands of ``b`` bits, a basis from ``n_sample`` matched tiles.

    ``decimals`` rounds distances before they are ranked, so that equal ones tie.
    """

    m: int = 128
    b: int = 11
    n_sample: int = 10
    seed: int = 0
    scaled: bool = False
    decimals: int | None = None


def similar_tiles(
    features: DataFrame,
    candidates: Sequence | DataFrame,
    settings: Settings = Settings(),
    id_column: str = "tile_id",
    top: int | None = None,
    repeated_ids: bool = False,
    stages: Stages | None = None,
) -> DataFrame:
    """``candidate, id, distance, rank``: tiles that match a candidate, nearest first.

    ``features`` is read three times (buckets of the candidates, of all tiles, matched
    rows), so pass a cached or stored stage when it is costly.  The basis comes from z-scores but raw vectors are
    projected; ``scaled`` projects z-scores as well.

    Intermediate results belong to ``stages``, whose owner lets them go.  Without it they are let
    go here, and the result is written first, below the session's shared folder.
    """
    if stages is None:
        with Stages(features.sparkSession) as own:
            ranked = similar_tiles(features, candidates, settings, id_column, top, repeated_ids, own)
            return Stages(features.sparkSession).write(ranked, "similar-tiles")

    def buckets_of(rows: DataFrame) -> DataFrame:
        signed = L.signatures(rows, id_column, settings.m)
        return L.lsh_buckets(signed, settings.m, settings.b, id_column)

    wanted = L.candidate_frame(features, candidates, id_column)
    own = buckets_of(features.join(broadcast_if_small(wanted), id_column, "left_semi"))
    matches = stages.keep(L.similar_to(buckets_of(features), wanted, id_column, own=own))
    matched = stages.keep(V.matched_features(features, matches, id_column))
    sample = stages.keep(V.sample_rows(matched, settings.n_sample, settings.seed, id_column))
    basis = V.fit_basis(sample)
    if settings.scaled:
        scaled = V.zscore(matched, V.fit_stats(sample))
        reduced = V.project(scaled, basis, id_column, "z")
    else:
        reduced = V.project(matched, basis, id_column)
    distances = V.pair_distance(matches, reduced, id_column)
    if settings.decimals is not None:
        distances = distances.withColumn("distance", F.round("distance", settings.decimals) + F.lit(0.0))
    if repeated_ids:
        distances = V.unique_pairs(distances, id_column)
    largest = L.match_counts(matches).agg(F.max("n")).first()[0] or 0
    return V.rank_by_distance(distances, id_column, top, largest=largest)


def compare_blocks(
    features: DataFrame,
    candidates: Sequence | DataFrame,
    settings: Settings | dict[int, Settings] = Settings(),
    id_column: str = "tile_id",
    blocks: Sequence[int] = (10, 5),
    repeated_ids: bool = False,
    stages: Stages | None = None,
) -> DataFrame:
    """``block, candidate, id, distance, rank`` for features (``id, block, features``) of several block sizes."""
    results = []
    for block in blocks:
        chosen = settings[block] if isinstance(settings, dict) else settings
        own = features.where(F.col("block") == block).select(id_column, "features")
        ranked = similar_tiles(own, candidates, chosen, id_column, repeated_ids=repeated_ids, stages=stages)
        results.append(ranked.select(F.lit(block).alias("block"), "candidate", id_column, "distance", "rank"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


class ArchivesRejected(ValueError):
    """Archives of a job could not be used and nobody asked for a list of them."""


def settle_rejects(scan: DataFrame, rejects: str | None) -> None:
    """Write the scan's rejects to the folder ``rejects``; without one, any reject is an error
    that names the first ten."""
    found = rejects_of_scan(scan)
    if rejects is not None:
        save(found, rejects)
        return
    first = found.orderBy("file_name").limit(11).collect()
    if first:
        told = "; ".join(f"{r.file_name}: {r.reason}" for r in first[:10]) + ("; and more" if len(first) > 10 else "")
        raise ArchivesRejected(f"archives that cannot be used (pass rejects= for a list of all): {told}")


def similar_images(
    spark: SparkSession,
    folder: str,
    candidates: Sequence[str] | DataFrame,
    blocks: Sequence[int] = (10,),
    tile: int | None = 500,
    settings: Settings = Settings(),
    decode: Decoder | str = decode_tiff,
    suffix: str = ".tif",
    stage: str | None = None,
    compat_index: bool = False,
    rejects: str | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """The whole job from a folder of image archives.

    Features of all block sizes are made in one pass over the archives and kept: in
    ``stage`` as Parquet when a path is given, else in the cache.  Archives that cannot be
    used stop the job, unless ``rejects`` names a folder: then they are written there as
    ``file_name, reason, detail`` and the job goes on with the others.

    ``decode`` as a function has Spark read the archives, from any store it knows; as a name
    (see :mod:`tessella.sources.rasters`) they are opened where they lie.  Intermediate results are let go
    when the result is written, or belong to ``stages`` where given.
    """
    if stages is None:
        with Stages(spark) as own:
            ranked = similar_images(
                spark, folder, candidates, blocks, tile, settings, decode, suffix, stage, compat_index, rejects, own
            )
            return Stages(spark).write(ranked, "similar-images")
    if isinstance(decode, str):
        scan = scan_folder(spark, folder, blocks, tile, decode, suffix, compat_index=compat_index)
    else:
        scan = scan_archives(archive_bytes(spark, folder), blocks, tile, decode, suffix, compat_index)
    if stage:
        # rejects have no block and lie beside the features
        scan.write.mode("overwrite").partitionBy("block").parquet(stage)
        scan = spark.read.schema(scan.schema).parquet(stage)
    else:
        scan = stages.keep(scan)
    settle_rejects(scan, rejects)
    return compare_blocks(
        features_of_scan(scan), candidates, settings, blocks=blocks, repeated_ids=compat_index, stages=stages
    )
