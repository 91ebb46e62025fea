"""The registered queries: each takes ``(spark, sf_dir)`` and reads whole tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import grids, markup, strings
from tessella.functions.lambdas import computed
from tessella.operators import keyed_jobs, lifted
from tessella.operators import posts as P
from tessella.operators import reduced as V
from tessella.operators import sets as E
from tessella.operators import signatures as L
from tessella.operators import text as T
from tessella.operators import tiles as R
from tessella.plans import tables as D
from tessella.plans.blog import industry_mentions
from tessella.plans.images import Settings, compare_blocks, similar_tiles
from tessella.runtime import Stages, cache_stage
from tessella.sources import archives as A
from tessella.sources.memory import hash_subset

Query = Callable[[SparkSession, str], DataFrame]


def _text(values: Column, separator: str = ",") -> Column:
    return F.array_join(values.cast("array<string>"), separator)


def _r6(x: Column) -> Column:
    """Six places, with no negative zero."""
    return F.round(x, 6) + F.lit(0.0)


# ---- text and keys -----------------------------------------------------------------


def tokens(spark, sf):
    return T.tokenize(D.docs(spark, sf), "text", "doc_id")


def word_count(spark, sf):
    return T.word_count(D.docs(spark, sf))


def term_frequency(spark, sf):
    return T.term_frequency(D.docs(spark, sf))


def word_count_from_tf(spark, sf):
    return T.sum_partials(T.term_frequency(D.docs(spark, sf)))


def map_reduce_word_count(spark, sf):
    def count_words(_doc_id, text):
        counts = {}
        for word in text.lower().split():
            counts[word] = counts.get(word, 0) + 1
        return counts.items()

    return keyed_jobs.map_reduce(
        D.docs(spark, sf).select("doc_id", "text"),
        count_words,
        combine_fn=lambda _word, ns: [sum(ns)],
        reduce_fn=lambda word, ns: (word, sum(ns)),
        pair_schema="word string, n bigint",
        out_schema="word string, n bigint",
    )


def map_reduce_set_difference(spark, sf):
    return keyed_jobs.map_reduce(
        D.word_sets(spark, sf),
        lambda label, elements: [(element, label) for element in elements],
        combine_fn=lambda _element, labels: labels[:2],
        reduce_fn=lambda element, labels: (element,) if labels == ["R"] else None,
        pair_schema="element string, label string",
        out_schema="element string",
    )


def key_bucket_report(spark, sf):
    words = E.bucket_report(T.folded_tokens(D.docs(spark, sf)), "word", 3)
    ids = E.bucket_report(D.docs(spark, sf), "doc_id", 7)
    return words.select(F.lit("word").alias("key"), "bucket", "n").unionByName(
        ids.select(F.lit("doc_id").alias("key"), "bucket", "n")
    )


def bernoulli_subset(spark, sf):
    r = D.table(spark, sf, "customer").select(F.lit("R").alias("label"), F.col("c_custkey").alias("element"))
    s = D.table(spark, sf, "orders").select(F.lit("S").alias("label"), F.col("o_orderkey").alias("element"))
    return hash_subset(r, "element", 0.5, 7).unionByName(hash_subset(s, "element", 0.75, 7))


def path_basename(spark, sf):
    pages = D.table(spark, sf, "pages")
    return pages.select("page_id", strings.base_name(F.col("url")).alias("base_name"))


def name_field(spark, sf):
    return D.blog_files(spark, sf).select("file_name", strings.file_field(F.col("file_name"), 3).alias("field"))


def vocabulary_distinct(spark, sf):
    return T.vocabulary(D.blog_files(spark, sf))


# ---- sets --------------------------------------------------------------------------


def set_membership(spark, sf):
    return E.membership(D.word_sets(spark, sf))


def labels_per_element(spark, sf):
    held = E.labels_per_element(E.membership(D.word_sets(spark, sf)))
    return held.select("element", _text(F.col("labels")).alias("labels"))


def set_difference(spark, sf):
    return E.set_difference(D.key_sets(spark, sf))


def set_difference_words(spark, sf):
    return E.set_difference(E.membership(D.word_sets(spark, sf)))


def set_difference_once(spark, sf):
    return E.set_difference_once(E.membership(D.word_sets(spark, sf)))


# ---- posts -------------------------------------------------------------------------


def split_records(spark, sf):
    return P.split_records(D.table(spark, sf, "pages"), "html", "</p>", "page_id")


def strip_markup(spark, sf):
    parts = P.split_records(D.table(spark, sf, "pages"), "html", "</p>", "page_id")
    return parts.select("page_id", markup.strip_open_tag(F.col("part"), "p").alias("part"))


def strip_line_ends(spark, sf):
    with_crlf = F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n"))
    return D.docs(spark, sf).select("doc_id", markup.strip_crlf(with_crlf).alias("text"))


def post_fields(spark, sf):
    month = markup.year_month(F.col("year"), F.col("month")).alias("year_month")
    return P.posts(D.blog_content(spark, sf)).select("*", month)


def rejected_posts(spark, sf):
    return P.rejected_posts(D.blog_content(spark, sf))


def term_mentions(spark, sf):
    return P.term_mentions(D.posts_source(spark, sf), T.vocabulary(D.blog_files(spark, sf)))


def months_per_term(spark, sf):
    grouped = P.months_per_term(term_mentions(spark, sf))
    entry = F.transform("months", lambda m: F.concat(m["year_month"], F.lit("="), m["n"].cast("string")))
    return grouped.select("term", F.array_join(entry, ";").alias("months"))


def blog_industry_mentions(spark, sf):
    return industry_mentions(D.blog_content(spark, sf), D.blog_files(spark, sf))


# ---- tiles and features ------------------------------------------------------------


def _tiles(spark, sf):
    return R.tile_grid(D.gray8(spark, sf), "vec_id", D.SIDE, D.SIDE, 4)


def tile_grid(spark, sf):
    cut = _tiles(spark, sf)
    return cut.select("image", "row", "col", "tile_id", _text(F.col("v")).alias("cells"))


def tile_ids(spark, sf):
    tile = F.col("tile_id")
    return _tiles(spark, sf).select(
        "tile_id", strings.tile_image(tile).alias("image"), strings.tile_index(tile).alias("index")
    )


def select_tiles(spark, sf):
    corner = F.explode(F.array(F.lit(0), F.lit(3)))
    listed = D.exemplars(spark, sf).select(F.col("vec_id").cast("string").alias("image"), corner.alias("i"))
    ids = listed.select(strings.tile_id(F.col("image"), F.col("i")).alias("tile_id"))
    return R.select_tiles(_tiles(spark, sf), ids).select("tile_id", _text(F.col("v")).alias("cells"))


def pixel_at(spark, sf):
    return R.cell_at(_tiles(spark, sf), 4, 0, 0)


def _cells(df, values, name):
    return df.select("vec_id", F.posexplode(computed(values)).alias("pos", name))


def intensity(spark, sf):
    return _cells(D.intensity4(spark, sf), F.col("v"), "v")


def block_mean(spark, sf):
    return _cells(D.gray8(spark, sf), grids.block_mean(F.col("v"), D.SIDE, D.SIDE, 2), "v")


def row_diff_sign(spark, sf):
    return _cells(D.gray8(spark, sf), grids.row_diff_sign(F.col("v"), D.SIDE, D.SIDE), "s")


def col_diff_sign(spark, sf):
    return _cells(D.gray8(spark, sf), grids.col_diff_sign(F.col("v"), D.SIDE, D.SIDE), "s")


def lifted_sign(spark, sf):
    def sign(x):
        return 1 if x > 1 else -1 if x < -1 else 0

    gray = D.gray8(spark, sf).select("vec_id", grids.row_diff(F.col("v"), D.SIDE, D.SIDE).alias("d"))
    return _cells(lifted.lift_over_arrays(gray, "d", sign, "tinyint"), F.col("d"), "s")


def tile_features(spark, sf):
    return D.feat(spark, sf).select("vec_id", _text(F.col("features")).alias("features"))


def reduced_features(spark, sf):
    return D.feat(spark, sf, 2).select("vec_id", _text(F.col("features")).alias("features"))


def feature_lengths(spark, sf):
    return R.feature_lengths(D.feat(spark, sf))


def _scan(spark, sf):
    return R.scan_archives(D.archives(spark, sf), blocks=(1, 2), tile=2, decode=A.decode_npy, suffix=".npy")


def archive_features(spark, sf):
    found = R.features_of_scan(_scan(spark, sf))
    return found.select("tile_id", "block", _text(F.col("features")).alias("features"))


def archive_rejects(spark, sf):
    return R.rejects_of_scan(_scan(spark, sf)).select("file_name", "reason")


def _raster_tiles(spark, sf):
    rasters = A.read_rasters(D.archives(spark, sf), A.decode_npy, ".npy")
    return R.tile_raster(rasters, 2, rejects=True)


def raster_tiles(spark, sf):
    cells = F.lower(F.hex("pixels")).alias("cells")
    return _raster_tiles(spark, sf).select("image", "row", "col", "tile_id", "height", "width", "channels", cells, "reason")


def raster_pixels(spark, sf):
    tiles = _raster_tiles(spark, sf).where("reason IS NULL")
    return R.pixel_at(tiles, 1, 0).select("tile_id", _text(F.col("pixel")).alias("pixel"))


# ---- signatures and matches --------------------------------------------------------


def _signed(spark, sf):
    return L.signatures(D.feat(spark, sf), "vec_id", D.FEAT_M)


def _buckets(spark, sf):
    return L.lsh_buckets(_signed(spark, sf), D.FEAT_M, D.FEAT_B, "vec_id")


def _matches(spark, sf):
    return L.similar_to(_buckets(spark, sf), D.exemplars(spark, sf), "vec_id")


def signature_bits(spark, sf):
    return _signed(spark, sf).select("vec_id", _text(F.col("bits"), "").alias("bits"))


def signature_bits_divisible(spark, sf):
    """Sixteen bits of 112 features: chunks of seven, none shared."""
    signed = L.signatures(D.feat(spark, sf), "vec_id", 16)
    return signed.select("vec_id", _text(F.col("bits"), "").alias("bits"))


def lsh_buckets(spark, sf):
    return _buckets(spark, sf)


def buckets_per_tile(spark, sf):
    held = L.buckets_per_tile(_signed(spark, sf), D.FEAT_M, D.FEAT_B, "vec_id")
    entry = F.transform("buckets", lambda x: F.concat_ws(":", x["band"].cast("string"), x["bucket"].cast("string")))
    return held.select("vec_id", F.array_join(entry, ";").alias("buckets"))


def lsh_matches(spark, sf):
    return _matches(spark, sf)


def matched_any(spark, sf):
    return L.matched_any(_matches(spark, sf), "vec_id")


def lsh_match_counts(spark, sf):
    return L.match_counts(_matches(spark, sf))


def lsh_band_sweep(spark, sf):
    return L.band_sweep(_signed(spark, sf), D.exemplars(spark, sf), [6, 8, 10], D.FEAT_M, "vec_id")


# ---- reduced space -----------------------------------------------------------------


def matched_features(spark, sf):
    kept = V.matched_features(D.feat(spark, sf), _matches(spark, sf), "vec_id")
    return kept.select("vec_id", _text(F.col("features")).alias("features"))


def sample_rows(spark, sf):
    drawn = V.sample_rows(D.feat(spark, sf), 10, 7, "vec_id")
    return drawn.select("vec_id", _text(F.col("features")).alias("features"))


def column_stats(spark, sf):
    stats = V.column_stats(D.table(spark, sf, "embeddings"), "embedding")
    return stats.select("pos", _r6(F.col("mean")).alias("mean"), _r6(F.col("std")).alias("std"))


def zscore(spark, sf):
    vectors = D.table(spark, sf, "embeddings").select("vec_id", "embedding")
    scaled = V.zscore(vectors, V.fit_stats(vectors, "embedding"), "embedding")
    return _cells(scaled, F.col("z"), "z").withColumn("z", _r6(F.col("z")))


def project_fixed_basis(spark, sf):
    reduced = V.project(D.feat(spark, sf), D.fixed_basis(112, 4), "vec_id")
    return _cells(reduced, F.col("z"), "z").withColumn("z", _r6(F.col("z")))


def _distances(spark, sf):
    vectors = D.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("z"))
    found = V.pair_distance(cache_stage(_matches(spark, sf)), vectors, "vec_id")
    return found.withColumn("distance", _r6(F.col("distance")))


def pair_distance(spark, sf):
    return _distances(spark, sf)


def ranked_neighbours(spark, sf):
    return V.rank_by_distance(_distances(spark, sf), "vec_id")


def nearest_neighbours(spark, sf):
    return V.rank_by_distance(_distances(spark, sf), "vec_id", top=5)


#: Distances tie when equal to six places, so that equal vectors do whatever their rounding errors.
_SETTINGS = Settings(m=D.FEAT_M, b=D.FEAT_B, decimals=6)


def similar_images(spark, sf):
    with Stages(spark) as stages:
        return similar_tiles(stages.keep(D.feat(spark, sf)), D.exemplars(spark, sf), _SETTINGS, "vec_id")


def similar_images_by_block(spark, sf):
    sized = [D.feat(spark, sf, k).withColumn("block", F.lit(k)) for k in (1, 2)]
    chosen = {1: _SETTINGS, 2: Settings(m=16, b=8, decimals=6)}
    with Stages(spark) as stages:
        features = stages.keep(sized[0].unionByName(sized[1]))
        return compare_blocks(features, D.exemplars(spark, sf), chosen, "vec_id", (1, 2))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        tokens, word_count, term_frequency, word_count_from_tf, map_reduce_word_count,
        map_reduce_set_difference, key_bucket_report, bernoulli_subset, path_basename, name_field,
        vocabulary_distinct, set_membership, labels_per_element, set_difference, set_difference_words,
        set_difference_once, split_records, strip_markup, strip_line_ends, post_fields, rejected_posts,
        term_mentions, months_per_term, blog_industry_mentions, tile_grid, tile_ids, select_tiles,
        pixel_at, intensity, block_mean, row_diff_sign, col_diff_sign, lifted_sign, tile_features,
        reduced_features, feature_lengths, archive_features, archive_rejects, raster_tiles, raster_pixels, signature_bits,
        signature_bits_divisible, lsh_buckets, buckets_per_tile, lsh_matches,
        matched_any, lsh_match_counts, lsh_band_sweep, matched_features, sample_rows, column_stats,
        zscore, project_fixed_basis, pair_distance, ranked_neighbours, nearest_neighbours,
        similar_images, similar_images_by_block,
    )
}
