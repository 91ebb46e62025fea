"""Image tiles: cutting, selecting, intensity, and gradient features.

Two forms.  Tiles whose cells are array columns go through the native functions of
:mod:`tessella.functions.grids`.  Images with binary pixels go through Arrow batches and
numpy, from archive to feature vector in one narrow step, so that pixels never travel
back to the JVM.
"""

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import grids
from tessella.functions.lambdas import bind
from tessella.functions.strings import tile_id
from tessella.runtime import broadcast_if_small
from tessella.sources.archives import Decoder, Rejected, decode_tiff, iter_images

TILE_SCHEMA = (
    "image string, row int, col int, tile_id string, height int, width int, channels int, pixels binary"
)
TILE_REJECT_SCHEMA = TILE_SCHEMA + ", reason string, detail string"
SCAN_SCHEMA = "file_name string, reason string, detail string, tile_id string, block int, features array<tinyint>"
INTENSITY_SCHEMA = "tile_id string, height int, width int, v array<int>"
FEATURE_SCHEMA = "tile_id string, block int, features array<tinyint>"

# The number of strips per side, by side length, when no tile size is given.
STRIPS_OF_LARGE_SIDE = {5000: 10}
STRIPS = 5

# Fixed value: the grid width that compatible tile numbers assume for every image.
COMPAT_GRID_WIDTH = 5


#: Ids up to which a Python list is written into the filter itself.
LISTED_IDS = 1000


# ---- numpy, per tile ---------------------------------------------------------------


def tile_side(side: int, tile: int | None) -> int:
    """Tile length along a side; with no tile size given, 5 strips, or 10 of a 5000 side."""
    length = tile or side // STRIPS_OF_LARGE_SIDE.get(side, STRIPS)
    if length < 1 or side % length:
        raise Rejected(Rejected.WRONG_SIZE, f"a side of {side} cannot be cut into equal tiles of {length}")
    return length


def cut_tiles(
    image: np.ndarray, tile: int | None = 500, compat_index: bool = False
) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """``(row, col, index, pixels)`` of an image, row by row.

    The index is ``row * columns + col``.  ``compat_index`` numbers every grid as if it
    were five tiles wide, which repeats numbers on wider grids.
    """
    h, w = tile_side(image.shape[0], tile), tile_side(image.shape[1], tile)
    columns = image.shape[1] // w
    for r in range(image.shape[0] // h):
        for c in range(columns):
            index = r * (COMPAT_GRID_WIDTH if compat_index else columns) + c
            yield r, c, index, image[r * h : (r + 1) * h, c * w : (c + 1) * w]


def pixel_intensities(pixels: np.ndarray) -> np.ndarray:
    """Per pixel: mean of the first three channels times the fourth over 100, truncated."""
    if pixels.shape[-1] < 4:
        raise Rejected(Rejected.FEW_CHANNELS, f"{pixels.shape[-1]} channels, four are needed")
    colour = pixels[..., :3].sum(axis=-1, dtype=np.int64)
    return np.trunc(colour / 3.0 * pixels[..., 3] / 100.0).astype(np.int32)


def gradient_features(values: np.ndarray, block: int, threshold: float = 1) -> np.ndarray:
    """Feature vectors of intensity grids after averaging ``block x block`` squares.

    Works on the last two axes: one grid gives one vector, a stack of grids one per grid.
    """
    *stack, h, w = values.shape
    if h % block or w % block:
        raise Rejected(Rejected.WRONG_SIZE, f"a {h}x{w} grid cannot be cut into {block}x{block} blocks")
    squares = values.reshape(*stack, h // block, block, w // block, block)
    sums = squares.sum(axis=(-3, -1), dtype=np.int64)
    means = sums / float(block * block)

    def signs(d: np.ndarray) -> np.ndarray:
        return ((d > threshold).astype(np.int8) - (d < -threshold).astype(np.int8)).reshape(*stack, -1)

    return np.concatenate([signs(np.diff(means, axis=-1)), signs(np.diff(means, axis=-2))], axis=-1)


def _pixels(batch: pa.RecordBatch, i: int) -> np.ndarray:
    shape = tuple(batch.column(k)[i].as_py() for k in ("height", "width", "channels"))
    return np.frombuffer(batch.column("pixels")[i].as_buffer(), dtype=np.uint8).reshape(shape)


def _lists(vectors: Sequence[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0] + [len(v) for v in vectors], dtype=np.int32)
    flat = np.concatenate(vectors) if vectors else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def _stacked(vectors: np.ndarray) -> pa.Array:
    """Rows of a matrix as a list array."""
    n, width = vectors.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(vectors.ravel()))


def _tile_batch(image: str, tiles: Iterable[tuple[int, int, int, np.ndarray]], rejects: bool) -> pa.RecordBatch:
    tiles = list(tiles)
    ids = [f"{image}-{index}" for _, _, index, _ in tiles]
    shapes = [p.shape for _, _, _, p in tiles]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([image] * len(tiles), pa.string()),
            pa.array([r for r, _, _, _ in tiles], pa.int32()),
            pa.array([c for _, c, _, _ in tiles], pa.int32()),
            pa.array(ids, pa.string()),
            *(pa.array([s[k] for s in shapes], pa.int32()) for k in range(3)),
            pa.array([np.ascontiguousarray(p).tobytes() for _, _, _, p in tiles], pa.binary()),
            *([pa.nulls(len(tiles), pa.string())] * 2 if rejects else []),
        ],
        ["image", "row", "col", "tile_id", "height", "width", "channels", "pixels", *(["reason", "detail"] if rejects else [])],
    )


def scan_batch(
    file_name: str, image: np.ndarray | None, why: Rejected | None,
    blocks: Sequence[int], tile: int | None, compat_index: bool,
) -> pa.RecordBatch:
    """Feature rows of one image, or one row that says why there are none."""
    ids, used, vectors = [], [], []
    if image is None:
        why = why or Rejected(Rejected.NO_MEMBER)
    else:
        try:
            for _, _, index, pixels in cut_tiles(image, tile, compat_index):
                values = pixel_intensities(pixels)
                for block in blocks:
                    ids.append(f"{file_name}-{index}")
                    used.append(block)
                    vectors.append(gradient_features(values, block))
        except Rejected as unfit:
            why = unfit
    if why:
        ids, used, vectors = [None], [None], []
    n = len(ids)
    features = pa.nulls(1, pa.list_(pa.int8())) if why else _lists(vectors, pa.int8())
    told = [pa.array([x] * n, pa.string()) for x in (file_name, why and why.reason, why and why.detail)]
    return pa.RecordBatch.from_arrays(
        [*told, pa.array(ids, pa.string()), pa.array(used, pa.int32()), features],
        ["file_name", "reason", "detail", "tile_id", "block", "features"],
    )


# ---- DataFrames with binary pixels -------------------------------------------------


def tile_raster(
    rasters: DataFrame, tile: int | None = 500, compat_index: bool = False, rejects: bool = False
) -> DataFrame:
    """Tiles of decoded rasters (rows with a name); emitted strip by strip.

    A raster that cannot be cut stops the job.  With ``rejects`` it gives a row with its
    name as ``image``, ``reason`` and ``detail`` instead, and so does each raster without a name (with
    its file name); tiles have NULL there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column("name")[i].as_py()
                strip: list = []
                try:
                    for piece in cut_tiles(_pixels(batch, i), tile, compat_index):
                        if strip and piece[0] != strip[0][0]:
                            yield _tile_batch(name, strip, rejects)
                            strip = []
                        strip.append(piece)
                except Rejected as why:  # told by the sides, so before any tile
                    if not rejects:
                        raise
                    yield pa.RecordBatch.from_pylist([{"image": name, "reason": why.reason, "detail": why.detail}], schema)
                if strip:
                    yield _tile_batch(name, strip, rejects)

    fields = [(n, pa.string()) for n in ("image", "tile_id", "reason", "detail")]
    fields[1:1] = [("row", pa.int32()), ("col", pa.int32())]
    fields[4:4] = [("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("pixels", pa.binary())]
    schema = pa.schema(fields)
    named = rasters.where(F.col("name").isNotNull())
    cut = named.select("name", "height", "width", "channels", "pixels")
    if not rejects:
        return cut.mapInArrow(run, TILE_SCHEMA)
    unnamed = rasters.where(F.col("name").isNull()).select(F.col("file_name").alias("image"), "reason", F.col("error").alias("detail"))
    return cut.mapInArrow(run, TILE_REJECT_SCHEMA).unionByName(unnamed, allowMissingColumns=True)


def select_tiles(tiles: DataFrame, ids: Sequence[str] | DataFrame, column: str = "tile_id") -> DataFrame:
    """Tiles whose id is listed, in a Python list or in the first column of a DataFrame."""
    if not isinstance(ids, DataFrame) and len(ids) > LISTED_IDS:
        ids = tiles.sparkSession.createDataFrame([(i,) for i in ids], f"id {dict(tiles.dtypes)[column]}")
    if isinstance(ids, DataFrame):
        listed = ids.select(F.col(ids.columns[0]).alias(column)).distinct()
        return tiles.join(broadcast_if_small(listed), column, "left_semi")
    return tiles.where(F.col(column).isin(list(ids)))


def pixel_at(tiles: DataFrame, row: int, col: int) -> DataFrame:
    """``tile_id, pixel``: the channel values of one pixel of each tile with binary pixels."""
    start = (F.lit(row) * F.col("width") + col) * F.col("channels")
    channel = F.sequence(F.lit(1), F.col("channels"))
    byte = F.transform(
        channel, lambda c: F.conv(F.hex(F.substring("pixels", start + c, F.lit(1))), 16, 10).cast("int")
    )
    return tiles.select("tile_id", byte.alias("pixel"))


def intensity_of_pixels(tiles: DataFrame) -> DataFrame:
    """``tile_id, height, width, v``: intensity grids of tiles with binary pixels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grids_ = [pixel_intensities(_pixels(batch, i)) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("tile_id"),
                    batch.column("height"),
                    batch.column("width"),
                    _lists([g.ravel() for g in grids_], pa.int32()),
                ],
                ["tile_id", "height", "width", "v"],
            )

    return tiles.select("tile_id", "height", "width", "channels", "pixels").mapInArrow(run, INTENSITY_SCHEMA)


def features_of_intensity(intensities: DataFrame, blocks: Sequence[int] = (10,)) -> DataFrame:
    """``tile_id, block, features`` of intensity grids, for one or more block sizes."""
    sizes = list(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = list(zip(batch.column("height").to_pylist(), batch.column("width").to_pylist()))
            for h, w in dict.fromkeys(shapes):
                same = batch.filter(pa.array([s == (h, w) for s in shapes]))
                cells = same.column("v").flatten().to_numpy(zero_copy_only=False)
                stack = cells.reshape(same.num_rows, h, w)
                for block in sizes:
                    vectors = gradient_features(stack, block)
                    yield pa.RecordBatch.from_arrays(
                        [
                            same.column("tile_id"),
                            pa.array(np.full(same.num_rows, block, np.int32)),
                            _stacked(vectors),
                        ],
                        ["tile_id", "block", "features"],
                    )

    return intensities.select("tile_id", "height", "width", "v").mapInArrow(run, FEATURE_SCHEMA)


def scan_archives(
    archives: DataFrame,
    blocks: Sequence[int] = (10,),
    tile: int | None = 500,
    decode: Decoder = decode_tiff,
    suffix: str = ".tif",
    compat_index: bool = False,
) -> DataFrame:
    """``file_name, reason, detail, tile_id, block, features`` straight from archives
    (``file_name, content``).

    Decoding, tiling, intensity and features are one Arrow step per image; only feature
    vectors come back.  An archive that is damaged, holds no image, or one of a size, kind or
    number of channels that does not fit gives one row with its reason and no tile, in the
    same scan; see :func:`features_of_scan` and :func:`rejects_of_scan`.  A decoder that is not
    installed fails the job.
    """
    sizes = list(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file_name, image, why in iter_images(batch, suffix, decode):
                yield scan_batch(file_name, image, why, sizes, tile, compat_index)

    return archives.select("file_name", "content").mapInArrow(run, SCAN_SCHEMA)


def features_of_scan(scan: DataFrame) -> DataFrame:
    """``tile_id, block, features`` of the archives that could be used."""
    return scan.where(F.col("reason").isNull()).select("tile_id", "block", "features")


def rejects_of_scan(scan: DataFrame) -> DataFrame:
    """``file_name, reason, detail`` of the others, one row per archive."""
    return scan.where(F.col("reason").isNotNull()).select("file_name", "reason", "detail")


def archive_features(
    archives: DataFrame,
    blocks: Sequence[int] = (10,),
    tile: int | None = 500,
    decode: Decoder = decode_tiff,
    suffix: str = ".tif",
    compat_index: bool = False,
) -> DataFrame:
    """The features of :func:`scan_archives` alone.  To learn what was left out, keep the scan."""
    return features_of_scan(scan_archives(archives, blocks, tile, decode, suffix, compat_index))


# ---- DataFrames with array cells ---------------------------------------------------


def tile_grid(
    grids_: DataFrame, id_column: str, height: int, width: int, tile: int, grid: str = "v"
) -> DataFrame:
    """``image, row, col, tile_id, height, width, v``: square tiles of array grids."""
    if height % tile or width % tile:
        raise ValueError(f"a {height}x{width} grid cannot be cut into tiles of {tile}")
    columns = width // tile
    pieces = bind(
        F.col(grid),
        lambda g: F.array(
            *(
                F.struct(
                    F.lit(r).alias("row"),
                    F.lit(c).alias("col"),
                    grids.sub_grid(g, width, r * tile, c * tile, tile, tile).alias("v"),
                )
                for r in range(height // tile)
                for c in range(columns)
            )
        ),
    )
    cut = grids_.select(F.col(id_column).cast("string").alias("image"), F.inline(pieces))
    return cut.select(
        "image",
        "row",
        "col",
        tile_id(F.col("image"), F.col("row") * columns + F.col("col")).alias("tile_id"),
        F.lit(tile).alias("height"),
        F.lit(tile).alias("width"),
        "v",
    )


def cell_at(tiles: DataFrame, width: int, row: int, col: int, grid: str = "v") -> DataFrame:
    """``tile_id, cell``: one cell of each array grid."""
    return tiles.select("tile_id", F.get(F.col(grid), F.lit(row * width + col)).alias("cell"))


def grid_features(
    grids_: DataFrame, id_column: str, height: int, width: int, block: int = 1, grid: str = "v"
) -> DataFrame:
    """``id, features`` of array grids after block means."""
    reduced = grids.block_mean(F.col(grid), height, width, block) if block > 1 else F.col(grid)
    vector = grids.feature_vector(reduced, height // block, width // block)
    return grids_.select(id_column, vector.alias("features"))


def feature_lengths(features: DataFrame) -> DataFrame:
    """``length, n``: how many vectors there are of each length."""
    return features.groupBy(F.size("features").alias("length")).agg(F.count(F.lit(1)).alias("n"))
