import io
import zipfile

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.test_text import FEW
from tessella.functions import grids
from tessella.operators import lifted
from tessella.operators import tiles as R
from tessella.sources import archives as A

RNG = np.random.default_rng(11)
IMAGES = {name: RNG.integers(0, 256, (20, 30, 4), dtype=np.uint8) for name in ("a.zip", "b-2.zip")}


def npy(image):
    out = io.BytesIO()
    np.save(out, image)
    return out.getvalue()


def archive(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as zf:
        for name, data in members.items():
            zf.writestr(name.replace("_", "."), data)
    return out.getvalue()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("archives")
    other = np.zeros((10, 10, 4), np.uint8)
    (path / "a.zip").write_bytes(archive(x_npy=npy(IMAGES["a.zip"]), x_txt=b"notes"))
    (path / "b-2.zip").write_bytes(archive(first_npy=npy(other), last_npy=npy(IMAGES["b-2.zip"])))
    (path / "none.zip").write_bytes(archive(readme_txt=b"no image"))
    (path / "broken.zip").write_bytes(b"not a zip file")
    (path / "skipped.txt").write_bytes(b"not an archive")
    return str(path)


@pytest.fixture(scope="module")
def rasters(spark, folder):
    return A.read_rasters(A.archive_bytes(spark, folder), A.decode_npy, ".npy").cache()


def pixels(row):
    return np.frombuffer(row.pixels, np.uint8).reshape(row.height, row.width, row.channels)


def test_rasters_and_rejects(rasters):
    decoded = {r.name: pixels(r) for r in A.drop_undecoded(rasters).collect()}
    assert decoded.keys() == IMAGES.keys()
    assert all((decoded[n] == IMAGES[n]).all() for n in IMAGES)  # of two members the last wins
    rejects = {r.file_name: r.error for r in A.undecoded(rasters).collect()}
    assert rejects["none.zip"] is None and "BadZipFile" in rejects["broken.zip"] and len(rejects) == 2
    assert {r.name for r in A.distinct_names(rasters).collect()} == set(IMAGES)


def test_tiles_are_windows_of_the_image(spark, rasters):
    tiles = R.tile_raster(rasters, 10)
    rows = tiles.collect()
    assert len(rows) == 12 and len({r.tile_id for r in rows}) == 12
    for r in rows:
        want = IMAGES[r.image][r.row * 10 : r.row * 10 + 10, r.col * 10 : r.col * 10 + 10]
        assert (pixels(r) == want).all()
        assert r.tile_id == f"{r.image}-{r.row * 3 + r.col}"
    corner = {r.tile_id: r.pixel for r in R.pixel_at(tiles, 2, 3).collect()}
    assert corner["b-2.zip-4"] == IMAGES["b-2.zip"][12, 13].tolist()
    assert {r.tile_id for r in R.select_tiles(tiles, ["a.zip-0", "a.zip-5"]).collect()} == {"a.zip-0", "a.zip-5"}
    ids = spark.createDataFrame([("a.zip-1",), ("a.zip-1",)], "id string")
    assert [r.tile_id for r in R.select_tiles(tiles, ids).collect()] == ["a.zip-1"]
    many = [f"a.zip-{i}" for i in range(1, 2000)]
    assert R.select_tiles(tiles, many).count() == 5


def test_compatible_numbers_repeat_on_wide_grids():
    image = np.zeros((5000, 5000, 1), np.uint8)
    plain = [i for _, _, i, _ in R.cut_tiles(image)]
    compat = [i for _, _, i, _ in R.cut_tiles(image, compat_index=True)]
    assert plain == list(range(100))
    assert len(set(compat)) == 55 and max(compat) == 54


def test_tile_sides():
    assert [R.tile_side(s, None) for s in (5000, 2500, 3000)] == [500, 500, 600]
    assert R.tile_side(5000, 500) == R.tile_side(2500, 500) == 500
    with pytest.raises(ValueError):
        R.tile_side(2501, None)


def plain_features(values, block):
    """Straight from the definition, cell by cell."""
    h, w = values.shape[0] // block, values.shape[1] // block
    means = [
        [int(values[r * block : r * block + block, c * block : c * block + block].sum()) / float(block * block) for c in range(w)]
        for r in range(h)
    ]
    sign = lambda d: 1 if d > 1 else -1 if d < -1 else 0
    across = [sign(means[r][c + 1] - means[r][c]) for r in range(h) for c in range(w - 1)]
    down = [sign(means[r + 1][c] - means[r][c]) for r in range(h - 1) for c in range(w)]
    return across + down


@given(st.integers(0, 2**32 - 1), st.sampled_from([1, 2, 4]))
@FEW
def test_numpy_features_equal_the_definition(seed, block):
    tile = np.random.default_rng(seed).integers(0, 256, (8, 12, 4), dtype=np.uint8)
    values = R.pixel_intensities(tile)
    assert values.tolist() == [
        [int((int(p[0]) + int(p[1]) + int(p[2])) / 3 * int(p[3]) / 100) for p in row] for row in tile
    ]
    assert R.gradient_features(values, block).tolist() == plain_features(values, block)


def test_length_of_full_size_features():
    values = np.zeros((500, 500), np.int32)
    assert [len(R.gradient_features(values, k)) for k in (10, 5)] == [4900, 19800]


def test_native_staged_and_fused_features_agree(spark, folder, rasters):
    tiles = R.tile_raster(rasters, 10)
    intensities = R.intensity_of_pixels(tiles).cache()
    staged = R.features_of_intensity(intensities, [1, 5])
    fused = R.archive_features(A.archive_bytes(spark, folder), [1, 5], 10, A.decode_npy, ".npy")
    as_dict = lambda df: {(r.tile_id, r.block): r.features for r in df.collect()}
    want = as_dict(staged)
    assert len(want) == 24 and as_dict(fused) == want
    for block in (1, 5):
        native = R.grid_features(intensities, "tile_id", 10, 10, block).collect()
        assert {(r.tile_id, block): r.features for r in native} == {k: v for k, v in want.items() if k[1] == block}
    assert {r.length: r.n for r in R.feature_lengths(staged).collect()} == {180: 12, 4: 12}
    assert dict(staged.dtypes)["features"] == "array<tinyint>"


def test_native_intensity_and_block_mean(spark, rasters):
    tile = IMAGES["a.zip"][:10, :10]
    df = spark.createDataFrame([(tile.ravel().tolist(),)], "p array<int>")
    got = df.select(grids.intensity(F.col("p"), 100).alias("v")).first().v
    assert got == R.pixel_intensities(tile).ravel().tolist()
    values = spark.createDataFrame([(got,)], "v array<int>")
    means = values.select(grids.block_mean(F.col("v"), 10, 10, 5).alias("m")).first().m
    assert means == np.array(got).reshape(2, 5, 2, 5).mean(axis=(1, 3)).ravel().tolist()
    with pytest.raises(ValueError):
        grids.block_mean(F.col("v"), 10, 10, 3)


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 1.0000001, -1.0, -1.5, 0.0)], "x double")
    assert [r[0] for r in df.select(grids.discretize(F.col("x"))).collect()] == [0, 1, 0, -1, 0]


def test_lifted_function_keeps_nulls_and_empties(spark):
    df = spark.createDataFrame([(1, [1, 5, 1]), (2, None), (3, [])], "id int, v array<int>")
    out = lifted.lift_over_arrays(df, "v", lambda x: x * 10.5, "double")
    assert {r.id: r.v for r in out.collect()} == {1: [10.5, 52.5, 10.5], 2: None, 3: []}


def test_lifted_function_sees_exact_integers_and_no_null_elements(spark):
    rows = [(1, [2**53 + 1, None, 2**53 + 1, 5]), (2, None), (3, []), (4, [None])]
    df = spark.createDataFrame(rows, "i int, v array<bigint>")
    out = {r.i: r.v for r in lifted.lift_over_arrays(df, "v", lambda x: x + 1, "bigint").collect()}
    assert out == {1: [2**53 + 2, None, 2**53 + 2, 6], 2: None, 3: [], 4: [None]}
