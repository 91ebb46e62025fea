import numpy as np
import pytest

from tests.test_tiles import archive, npy
from tessella.operators import reduced as V
from tessella.plans import images as I
from tessella.sources.archives import decode_npy

RNG = np.random.default_rng(3)
VECTORS = RNG.integers(-1, 2, (40, 25))
VECTORS[:, 7] = 1  # a dimension that never varies


@pytest.fixture(scope="module")
def features(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(VECTORS)]
    return spark.createDataFrame(rows, "tile_id int, features array<tinyint>").cache()


def test_stats_are_population_stats_with_a_zero_guard(features):
    stats = V.fit_stats(features)
    assert np.allclose(stats.mean, VECTORS.mean(axis=0)) and np.allclose(stats.std, VECTORS.std(axis=0))
    assert stats.std[7] == 0 and stats.scale[7] == 1
    z = {r.tile_id: r.z for r in V.zscore(features, stats).collect()}
    assert np.allclose([z[i] for i in range(40)], (VECTORS - VECTORS.mean(axis=0)) / np.array(stats.scale))


def svd_distances(sample, a, b):
    std = sample.std(axis=0)
    _, s, vh = np.linalg.svd((sample - sample.mean(axis=0)) / np.where(std == 0, 1, std), full_matrices=False)
    vh = vh[s > 1e-6 * s[0]]
    return np.linalg.norm((a - b) @ vh.T), s[s > 1e-6 * s[0]]


def test_basis_equals_svd_up_to_sign_and_null_directions(features):
    sample = V.sample_rows(features, 10, seed=4)
    ids = [r.tile_id for r in sample.collect()]
    basis = V.fit_basis(sample)
    assert basis.directions.shape == (25, 9)  # ten centred rows have rank nine
    distance, s = svd_distances(VECTORS[ids].astype(float), VECTORS[0], VECTORS[1])
    assert np.allclose(basis.singular_values, s)
    z = {r.tile_id: np.array(r.z) for r in V.project(features, basis).collect()}
    assert np.isclose(np.linalg.norm(z[0] - z[1]), distance)
    assert V.fit_basis(sample, k=3).directions.shape == (25, 3)


def test_a_large_sample_is_fitted_by_spark(features, monkeypatch):
    want = V.fit_basis(features)
    monkeypatch.setattr(V, "DRIVER_CELLS", 10)
    got = V.fit_basis(features)
    assert got.directions.shape == want.directions.shape
    assert np.allclose(got.singular_values, want.singular_values)
    assert np.allclose(np.abs((got.directions * want.directions).sum(axis=0)), 1)


@pytest.mark.parametrize("shape", [(300, 12), (12, 300), (40, 25)])
def test_tall_and_wide_samples_are_fitted_from_partial_sums(spark, monkeypatch, shape):
    rows = np.random.default_rng(1).integers(-1, 2, shape)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "tile_id int, features array<tinyint>").repartition(5)
    want = V.basis_of_rows(rows.astype(float))
    monkeypatch.setattr(V, "DRIVER_CELLS", max(min(shape) ** 2, 300 * 12 - 1) if shape != (40, 25) else 25 * 25)
    monkeypatch.setattr(V, "SLICE", 64)
    monkeypatch.setattr(V, "_fit_basis_by_spark", None)
    got = V.fit_basis(df)
    assert got.directions.shape == want.directions.shape
    assert np.allclose(got.singular_values, want.singular_values)
    assert np.allclose(np.abs((got.directions * want.directions).sum(axis=0)), 1)
    assert np.allclose(got.directions @ got.directions.T, want.directions @ want.directions.T)


def test_a_basis_too_wide_to_broadcast_meets_vectors_by_block(spark, features, monkeypatch):
    matrix = np.random.default_rng(2).normal(size=(25, 7))
    twice = features.union(features)  # rows that repeat their ids
    want = sorted((r.tile_id, tuple(np.round(r.z, 9))) for r in V.project(twice, matrix).collect())
    monkeypatch.setattr(V, "BROADCAST_CELLS", 21)
    found = V.project(twice, matrix)
    assert sorted((r.tile_id, tuple(np.round(r.z, 9))) for r in found.collect()) == want
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_stats_leave_out_nulls_and_take_any_length(spark):
    rows = [([1.0, 2.0, None],), ([3.0],), (None,), ([],), ([5.0, None, 7.0],), ([1e9, 1e9 + 1, 1e9 + 2],)]
    df = spark.createDataFrame(rows, "x array<double>").repartition(3)
    got = {r.pos: (r["mean"], r["std"]) for r in V.column_stats(df, "x").collect()}
    for pos, values in enumerate(([1, 3, 5, 1e9], [2, 1e9 + 1], [7, 1e9 + 2])):
        assert np.allclose(got[pos], (np.mean(values), np.std(values)))
    assert V.column_stats(df.where("x IS NULL"), "x").collect() == []


def test_samples_have_their_size_whatever_ids_repeat(spark):
    rows = [(i // 3, [i % 4]) for i in range(60)]
    df = spark.createDataFrame(rows, "tile_id int, features array<int>")
    drawn = V.sample_rows(df.repartition(4), 10, seed=3)
    assert drawn.count() == 10 and sorted(drawn.collect()) == sorted(V.sample_rows(df, 10, seed=3).collect())
    assert sorted(V.sample_rows(df, 100).collect()) == sorted(df.collect())


def test_sample_is_repeatable_and_without_replacement(features):
    one = sorted(r.tile_id for r in V.sample_rows(features, 10, seed=1).collect())
    two = sorted(r.tile_id for r in V.sample_rows(features.repartition(5), 10, seed=1).collect())
    assert one == two and len(set(one)) == 10
    assert one != sorted(r.tile_id for r in V.sample_rows(features, 10, seed=2).collect())


@pytest.mark.parametrize("bound", [None, "BROADCAST_CANDIDATES", "BROADCAST_CELLS"])
def test_pair_distances_and_dedupe(spark, features, monkeypatch, bound):
    if bound:
        monkeypatch.setattr(V, bound, 0)
        monkeypatch.setattr(V, "HOT_ROWS", 1)
    pairs = spark.createDataFrame([(0, 0), (0, 5), (1, 5)], "candidate int, tile_id int")
    z = features.withColumnRenamed("features", "z")
    got = {(r.candidate, r.tile_id): r.distance for r in V.pair_distance(pairs, z).collect()}
    assert got == {(a, b): np.linalg.norm(VECTORS[a] - VECTORS[b]) for a, b in ((0, 0), (0, 5), (1, 5))}
    found = V.pair_distance(pairs, z)
    farther = found.withColumn("distance", found.distance + 1)
    assert sorted(V.unique_pairs(farther.union(found)).collect()) == sorted(found.collect())
    assert V.matched_features(features, pairs).count() == 2


@pytest.mark.parametrize("window_rows", [10**6, 10])
def test_ranks_by_window_and_by_ranges(spark, window_rows):
    rng = np.random.default_rng(9)
    # one candidate holds most rows, many at the same distance
    rows = [(0 if i % 10 else 1, i, float(d)) for i, d in enumerate(rng.integers(0, 5, 2000))]
    df = spark.createDataFrame(rows, "candidate int, tile_id int, distance double").repartition(6)
    got = sorted((r.candidate, r["rank"], r.tile_id) for r in V.rank_by_distance(df, window_rows=window_rows).collect())
    want = []
    for c in (0, 1):
        own = sorted((d, t) for k, t, d in rows if k == c)
        want += [(c, i + 1, t) for i, (_, t) in enumerate(own)]
    assert got == want
    many = V.rank_by_distance(df, top=1500, window_rows=window_rows)
    assert sorted((r.candidate, r["rank"], r.tile_id) for r in many.collect()) == [w for w in want if w[1] <= 1500]
    top = V.rank_by_distance(df, top=3)
    assert sorted((r.candidate, r["rank"], r.tile_id) for r in top.collect()) == [w for w in want if w[1] <= 3]


def test_top_ranks_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(0, 1, 0.5)], "candidate int, tile_id int, distance double")
    plan = V.rank_by_distance(df, top=3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_repeated_tile_numbers_give_one_row_per_pair(spark, tmp_path):
    image = np.random.default_rng(2).integers(0, 256, (20, 120, 4), dtype=np.uint8).repeat(2, axis=0)
    (tmp_path / "wide.zip").write_bytes(archive(x_npy=npy(image)))  # 2 x 6 tiles, numbers 0..10
    rows = I.similar_images(
        spark, str(tmp_path), ["wide.zip-5"], blocks=(1,), tile=20, settings=I.Settings(m=16, b=2, n_sample=8),
        decode=decode_npy, suffix=".npy", compat_index=True,
    ).collect()
    assert len({r.tile_id for r in rows}) == len(rows) and rows
    assert {r["rank"] for r in rows} == set(range(1, len(rows) + 1))


def test_similar_images_from_archives(spark, tmp_path, tmp_path_factory):
    stage = tmp_path_factory.mktemp("stage")
    rng = np.random.default_rng(21)
    base = rng.integers(0, 256, (40, 40, 4), dtype=np.uint8)
    for name, image in {"a": base, "b": base.copy(), "c": rng.integers(0, 256, (40, 40, 4), dtype=np.uint8)}.items():
        (tmp_path / f"{name}.zip").write_bytes(archive(x_npy=npy(image)))
    settings = I.Settings(m=16, b=4, n_sample=6, seed=1)
    for scaled in (False, True):
        chosen = I.Settings(**{**settings.__dict__, "scaled": scaled})
        rows = I.similar_images(
            spark, str(tmp_path), ["a.zip-0", "a.zip-3"], blocks=(2, 1), tile=20, settings=chosen,
            decode=decode_npy, suffix=".npy", stage=str(stage / str(scaled)),
        ).collect()
        for block in (2, 1):
            for candidate in ("a.zip-0", "a.zip-3"):
                own = sorted((r["rank"], r.tile_id, r.distance) for r in rows if (r.block, r.candidate) == (block, candidate))
                assert [rank for rank, _, _ in own] == list(range(1, len(own) + 1))
                # the tile itself and its copy in the second image, at distance zero
                assert {t for _, t, _ in own[:2]} == {candidate, candidate.replace("a", "b")}
                assert own[0][2] == own[1][2] == 0
                assert all(x[2] <= y[2] for x, y in zip(own, own[1:]))
