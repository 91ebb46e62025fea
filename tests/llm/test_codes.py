import numpy as np
import pyarrow as pa
import pytest

from tessella.llm import codes


@pytest.mark.parametrize("p", [1, 2, 4, 8, 16, 64])
def test_the_transform_is_walsh_in_order_of_sign_changes(p):
    rows = codes.walsh(np.eye(p, dtype=np.int64)).T
    assert (rows @ rows.T == p * np.eye(p)).all()
    assert (np.diff(rows, axis=1) != 0).sum(axis=1).tolist() == list(range(p))


@pytest.mark.parametrize("m", [0, 1, 3, 4, 24])
@pytest.mark.parametrize("factor", [1, 2**20, 2**60])
def test_nearest_entries_equal_all_distances(m, factor):
    rng = np.random.default_rng(m)
    parts, entries = rng.integers(-9, 9, (500, m)).astype(object) * factor, rng.integers(-9, 9, (40, m)).astype(object) * factor
    entries[30] = entries[2]  # a tie
    distance = [[sum(((x - c) ** 2).tolist()) for c in entries] for x in parts]
    index, least = codes.nearest(parts, entries)
    assert index.tolist() == [row.index(min(row)) for row in distance]
    assert least.tolist() == [min(row) for row in distance]


def test_few_entries_are_compared_to_the_end(monkeypatch):
    """Smooth parts: nearly all entries go after the first coefficients."""
    rng = np.random.default_rng(1)
    smooth = lambda n: np.cumsum(rng.integers(-2, 3, (n, 16)), axis=1) + rng.integers(-200, 200, (n, 1))
    parts, entries = smooth(400), smooth(64)
    first = codes.walsh(parts)[:, :1] - codes.walsh(entries)[None, :, 0]
    index, least = codes.nearest(parts, entries)
    left = (first**2 <= 16 * least[:, None]).mean()
    assert left < 0.1
    assert index.tolist() == ((parts[:, None] - entries[None]) ** 2).sum(-1).argmin(1).tolist()


def test_floors_are_exact_for_any_double():
    values = np.array([-0.001, 1e-320, 2.0**45 + 0.75, 1.7e308, -1e200])
    assert codes.whole_numbers(values, 256).tolist() == [-1, 0, 256 * 2**45 + 192, 256 * int(1.7e308), 256 * int(-1e200)]


def test_widths_ties_and_names(spark):
    rows = [(1, [1.0] * 20, "a"), (1, [0.5] * 20, "a"), (None, [3.0] * 20, None), (2, [1e300] * 16, "b"), (3, [-1e300] * 16, "b"), (4, [], "c"), (5, None, "c"), (6, [None] * 20, "c")]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, coded string").repartition(3)
    books = codes.fit(df, "v", "vec_id", rounds=1)
    assert sorted(books.books) == [0, 16, 20]
    out = codes.compress(df, books, "v").collect()
    assert len(out) == 6 and all(len(r.coded.code) == 16 and r.coded.error == 0 for r in out)
    wide = {r.vec_id: r for r in out if len(r.v) == 16}
    assert codes.decoded(books, 16, wide[2].coded.code).tolist() == [256 * int(1e300)] * 16
    assert sorted(bytes(r.coded.code)[0] for r in out if len(r.v) == 20) == [0, 1, 2]
    assert all(codes.decoded(books, 20, r.coded.code).tolist() == [256 * x for x in r.v] for r in out if len(r.v) == 20)
    one = codes.Codebooks({16: books.books[16][:, :1]}, 16, 256)
    assert max(r.coded.error for r in codes.compress(df.where("vec_id IN (2, 3)"), one, "v").collect()) == 2**63 - 1


def test_codebooks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(codes, "CODEBOOK_CELLS", 100)
    df = spark.createDataFrame([(1, [1.0] * 16)], "vec_id long, v array<double>")
    with pytest.raises(ValueError):
        codes.fit(df, "v", "vec_id")


def test_sums_of_tasks_may_pass_64_bits(spark):
    rows = [(i, [2.0**50 + (i % 2) * 1024] * 16) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(7)
    books = codes.fit(df, "v", "vec_id", entries=1, rounds=1)
    assert set(books.books[16].ravel().tolist()) == {256 * (2**50 + 512)}
