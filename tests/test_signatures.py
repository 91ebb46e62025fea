import hashlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.test_text import FEW
from tessella.functions import hashing
from tessella.operators import joins
from tessella.operators import signatures as L


def plain_bit(chunk):
    digits = format(int(hashlib.md5(str(chunk).encode()).hexdigest(), 16), "b")
    return int(digits[62])


def plain_signature(f, m, cover_tail=False):
    n = len(f)
    if n % m == 0:
        step = n // m
        return [plain_bit(f[i * step : (i + 1) * step]) for i in range(m)]
    wide = 2 * (n // m)
    forward = [f[i * wide : (i + 1) * wide] for i in range(m // 2)]
    end = n if cover_tail else n - 1
    backward = [f[end - (i + 1) * wide : end - i * wide] for i in range(m // 2)]
    return [plain_bit(c) for c in forward + backward]


@FEW
@given(st.integers(0, 2**32 - 1), st.sampled_from([(112, 32), (100, 10), (37, 8), (4900, 128)]), st.booleans())
def test_signature_equals_hashlib(spark, seed, shape, cover_tail):
    n, m = shape
    rows = np.random.default_rng(seed).integers(-1, 2, (5, n)).tolist()
    df = spark.createDataFrame(list(enumerate(rows)), "tile_id int, features array<tinyint>")
    got = {r.tile_id: r.bits for r in L.signatures(df, m=m, cover_tail=cover_tail).collect()}
    assert got == {i: plain_signature(f, m, cover_tail) for i, f in enumerate(rows)}


def test_bit_of_digests_with_leading_zeros(spark):
    texts = [str(i) for i in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.b for r in df.select("t", hashing.chunk_bit(F.col("t")).alias("b")).collect()}
    digits = {t: format(int(hashlib.md5(t.encode()).hexdigest(), 16), "b") for t in texts}
    assert min(len(d) for d in digits.values()) < 120
    assert got == {t: int(d[62]) for t, d in digits.items()}


def test_last_feature_is_not_hashed_unless_asked(spark):
    f = [0] * 113
    g = f[:-1] + [1]
    df = spark.createDataFrame([(0, f), (1, g)], "tile_id int, features array<tinyint>")
    a, b = (r.bits for r in L.signatures(df, m=32).orderBy("tile_id").collect())
    assert a == b
    chunks = df.select(hashing.feature_chunks(F.col("features").cast("array<string>"), 32, True).alias("c"))
    assert sorted(c.c[16][-1] for c in chunks.collect()) == ["0", "1"]


def test_too_few_features_is_an_error(spark):
    df = spark.createDataFrame([(0, [0] * 20)], "tile_id int, features array<tinyint>")
    with pytest.raises(PySparkException, match="at least 32 features"):
        L.signatures(df, m=32).collect()
    with pytest.raises(ValueError):
        hashing.band_values(F.col("bits"), 128, 63)


def test_bands(spark):
    bits = [int(x) for x in format(0b10110111, "08b")]
    df = spark.createDataFrame([("t", bits)], "tile_id string, bits array<tinyint>")
    rows = [tuple(r) for r in L.lsh_buckets(df, 8, 3).orderBy("band").collect()]
    assert rows == [("t", 0, 0b101), ("t", 1, 0b101)]
    assert [tuple(x) for x in L.buckets_per_tile(df, 8, 3).first().buckets] == [(0, 5), (1, 5)]
    wide = spark.createDataFrame([("t", [1] * 124)], "tile_id string, bits array<tinyint>")
    assert {r.bucket for r in L.lsh_buckets(wide, 124, 62).collect()} == {2**62 - 1}


@pytest.fixture(scope="module")
def signed(spark):
    """1,000 tiles, a third of them blank and so equal in every band."""
    rng = np.random.default_rng(5)
    rows = [(i, [0] * 32 if i % 3 == 0 else rng.integers(0, 2, 32).tolist()) for i in range(1000)]
    return spark.createDataFrame(rows, "tile_id int, bits array<tinyint>").cache()


def plain_matches(signed, candidates, b):
    bands = {r.tile_id: {(j, tuple(r.bits[j * b : (j + 1) * b])) for j in range(32 // b)} for r in signed.collect()}
    return {(c, t) for c in candidates for t in bands if bands[c] & bands[t]}


@pytest.mark.parametrize("max_broadcast, hot_rows", [(100, 10**6), (0, 10**6), (0, 50)])
def test_matches_by_broadcast_shuffle_and_hot_bucket_spread(signed, max_broadcast, hot_rows):
    candidates = [0, 1, 2, 3, 500]
    buckets = L.lsh_buckets(signed, 32, 8)
    found = L.similar_to(buckets, candidates, max_broadcast=max_broadcast, hot_rows=hot_rows).collect()
    want = plain_matches(signed, candidates, 8)
    assert len(found) == len(want) and {(r.candidate, r.tile_id) for r in found} == want
    assert {(c, c) for c in candidates} <= want


def test_every_hot_key_meets_the_raised_bound(signed, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 3)
    buckets = L.lsh_buckets(signed, 32, 8)
    found = L.similar_to(buckets, [0, 1], max_broadcast=0, hot_rows=5).collect()
    assert {(r.candidate, r.tile_id) for r in found} == plain_matches(signed, [0, 1], 8)


def test_keys_hot_on_both_sides_are_dealt_to_a_grid(spark):
    """Half of the left and half of the right rows have one key; another is hot on one side alone."""
    left = spark.createDataFrame([(0 if i % 2 else i % 40, i) for i in range(2000)] + [(77, i) for i in range(300)], "k int, a int")
    right = spark.createDataFrame([(0 if i % 2 else i % 40, i) for i in range(600)] + [(88, 1)] * 500, "k int, b int")
    want = sorted(left.join(right, "k").select("k", "a", "b").collect())
    for hot_rows, hot_pairs in ((100, 10**9), (10**6, 2000), (100, 2000)):
        one, two = joins.dealt_sides(left, right, ["k"], "a", hot_rows, hot_pairs)
        cells = one.groupBy("k", "_row", "_col").count().join(two.groupBy("k", "_row", "_col").agg(F.count("*").alias("others")), ["k", "_row", "_col"], "full").collect()
        if hot_rows == 100:
            assert max(r["count"] or 0 for r in cells) <= 200 and max(r.others or 0 for r in cells if r.k != 88) <= 200
        assert max((r["count"] or 0) * (r.others or 0) for r in cells) <= (3 * hot_pairs if hot_pairs < 10**9 else 200 * 200)  # slices are drawn by hash
        assert sorted(joins.spread_join(left, right, ["k"], "a", hot_rows, hot_pairs).select("k", "a", "b").collect()) == want
    assert joins.dealt_sides(left, right, ["k"], "a", 10**6, 10**9) is None


def test_reports(signed):
    buckets = L.lsh_buckets(signed, 32, 8)
    matches = L.similar_to(buckets, [1, 3])
    want = plain_matches(signed, [1, 3], 8)
    assert {r.tile_id for r in L.matched_any(matches).collect()} == {t for _, t in want}
    assert {r.candidate: r.n for r in L.match_counts(matches).collect()} == {
        c: sum(x == c for x, _ in want) for c in (1, 3)
    }
    sweep = {(r.b, r.candidate): r.n for r in L.band_sweep(signed, [1, 3], [4, 8], 32).collect()}
    assert sweep == {(b, c): len(plain_matches(signed, [c], b)) for b in (4, 8) for c in (1, 3)}
