"""Top-k: exact at any size of components, in many shards, and without looking at whole trees."""

import numpy as np
import pytest

from tessella.llm import topk


def _expected(rows, queries, k, scale=256):
    import math
    from fractions import Fraction

    ints = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in rows]
    held = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
    out = []
    for q, v in ints:
        if q in queries:
            near = sorted((-held(sum(a * b for a, b in zip(v, w))), i) for i, w in ints if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    return sorted(out)


def _found(spark, rows, queries, k=5, **sizes):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(vectors, vectors.where(vectors.vec_id.isin(list(queries))), k, **sizes).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def test_many_shards_blocks_and_lengths(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8)) * 3
    rows = [(i, list(map(float, centers[i % 6] + rng.normal(size=8) * 0.2))) for i in range(600)]
    rows += [(1000 + i, list(map(float, rng.normal(size=3)))) for i in range(40)]
    rows += [(2000 + i, rows[0][1]) for i in range(60)] + [(3000, [1.0]), (3001, []), (3002, [])]
    queries = {i for i, _ in rows if i % 20 == 0} | {3001}
    assert _found(spark, rows, queries, shard_rows=50, query_rows=7) == _expected(rows, queries, 5)
    assert _found(spark, rows, queries) == _expected(rows, queries, 5)


@pytest.mark.parametrize("size", [2.0**22, 2.0**23, 2.0**60, 1e300, 1.7e308])
def test_scores_are_exact_whatever_their_size(spark, size):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.floor(x * size)) for x in rng.uniform(-1, 1, 4)]) for i in range(30)]
    rows += [(100, [size, 1.0, 0.0, 0.0]), (101, [size, 0.0, 0.0, 0.0]), (102, [1.0, 1.0, 1.0, 1.0]), (103, [1.0, 0.0, 0.0, 0.0])]
    queries = {0, 5, 101, 102, 103}
    assert _found(spark, rows, queries) == _expected(rows, queries, 5)


def test_subtrees_are_skipped(monkeypatch):
    rng = np.random.default_rng(2)
    x = np.floor(256 * np.concatenate([c + rng.normal(size=(512, 16)) * 0.05 for c in rng.normal(size=(16, 16)) * 2]))
    looked = []
    plain = topk.BallTree.bound
    monkeypatch.setattr(topk.BallTree, "bound", lambda self, node, q, size: looked.append((node, len(q))) or plain(self, node, q, size))
    score, ids = topk.search(x[:10], np.arange(10), np.full(10, topk.NONE), x, np.arange(len(x)), 5)
    truth = x[:10] @ x.T
    truth[np.arange(10), np.arange(10)] = -np.inf
    assert (np.sort(truth, axis=1)[:, :-6:-1] == score).all()
    nodes = len(topk.BallTree(x).center)
    assert sum(n for _, n in looked) < 0.5 * 10 * nodes and len({n for n, _ in looked}) < nodes
