"""Vectors of many lengths, and the audit of links."""

import logging

import numpy as np
import pytest

from tessella.llm import neighbours


def test_vectors_link_with_their_own_length_only(spark):
    rows = [(i, [1.0] * (1 + i // 2)) for i in range(6)] + [(9, [2.0]), (10, [-1.0])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {0: (2, 0), 1: (2, 0), 9: (2, 0), 10: (0, 10), 2: (1, 2), 3: (1, 2), 4: (1, 4), 5: (1, 4)}


def test_low_recall_stops_and_none_is_said(spark, monkeypatch, caplog):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 8))
    near = [v + rng.normal(size=8) * 0.02 for v in base]
    frame = lambda vectors: spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    with caplog.at_level(logging.INFO):
        neighbours.near_vectors(frame([*base, *near]))
    assert "links of the audited nodes were found" in caplog.text
    caplog.clear()
    neighbours.near_vectors(frame(np.eye(8)))
    assert "is not known" in caplog.text
    monkeypatch.setattr(neighbours, "_refined", lambda lists, *_: lists.limit(0))
    with pytest.raises(RuntimeError, match="only 0 were found"):
        neighbours.near_vectors(frame([*base, *near]), tries=1)


def _bridged():
    """Two tight groups of 40 vectors, linked by one pair of which neither is near in the other's list."""
    angles = [*(-np.arange(39) * 0.05), 1.2, *(20.5 + np.arange(39) * 0.05), 19.3]
    return [(i, [float(np.cos(np.radians(a))), float(np.sin(np.radians(a)))]) for i, a in enumerate(angles)]


def test_a_link_that_no_list_has_a_place_for_is_found(spark, monkeypatch):
    rows = _bridged()
    x = np.array([v for _, v in rows])
    links = (x @ x.T >= 0.95).sum(axis=1) - 1
    monkeypatch.setattr(neighbours, "LEAST_LINKS", 1)
    monkeypatch.setattr(neighbours, "_audit", lambda nodes, *_: neighbours.cut(nodes.select(nodes.node.alias("a"), nodes.node.alias("b")).limit(0)))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for forest in (neighbours._forest, lambda nodes, s, threshold: (nodes[:0], nodes[:0], np.zeros(0))):
        monkeypatch.setattr(neighbours, "_forest", forest)  # each of the two ways must find it alone
        found = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_vectors(frame, tables=2, rounds=1).collect()}
        assert found == {i: (int(n), 0) for i, n in enumerate(links)}


def test_hub_is_compared_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 4)
    angles = [30.0 * (i // 2) + i % 2 for i in range(12)]  # leaves 0 and 1, 2 and 3 .. link, all have one hub
    rows = [(i, [float(np.cos(np.radians(a))), float(np.sin(np.radians(a)))]) for i, a in enumerate(angles)]
    nodes = spark.createDataFrame([*rows, (99, [-1.0, -1.0])], "node long, vector array<double>")
    pairs = spark.createDataFrame([(i, 99, -0.9, False) for i in range(12)], "a long, b long, similarity double, kept boolean")
    found = neighbours._refined(pairs, nodes, 2, 1, 1.0, 0.95).where("kept").collect()
    assert {tuple(sorted((r.a, r.b))) for r in found} == {(i, i + 1) for i in range(0, 12, 2)}
