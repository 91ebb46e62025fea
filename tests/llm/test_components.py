"""Components of a graph, and the tasks that their search takes."""

import pytest

from tessella.llm import common


@pytest.fixture
def many_partitions(spark):
    names = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _lowest(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {x: find(x) for x in root}


def test_rounds_take_no_task_for_every_shuffle_partition(spark, monkeypatch, many_partitions):
    edges = [(i, i + 1) for i in range(40) if i % 5] + [(1000, 1001 + i) for i in range(60)] + [(6, 6), (2, 1)]
    tasks, kept = {}, common.written

    def seen(df, name):
        tasks.setdefault(name, []).append(df.rdd.getNumPartitions())
        return kept(df, name)

    monkeypatch.setattr(common, "written", seen)
    frame = spark.createDataFrame(edges, "a long, b long")
    loops = {a for a, b in edges if a == b}
    want = {x: low for x, low in _lowest(edges).items() if x not in loops or any(x in e and e[0] != e[1] for e in edges)}
    assert {r.node: r.component for r in common.components(frame).collect()} == want
    cores = spark.sparkContext.defaultParallelism
    assert max(tasks["low"] + tasks["roots"] + tasks["edges"][1:] + tasks["lowest"]) <= cores < 16

    tasks.clear()
    monkeypatch.setattr(common, "GRAPH_ROWS", 5)  # more rows get more tasks
    assert {r.node: r.component for r in common.components(frame).collect()} == want
    assert tasks["low"][0] > cores and tasks["edges"][1] > cores
