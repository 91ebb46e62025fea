"""The SQL of the operators on the hard small tables, and shards of repeated rows."""

import pytest

from tessella.llm import sharding
from tessella.llm.oracles import ORACLES
from tessella.llm.queries import QUERIES
from tests.check_oracles import rows_of
from tests.llm.test_queries import hard  # noqa: F401

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", ["op3_nn_descent", "op4_warc_round_trip", "op6_ngram_jaccard", "op8_suffix_dedup", "op10_shard_bytes"])
def test_sql_on_hard_tables(spark, hard, name):  # noqa: F811
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{hard}/{table}.parquet')")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, hard)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_repeated_rows_are_counted_then_written_out(spark):
    rows = [(1, "hot " * 30)] * 500 + [(None, None)] * 300 + [(i, f"text {i}") for i in range(400)] + [(1, "")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole, chunked = (sorted(map(str, sharding.shard_by_bytes(docs, 8, chunk=c).collect())) for c in (1 << 16, 70))
    assert whole == chunked and len(whole) == len(rows)
    got = sharding.shard_by_bytes(docs, 8, chunk=70).collect()
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sorted(slots) == list(range(8))
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in got) + 0.01 * sum(sizes) / 8
