"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.check_oracles import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    rows, wrong = differences(spark, con, name, sf_dir)
    spark.catalog.clearCache()
    assert wrong is None
    assert rows > 0


def test_entry_has_a_stable_schema(spark):
    assert entry.entry(spark).dtypes == [("year_month", "string"), ("term", "string"), ("n", "bigint")]


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["word_count", "term_mentions", "lsh_matches", "ranked_neighbours"])
def test_plans_have_no_cross_join(spark, sf_dir, name):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    plan = entry.queries()["word_count"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan or "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_mentions_of_the_parsed_files_equal_those_of_the_source(spark, sf_dir):
    a, b = (sorted(entry.queries()[n](spark, sf_dir).collect()) for n in ("term_mentions", "blog_industry_mentions"))
    assert sorted((r.year_month, r.term, r.n) for r in a) == sorted((r.year_month, r.term, r.n) for r in b)
