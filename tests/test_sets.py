from hypothesis import given
from hypothesis import strategies as st

from tests.test_text import FEW
from tessella.operators import sets as E
from tessella.operators.keyed_jobs import map_reduce
from tessella.sources.memory import SETS, from_pairs


def sets(spark, r, s, kind="string"):
    return from_pairs(spark, [("R", r), ("S", s)], SETS.replace("array<string>", f"array<{kind}>"))


def elements(df):
    return sorted((r.element for r in df.collect()), key=lambda x: (x is None, x))


def test_two_differences_on_named_sets(spark):
    members = E.membership(sets(spark, ["apple", "orange", "pear", "blueberry"], ["pear", "orange", "fig"]))
    assert elements(E.set_difference(members)) == ["apple", "blueberry"]
    assert elements(E.set_difference_once(members)) == ["apple", "blueberry"]


def test_differences_disagree_on_repeats_and_keep_null(spark):
    members = E.membership(sets(spark, ["a", "a", "b", None], ["c", "c"]))
    assert elements(E.set_difference(members)) == ["a", "b", None]
    assert elements(E.set_difference_once(members)) == ["b", None]


@FEW
@given(st.lists(st.integers(0, 12), max_size=15), st.lists(st.integers(0, 12), max_size=15))
def test_differences_equal_python_sets(spark, r, s):
    members = E.membership(sets(spark, r, s, "bigint"))
    assert elements(E.set_difference(members)) == sorted(set(r) - set(s))
    assert elements(E.set_difference_once(members)) == sorted(x for x in set(r) if (r + s).count(x) == 1)
    held = {row.element: row.labels for row in E.labels_per_element(members).collect()}
    assert held == {x: ["R"] * (x in r) + ["S"] * (x in s) for x in set(r + s)}


def test_key_buckets_equal_a_plain_sum(spark):
    keys = ["", "a", "the", "horse,", "é", "日本", "😀x"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.bucket for r in E.key_bucket(df, "k", 3).collect()}
    assert got == {k: sum(map(ord, k)) % 3 for k in keys}
    numbers = spark.createDataFrame([(k,) for k in (-7, 0, 8, 9)], "k bigint")
    assert {r.k: r.bucket for r in E.key_bucket(numbers, "k", 3).collect()} == {k: k % 3 for k in (-7, 0, 8, 9)}
    assert {r.bucket: r.n for r in E.bucket_report(numbers, "k", 3).collect()} == {2: 2, 0: 2}


def test_map_reduce_jobs(spark):
    docs = spark.createDataFrame([(i, "The sea the sky") for i in range(50)], "k int, v string").repartition(6)
    for slices in (1, 4):
        counted = map_reduce(
            docs,
            lambda _k, text: ((w, 1) for w in text.lower().split()),
            combine_fn=lambda _k, ns: [sum(ns)],
            reduce_fn=lambda w, ns: (w, sum(ns)) if w != "sky" else None,
            pair_schema="word string, n bigint",
            out_schema="word string, n bigint",
            slices=slices,
        )
        assert {r.word: r.n for r in counted.collect()} == {"the": 100, "sea": 50}


def test_map_reduce_shortens_a_hot_key_in_the_map_tasks(spark):
    longest = spark.sparkContext.accumulator(0)

    def reduce_fn(k, vs):
        longest.add(len(vs))
        return (k, sum(vs))

    rows = spark.range(60_000, numPartitions=6).selectExpr("id", "1 AS one")
    out = map_reduce(
        rows,
        lambda _k, one: [("hot", one)],
        combine_fn=lambda _k, vs: [sum(vs)],
        reduce_fn=reduce_fn,
        pair_schema="k string, n bigint",
        out_schema="k string, n bigint",
        slices=3,
    )
    assert out.collect() == [("hot", 60_000)]
    assert longest.value <= 3
