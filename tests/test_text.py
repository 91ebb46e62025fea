import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.functions import strings
from tessella.operators import text as T
from tessella.sources.memory import DOCUMENTS, from_pairs, hash_subset, random_subset

FEW = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXTS = st.lists(st.text(alphabet="abAB éß.,\t\n\r\x1c\x1f\x85\xa0 　-", max_size=40), min_size=1, max_size=6)


def documents(spark, texts):
    return from_pairs(spark, enumerate(texts), DOCUMENTS)


def test_every_python_space_separates_words(spark):
    spaces = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    text = "".join(f"w{i}{s}" for i, s in enumerate(spaces)) + "a​b"
    got = [r.word for r in T.tokenize(documents(spark, [text])).collect()]
    assert got == text.split()


def test_word_characters_are_those_of_python(spark):
    chars = [chr(i) for i in range(1, 0x2fff) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    ours = {r.c for r in df.where(F.col("c").rlike(strings.WORD_CHAR)).collect()}
    others = {r.c for r in df.where(F.col("c").rlike(strings.NON_WORD_CHAR)).collect()}
    assert others == set(chars) - ours
    python = {c for c in chars if re.match(r"\w", c)}
    assert ours <= python
    # what Java 17 (Unicode 13) lacks are letters that it does not know at all yet
    unknown = {r.c for r in df.where(F.col("c").rlike(r"\p{Cn}")).collect()}
    assert python - ours <= unknown
    assert {"é", "_", "½", "٣", "ß"} <= ours and not {"-", "’", "‍"} & ours


@FEW
@given(TEXTS)
def test_word_count_equals_counter(spark, texts):
    want = Counter(w.lower() for t in texts for w in t.split())
    docs = documents(spark, texts)
    assert {r.word: r.n for r in T.word_count(docs).collect()} == want
    frequencies = T.term_frequency(docs)
    got = {(r.doc_id, r.word): r.n for r in frequencies.collect()}
    assert got == {(i, w): n for i, t in enumerate(texts) for w, n in Counter(t.lower().split()).items()}
    assert {r.word: r.n for r in T.sum_partials(frequencies).collect()} == want


def test_punctuation_is_kept_and_output_can_be_sorted(spark):
    docs = documents(spark, ["I sink, I swim, I sing.", "", "  Sing.\t"])
    rows = T.sort_output(T.word_count(docs), "word").collect()
    assert [tuple(r) for r in rows] == [("i", 3), ("sing.", 2), ("sink,", 1), ("swim,", 1)]


def test_term_frequency_does_not_shuffle(spark):
    plan = T.term_frequency(documents(spark, ["a b a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_vocabulary_and_short_names(spark):
    names = spark.createDataFrame(
        [("1.f.20.Law.x.xml",), ("2.m.30.Law.y.xml",), ("3.m.30.Non-Profit.y.xml",), ("short.xml",), ("a.b.c..xml",)],
        "file_name string",
    )
    assert {r.term for r in T.vocabulary(names).collect()} == {"Law", "Non-Profit"}
    assert {r.file_name for r in T.short_names(names).collect()} == {"short.xml", "a.b.c..xml"}


def test_tile_ids_round_trip_with_dashes_in_the_name(spark):
    df = spark.createDataFrame([("a-1.zip", 12), ("plain.zip", 0)], "image string, i int")
    tile = strings.tile_id(F.col("image"), F.col("i"))
    rows = df.select("image", "i", strings.tile_image(tile).alias("im"), strings.tile_index(tile).alias("ix")).collect()
    assert all((r.image, r.i) == (r.im, r.ix) for r in rows)


def test_base_name_at_any_depth(spark):
    df = spark.createDataFrame([("hdfs:/a/b/c.zip",), ("c.zip",)], "p string")
    assert {r[0] for r in df.select(strings.base_name(F.col("p"))).collect()} == {"c.zip"}


def test_random_subsets_repeat(spark):
    one, two = (random_subset(spark, 1000, 0.75, 5).collect() for _ in range(2))
    assert one == two and 150 < len(one) < 350
    ids = spark.range(2000)
    kept = hash_subset(ids, "id", 0.5, 3)
    assert 850 < kept.count() < 1150
    again = hash_subset(ids.repartition(7), "id", 0.5, 3)
    assert {r.id for r in kept.collect()} == {r.id for r in again.collect()}
