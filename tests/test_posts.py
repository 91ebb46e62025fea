import re

import pytest
from pyspark.sql import functions as F

from tessella.functions import markup
from tessella.operators import posts as P
from tessella.operators.text import vocabulary
from tessella.plans.blog import blog_industry_mentions
from tessella.sources.files import list_files, read_binary, read_records, read_whole_text

FILES = {
    "1.f.20.Law.Leo.xml": "<Blog>\r\n\r\n<date>31,May,2004</date>\r\n<post>\r\n\r\nLaw is law; lawful is not.\r\n</post>\r\n"
    "\r\n<date>02,June,2004</date>\r\n<post>non-profit LAW</post>\r\n</Blog>",
    "2.m.30.Non-Profit.Leo.xml": "<BLOG>\n<date>02,June,2004</date><POST>A Non-Profit, a nonprofit.</post>\n</Blog>\n",
    "3.m.30.Arts.Leo.xml": "<Blog><date>01,May,2003</date><post>arts</post>no date here</post></Blog>",
}

WANT = {
    "Law": [("2004-June", 1), ("2004-May", 2)],
    "Non-Profit": [("2004-June", 2)],
    "Arts": [("2003-May", 1)],
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("blogs")
    for name, content in FILES.items():
        (path / name).write_bytes(content.encode())
    (path / "nested").mkdir()
    (path / "nested" / "9.m.9.Hidden.x.xml").write_text("not listed")
    return str(path)


def test_listing_and_reading(spark, folder):
    assert {r.file_name: r.length for r in list_files(spark, folder).collect()} == {
        k: len(v) for k, v in FILES.items()
    }
    whole = {r.file_name: r.content for r in read_whole_text(spark, folder).collect()}
    assert whole == FILES
    assert {bytes(r.content).decode() for r in read_binary(spark, folder, "1*").collect()} == {FILES["1.f.20.Law.Leo.xml"]}


def test_content_is_not_read_to_list_files(spark, folder):
    plan = list_files(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_the_whole_job_with_both_readers(spark, folder):
    for whole_files in (True, False):
        rows = blog_industry_mentions(spark, folder, whole_files=whole_files).collect()
        assert {r.term: [tuple(m) for m in r.months] for r in rows} == WANT


def test_records_split_a_file_over_tasks(spark, folder, tmp_path):
    entry = "<date>02,June,2004</date>\r\n<post>\r\nsome law here\r\n</post>\r\n"
    (tmp_path / "7.m.3.Law.x.xml").write_text("<Blog>" + entry * 3000 + "</Blog>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        records = read_records(spark, str(tmp_path), "</post>")
        assert records.rdd.getNumPartitions() > 5
        assert P.posts(records).count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parts_without_date_are_rejected_not_fatal(spark, folder):
    contents = read_whole_text(spark, folder)
    assert [tuple(r) for r in P.rejected_posts(contents).collect()] == [("3.m.30.Arts.Leo.xml", 1)]
    assert P.posts(contents).count() == 4


def test_cleaning_steps(spark):
    df = spark.createDataFrame([("<bLoG>  a\r\nb\nc<POST> d</POST>",)], "c string")
    row = df.select(
        markup.strip_open_tag(F.col("c"), "Blog").alias("blog"),
        markup.strip_crlf(F.col("c")).alias("crlf"),
        markup.strip_open_tag(F.col("c"), "post", eat_space=False).alias("post"),
        markup.clean_markup(F.col("c")).alias("all"),
    ).first()
    assert row.blog == "a\r\nb\nc<POST> d</POST>"
    assert row.crlf == "<bLoG>  ab\nc<POST> d</POST>"
    assert row.post == "<bLoG>  a\r\nb\nc d</POST>"
    assert row["all"] == "ab\nc d</POST>"


def test_text_after_a_second_date_close_is_lost_and_dates_parse(spark):
    df = spark.createDataFrame([("<Date> 1,May,2004</date>one</date>two",), ("nothing",)], "c string")
    rows = df.select(
        markup.date_text(F.col("c")).alias("d"),
        markup.body_text(F.col("c")).alias("b"),
        markup.post_date(markup.date_text(F.col("c"))).alias("day"),
    ).collect()
    assert (rows[0].d, rows[0].b, str(rows[0].day)) == ("1,May,2004", "one", "2004-05-01")
    assert rows[1].b is None and rows[1].day is None


TERMS = [
    "law", "Law", "non-profit", "real estate", "ha-ha", "a-b-a", "c++", ".net", "+", "new new", "çok", "kind",
    "mass", "x_y", "\\E", "a.b", "--", "real  estate",
]
BODIES = [
    "Law law lawful LAW's in-law; non-profit NON-PROFIT nonprofit non--profit",
    "real estate, Real Estate real  estate real\nestate unreal estate",
    "ha-ha-ha ha-ha ha-ha-ha-ha", "a-b-a-b-a a-b-a", "c++x c++ xc++y 1c++2 c+++x", "asp.net .net x.net.y",
    "1+1 +1 1+ a+b+c", "new new new new newer", "Çok çok ço k", "Kind kınd KIND", "maſſ MASS mas",
    "x_y x-y x_y_z", "a\\E b\\Ec", "a.b aXb a.b.c", "a--b a---b --", "", "   ",
]


def expected_mentions(terms, bodies):
    out = {}
    for term in terms:
        n = sum(len(re.findall(r"\b" + re.escape(term) + r"\b", b, re.IGNORECASE)) for b in bodies)
        if n:
            out[term] = n
    return out


@pytest.mark.parametrize("max_broadcast_terms", [1000, 3, 1])
def test_mentions_equal_a_python_scan(spark, max_broadcast_terms):
    dated = spark.createDataFrame([("2004", "May", b) for b in BODIES], "year string, month string, body string")
    terms = spark.createDataFrame([(t,) for t in TERMS], "term string")
    want = expected_mentions(TERMS, BODIES)
    assert len(want) > 14
    found = P.term_mentions(dated, terms, max_broadcast_terms).collect()
    assert {r.term: r.n for r in found} == want
    assert len(found) == len(want)
    assert {r.year_month for r in found} == {"2004-May"}
    scanned = P.term_mentions_by_scan(dated, TERMS).collect()
    assert {r.term: r.n for r in scanned} == want


def test_no_pairing_of_every_post_with_every_term(spark):
    dated = spark.createDataFrame([("2004", "May", "a law")], "year string, month string, body string")
    terms = vocabulary(spark.createDataFrame([("1.f.2.law.xml",)], "file_name string"))
    for bound in (10, 0):
        plan = P.term_mentions(dated, terms, bound or 1)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sigma_counts_alike_inside_and_at_the_end_of_words(spark):
    import re

    from pyspark.sql import functions as F

    from tessella.functions.markup import count_term

    cases = [("ΟΔΟΣ οδος ΟΔΟΣ. οδοσ", "οδος"), ("ΣΟΦΟΣ σοφός ΣΟΦΟΣ", "σοφος"), ("ΚΟΣΜΟΣ κόσμος", "ΚΟΣΜΟΣ"), ("µm ΜM", "μm")]
    rows = spark.createDataFrame(cases, "body string, term string").select("body", "term", count_term(F.col("body"), F.col("term")).alias("n"))
    for r in rows.collect():
        assert r.n == len(re.findall(rf"\b{re.escape(r.term)}\b", r.body, re.IGNORECASE)), r
