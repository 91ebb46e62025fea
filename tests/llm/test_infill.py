import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import infill
from tessella.llm.common import text_arrays

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
LETTERS = st.text(st.sampled_from("ab <PSM>\t\n\x0b\r\x08\x0e\x1f\x7f\x00\x85\u2003é漢😀"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), LETTERS), min_size=1, max_size=20), st.randoms(use_true_random=False))
def test_units_and_ends_equal_the_pattern(texts, rng):
    marked = infill.Marked(*text_arrays(pa.array(texts, pa.string())))
    units = [UNIT.findall(t or "") for t in texts]
    assert marked.units().tolist() == [len(u) for u in units]
    chosen = np.array([rng.randint(0, len(u)) for u in units])
    ends = marked.end_of(chosen)
    assert ends.tolist() == [len("".join(u[:k]).encode()) for u, k in zip(units, chosen)]
    assert marked.chars_before(ends).tolist() == [len("".join(u[:k])) for u, k in zip(units, chosen)]


def test_buffers_hold_whole_texts(monkeypatch):
    monkeypatch.setattr(infill, "BUFFER", 10)
    texts = ["a b " * 7, "", "x", "yy zz", None, " ", "w" * 50, "1 2"]
    n = [0] * len(texts)
    out = infill._cut_batch(pa.array(texts, pa.string()), pa.array([7] * 8), pa.array([3] * 8)).to_pylist()
    assert [r["n"] for r in out] == [len(UNIT.findall(t or "")) for t in texts]
    assert out[0] == {"n": 15, "prefix_end": 5, "middle_end": 13, "prefix_chars": 5, "middle_chars": 8}


def test_outputs_restore_and_names_pass(spark):
    rows = [(i, f"word{i} <P" * (i % 5) + " é end ", "x") for i in range(300)] + [(None, "a<M>b", "y"), (None, None, "y"), (7, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string")
    out = infill.fill_in_middle(df, share=90, spm=50)
    assert out.columns == ["doc_id", "text", "output", "infill"]
    from pyspark.sql import functions as F

    got = out.withColumn("back", infill.restored(F.col("infill.form"), F.col("infill.output"))).collect()
    assert [r.back for r in got] == [r.text or "" for r in got] and len(got) == len(rows)
    assert {r.infill.form for r in got} == {"plain", "spm", "psm"}
    assert all(r.infill.form == "plain" for r in got if not r.text or "<M>" in r.text)
    again = infill.fill_in_middle(df.repartition(5), share=90, spm=50).collect()
    assert sorted(map(str, again)) == sorted(str(r).rsplit(", back=", 1)[0] + ")" for r in got)


def test_one_pass_over_the_text(spark):
    from tessella.llm.queries import op13_fill_in_middle

    plan = op13_fill_in_middle(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.split("ArrowEvalPython", 1)[1].split("\n")[0].count("_cut_batch(") == 1
