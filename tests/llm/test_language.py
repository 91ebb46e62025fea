"""Learning every language, and rejecting what is none of them."""

import random

import numpy as np
import pytest

from tessella.llm import language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_strange_texts_are_rejected(spark, model):
    rng = random.Random(1)
    russian = "съешь же ещё этих мягких французских булок да выпей чаю".split()
    greek = "και το νερό της θάλασσας είναι βαθύ όπου ο ήλιος δεν φτάνει".split()
    letters = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))
    strange = [" ".join(rng.choices(words, k=60)) for words in (russian, greek) for _ in range(20)]
    strange += [" ".join(letters() for _ in range(80)) for _ in range(20)]
    strange += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=600)) for _ in range(20)]
    _, _, rejected = language.classify(strange, model)
    assert sum(rejected) >= 0.95 * len(rejected)


def test_known_texts_are_kept(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL")
    texts = [r.text for r in docs.select("text").collect() if language.has_letter(r.text)]
    _, _, rejected = language.classify(texts, model)
    assert sum(rejected) <= 0.01 * len(rejected)
    parts = [t[i : i + 40] for t in texts[:300] if len(t) > 400 for i in (50, 200) if language.has_letter(t[i : i + 40])]
    _, _, rejected = language.classify(parts, model)
    assert sum(rejected) <= 0.03 * len(rejected)


def test_rare_languages_are_learned(spark):
    rng = random.Random(2)
    words = {f"l{n}": ["".join(rng.choices("aeioubcdfglmnprst", k=5)) for _ in range(30)] for n in range(90)}
    rows = [(n * 10 + i, " ".join(rng.choices(words[lang], k=40)), lang) for n, lang in enumerate(words) for i in range(3 if n else 60)]
    rows += [(5, rows[5][1], "l0")] * 50 + [(None, "no id", "l1"), (7, None, "l2"), (8, "", "l3"), (9, "no language", None)]
    found = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_per_lang=20)
    assert len(found.langs) > 64
    texts = [" ".join(rng.choices(words[lang], k=40)) for lang in found.langs]
    told, _, _ = language.classify(texts, found)
    assert np.mean([a == b for a, b in zip(told, found.langs)]) >= 0.95


def test_cosines_equal_plain_counts(model):
    texts = ["Über 3 kleine Häuser", "the house of the river", "x", "été"]
    for text, row in zip(texts, language.gram_counts(texts)):
        plain = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in f" {text.lower()} ".encode())
        expected = np.zeros(language.DIM)
        for width in (2, 3):
            for i in range(len(plain) - width + 1):
                gram = plain[i : i + width]
                code = gram[0] * 257 + gram[1]
                code = code if width == 2 else code * 263 + gram[2] + (1 << 40)
                expected[(code * 0x9E3779B97F4A7C15 % (1 << 64)) >> 52] += 1
        assert row.tolist() == expected.tolist()
        v = np.log1p(expected) * model.idf
        cosines = [float(v @ c) / np.linalg.norm(v) for c in model.centroids]
        langs, scores, _ = language.classify([text], model)
        assert langs == [model.langs[model.owner[int(np.argmax(cosines))]]]
        assert abs(scores[0] - min(1.0, max(0.0, max(cosines)))) < 1e-4
