"""Language of a text by the nearest of several centroids per language.

A text is a vector of hashed 2- and 3-byte grams of its lower-case UTF-8, letters and one space for
the rest, weighted by sublinear term frequency and inverse document frequency and scaled to length
1.  Each language has a few centroids from spherical k-means over a sample of its texts.  The
nearest centroid by cosine gives the language; a text whose cosine is under the rejection cosine of
that language for texts of its length, or without a letter, is rejected.  Rejection cosines come from
texts that their centroids have not seen, in pieces of several lengths.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import broadcast_checked, give_back_memory, learnable

DIM = 4096
#: Texts per step of numpy work.
STEP = 256
UNKNOWN = "und"
#: Texts are rejected by the power of two below their number of different grams, 2**0 to ``DIM``.
LENGTHS = 13
#: Languages whose centroids (64 KB each) fit one process; more stop the job.
MOST_LANGS = 5_000

_PLAIN = np.arange(256, dtype=np.uint64)
_PLAIN[[i for i in range(128) if not chr(i).isalpha()]] = 0x20


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray  # DIM
    centroids: np.ndarray  # many x DIM
    owner: np.ndarray  # language of each centroid
    reject_below: np.ndarray  # languages x LENGTHS


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """``len(texts) x DIM`` counts of hashed grams over whole texts."""
    out = np.zeros((len(texts), DIM), np.float32)
    for i, text in enumerate(texts):
        if not text:
            continue
        b = _PLAIN[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
        two = b[:-1] * np.uint64(257) + b[1:]
        three = two[:-1] * np.uint64(263) + b[2:] + np.uint64(1 << 40)
        for codes in (two, three):
            spot = (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
            out[i] += np.bincount(spot.astype(np.int64), minlength=DIM)
    return out


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _document_frequency(batches):
    total = np.zeros(DIM, np.int64)
    rows = 0
    for batch in batches:
        texts = batch.column(0)
        for i in range(0, len(texts), STEP):
            counts = gram_counts(texts.slice(i, STEP).to_pylist())
            total += (counts > 0).sum(axis=0)
            rows += len(counts)
        give_back_memory()
    spots = [-1, *range(DIM)]  # -1: number of texts
    yield pa.RecordBatch.from_arrays([pa.array(spots, pa.int32()), pa.array([rows, *total.tolist()], pa.int64())], ["spot", "n"])


def _spherical_means(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = np.array([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def length_class(counts: np.ndarray) -> np.ndarray:
    """By different grams, so that a text that repeats a line counts as short as the line."""
    return np.log2(np.maximum((counts > 0).sum(axis=1), 1)).astype(np.int64)


def _pieces(text: str) -> list[str]:
    """The text, and pieces of it of 8, 16, 32 .. characters from its start, middle and end."""
    out, n = [text], 8
    while n < len(text):
        out += [text[at : at + n] for at in (0, (len(text) - n) // 2, len(text) - n)]
        n *= 2
    return out


def reject_cosines(texts: list[str], centroids: np.ndarray, idf: np.ndarray, quantile: float, slack: float) -> np.ndarray:
    """For each length class, ``slack`` times the ``quantile`` of the cosines of pieces of ``texts``; a
    class with under 20 pieces takes that of the class below it, the shortest 0."""
    found: list[list[float]] = [[] for _ in range(LENGTHS)]
    for text in texts:
        pieces = [p for p in _pieces(text) if has_letter(p)]
        for i in range(0, len(pieces), STEP):
            counts = gram_counts(pieces[i : i + STEP])
            near = (vectors(counts, idf) @ centroids.T).max(axis=1)
            for at, cosine in zip(length_class(counts), near):
                found[at].append(float(cosine))
    out = np.zeros(LENGTHS)
    for at, cosines in enumerate(found):
        out[at] = slack * np.quantile(cosines, quantile) if len(cosines) >= 20 else out[at - 1] if at else 0.0
    return out


def _one_language(idf: np.ndarray, clusters: int, quantile: float, slack: float, seed: int):
    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        texts = group.column("text").to_pylist()
        x = np.vstack([vectors(gram_counts(texts[i : i + STEP]), idf) for i in range(0, len(texts), STEP)])
        # a third of the texts is kept from the centroids that set the rejection cosines
        aside = np.arange(len(texts)) % 3 == 2
        below = np.zeros(LENGTHS)
        if aside.any():
            below = reject_cosines([t for t, a in zip(texts, aside) if a], _spherical_means(x[~aside], clusters, seed), idf, quantile, slack)
        c = _spherical_means(x, clusters, seed)
        return pa.table({
            "lang": pa.array([group.column("lang")[0].as_py()]),
            "centroids": pa.array([[row.tobytes() for row in c.astype(np.float32)]], pa.list_(pa.binary())),
            "below": pa.array([below.tolist()], pa.list_(pa.float64())),
        })

    return learn


def fit(
    docs: DataFrame, sample_per_lang: int = 300, clusters: int = 4, quantile: float = 0.01, slack: float = 0.8, seed: int = 1
) -> Model | None:
    """Learn from ``docs (doc_id, text, lang)``: rows with a language, a text and an id whose
    crc32 mod 4 is not 2.

    Document frequencies cover all such rows, and every language is learned, however rare.
    Centroids come from a bounded sample: at most ``sample_per_lang`` rows of each language, drawn by a
    hash of id and text (repeated rows are drawn together, up to that number), in a task for each
    language; only centroids, 64 KB a language, reach the driver.  More than ``MOST_LANGS``
    languages stop with an error.  ``slack`` times the ``quantile`` of the cosines of pieces of sample
    texts with centroids that were made without them is the rejection cosine of their length.
    None if there is nothing to learn from.
    """
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & learnable(F.col("doc_id"))
    )
    seen = rows.select("text").mapInArrow(_document_frequency, "spot int, n long").groupBy("spot").agg(F.sum("n").alias("n"))
    df = np.zeros(DIM + 1)
    for r in seen.collect():  # one row per hashed gram
        df[r.spot + 1] = r.n
    if not df[0]:
        return None
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 0.05
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # a draw of 0 to 1 for each text; the share of each language leaves a few more than asked for
    draw = F.xxhash64("doc_id", "text", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    drawn = rows.withColumn("draw", draw).join(broadcast_checked(sizes), "lang").where(F.col("draw") * F.col("n") < F.lit(1.2 * sample_per_lang))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    drawn = drawn.withColumn("place", place).where(F.col("place") <= sample_per_lang).select("lang", "text", "place")
    learned = drawn.groupBy("lang").applyInArrow(
        _one_language(idf, clusters, quantile, slack, seed), "lang string, centroids array<binary>, below array<double>"
    )
    learned = sorted(learned.limit(MOST_LANGS + 1).collect(), key=lambda r: r.lang)
    if len(learned) > MOST_LANGS:
        raise ValueError(f"there are more than {MOST_LANGS} languages to learn")
    return Model(
        [r.lang for r in learned], idf.astype(np.float32),
        np.array([np.frombuffer(c, np.float32) for r in learned for c in r.centroids]),
        np.array([at for at, r in enumerate(learned) for _ in r.centroids]),
        np.array([r.below for r in learned]),
    )


def classify(texts: list[str | None], model: Model | None) -> tuple[list[str], list[float], list[bool]]:
    langs, scores, rejected = [], [], []
    for i in range(0, len(texts), STEP):
        part = texts[i : i + STEP]
        if model is None:
            langs += [UNKNOWN] * len(part)
            scores += [0.0] * len(part)
            rejected += [True] * len(part)
            continue
        counts = gram_counts(part)
        near = vectors(counts, model.idf) @ model.centroids.T
        best = near.argmax(axis=1)
        for text, j, cosine, length in zip(part, best.tolist(), near[np.arange(len(part)), best].tolist(), length_class(counts).tolist()):
            if not has_letter(text):
                langs.append(UNKNOWN), scores.append(0.0), rejected.append(True)
            else:
                at = model.owner[j]
                langs.append(model.langs[at]), scores.append(min(1.0, max(0.0, cosine)))
                rejected.append(bool(cosine < model.reject_below[at][length]))
    return langs, scores, rejected


def language_of(model: Model | None):
    """A column function: text to ``struct<lang, score, rejected>``, over whole texts.

    Null, empty and letterless texts are ``und``, score 0, rejected; so is every text when there was
    nothing to learn.  Ties go to the first centroid.
    """

    @F.arrow_udf("struct<lang: string, score: double, rejected: boolean>")
    def predict(text: pa.Array) -> pa.Array:
        langs, scores, rejected = [], [], []
        for i in range(0, len(text), STEP):  # a whole batch of texts need not be held as strings
            for out, found in zip((langs, scores, rejected), classify(text.slice(i, STEP).to_pylist(), model)):
                out += found
        give_back_memory()
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
            ["lang", "score", "rejected"],
        )

    return predict
