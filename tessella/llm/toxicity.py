"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as a learned vector of its letters' hash and the mean of learned vectors of its
character trigrams; a word of over ``LONGEST`` characters is read as several.  Windows of ``WINDOW`` words, one starting every ``STRIDE``, are read both ways by
gated recurrent units; attention pools the states, and a logistic output gives the window's
score.  A text's score is its highest window's.  Training knows labels of texts only: windows of
clean texts count as clean, and of a toxic text the windows that score highest so far count as toxic.
"""

import zlib
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import learnable

WINDOW, STRIDE = 24, 16
WORDS, GRAMS = 1 << 13, 1 << 11
WORD_DIM, GRAM_DIM, HIDDEN = 8, 8, 10
#: Windows per step of numpy work.
STEP = 2_048
#: Known words of a worker; it starts anew beyond that.
KEPT_WORDS = 200_000


def _spot(text: str, size: int) -> int:
    h = zlib.crc32(text.encode("utf-8", "replace"))
    return (h ^ (h >> 15)) % size


@lru_cache(maxsize=100_000)
def _gram(text: str) -> int:
    return 1 + _spot(text, GRAMS - 1)


#: Place of all words, or trigrams, that too few training texts hold to be learned alone: one in
#: ``TEXTS_EACH``, though at most ``LEAST_TEXTS`` are asked for.
RARE = 0
LEAST_TEXTS = 15
TEXTS_EACH = 85
#: Share of words that enter a training step by their trigrams alone.
TRIGRAMS_ALONE = 0.4


#: Characters of the longest word that is read as one.
LONGEST = 64


def words_of(text: str | None) -> list[str]:
    """The words of a text in lower case; longer ones are cut, so that every character is in one."""
    words = (text or "").lower().split()
    if max(map(len, words), default=0) > LONGEST:
        words = [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    return words


def word_inputs(word: str) -> tuple[int, list[int]]:
    """Places of a word and of its character trigrams; only its letters count if it has any."""
    plain = word if word.isalpha() else "".join(filter(str.isalpha, word)) or word
    framed = f"<{plain}>"
    return 1 + _spot(plain, WORDS - 1), [_gram(framed[i : i + 3]) for i in range(len(framed) - 2)] or [RARE]


def window_starts(n: int) -> list[int]:
    """Starts of the windows that cover ``n`` words; the last one may be shorter."""
    return list(range(0, max(1, n - WINDOW + STRIDE), STRIDE)) if n > WINDOW else [0]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    p: dict = field(default_factory=dict)
    #: Whether a place was met in enough training texts.
    common_words: np.ndarray = field(default_factory=lambda: np.ones(WORDS, bool))
    common_grams: np.ndarray = field(default_factory=lambda: np.ones(GRAMS, bool))

    @classmethod
    def new(cls, seed: int):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + GRAM_DIM, HIDDEN
        shape = {"word": (WORDS, WORD_DIM), "gram": (GRAMS, GRAM_DIM), "att": (2 * h, h), "att_v": (h,), "out": (2 * h,)}
        for way in "fb":
            shape |= {f"x{way}": (d, 3 * h), f"h{way}": (h, 3 * h)}
        p = {k: (rng.normal(size=s) * (0.3 if k in ("word", "gram", "out", "att_v") else 1 / np.sqrt(s[0]))).astype(np.float32) for k, s in shape.items()}
        p |= {"bf": np.zeros(3 * h, np.float32), "bb": np.zeros(3 * h, np.float32), "bias": np.zeros(1, np.float32)}
        return cls(p)

    def inputs(self, spots: list[tuple[int, list[int]]]) -> np.ndarray:
        """Input vectors of words."""
        if not spots:
            return np.zeros((0, WORD_DIM + GRAM_DIM), np.float32)
        words = np.array([w for w, _ in spots])
        many = np.array([len(g) for _, g in spots])
        grams = np.fromiter(chain.from_iterable(g for _, g in spots), np.int64, int(many.sum()))
        words = np.where(self.common_words[words], words, RARE)
        grams = np.where(self.common_grams[grams], grams, RARE)
        sums = np.add.reduceat(self.p["gram"][grams], np.cumsum(many) - many, axis=0)
        return np.hstack([self.p["word"][words], (sums / many[:, None]).astype(np.float32)])

    def plain(self, spots):
        """Places with those of rare words and trigrams put together."""
        words, grams = self.common_words, self.common_grams
        return [(w if words[w] else RARE, [j if grams[j] else RARE for j in g]) for w, g in spots]

    def projected(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x @ self.p["xf"] + self.p["bf"], x @ self.p["xb"] + self.p["bb"]

    def _read(self, x, mask, way, keep):
        """States of one direction over ``steps x windows x 3 HIDDEN`` inputs; padding holds the state."""
        h, u, size = HIDDEN, self.p[f"h{way}"], x.shape[1]
        state = np.zeros((size, h), np.float32)
        states, saved = np.zeros((len(x), size, h), np.float32), [None] * len(x)
        for t in range(len(x)) if way == "f" else reversed(range(len(x))):
            gates = _sigmoid(x[t, :, : 2 * h] + state @ u[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            c = np.tanh(x[t, :, 2 * h :] + (r * state) @ u[:, 2 * h :])
            m = mask[t][:, None]
            new = state + m * z * (c - state)
            if keep:
                saved[t] = (state, z, r, c)
            states[t] = state = new
        return states, saved

    def forward(self, xf, xb, mask, keep=False):
        """Scores of windows from projected inputs (``steps x windows x 3 HIDDEN``)."""
        sf, kf = self._read(xf, mask, "f", keep)
        sb, kb = self._read(xb, mask, "b", keep)
        both = np.concatenate([sf, sb], axis=2)
        inner = np.tanh(both @ self.p["att"])
        weight = inner @ self.p["att_v"]
        weight = np.exp(weight - weight.max(axis=0)) * mask
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", weight, both)
        score = _sigmoid(pooled @ self.p["out"] + self.p["bias"])
        return (score, (kf, kb, both, inner, weight, pooled)) if keep else score

    def gradients(self, words, spots, mask, target, rate):
        """Gradients of the mean log loss of windows of ``words`` (``steps x windows``, into ``spots``)."""
        p, h = self.p, HIDDEN
        alone = np.random.default_rng(len(spots)).random(len(spots)) < TRIGRAMS_ALONE
        spots = [(RARE if a else w, g) for a, (w, g) in zip(alone, spots)]
        x = self.inputs(spots)
        pf, pb = self.projected(x)
        score, (kf, kb, both, inner, weight, pooled) = self.forward(pf[words], pb[words], mask, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d = ((score - target) * rate / len(target)).astype(np.float32)
        g["out"], g["bias"] = pooled.T @ d, np.array([d.sum()])
        d_pool = d[:, None] * p["out"]
        d_both = weight[:, :, None] * d_pool
        d_weight = np.einsum("tnh,nh->tn", both, d_pool)
        d_weight = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["att_v"] = np.einsum("tn,tnk->k", d_weight, inner)
        d_inner = d_weight[:, :, None] * p["att_v"] * (1 - inner**2)
        g["att"] = np.einsum("tnh,tnk->hk", both, d_inner)
        d_both = d_both + d_inner @ p["att"].T
        d_x = np.zeros_like(x)
        for way, saved, own in (("f", kf, d_both[:, :, :h]), ("b", kb, d_both[:, :, h:])):
            u, carry = p[f"h{way}"], np.zeros_like(own[0])
            d_in = np.zeros(words.shape + (3 * h,), np.float32)
            for t in reversed(range(len(words))) if way == "f" else range(len(words)):
                state, z, r, c = saved[t]
                m = mask[t][:, None]
                d_new = own[t] + carry
                d_c = d_new * m * z * (1 - c**2)
                d_z = d_new * m * (c - state) * z * (1 - z)
                back = d_c @ u[:, 2 * h :].T
                d_r = back * state * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], axis=1)
                carry = d_new * (1 - m * z) + back * r + d_zr @ u[:, : 2 * h].T
                g[f"h{way}"][:, : 2 * h] += state.T @ d_zr
                g[f"h{way}"][:, 2 * h :] += (r * state).T @ d_c
                d_in[t] = np.concatenate([d_zr, d_c], axis=1)
            flat = d_in.reshape(-1, 3 * h)
            per_word = np.zeros((len(x), 3 * h), np.float32)
            np.add.at(per_word, words.ravel(), flat)
            g[f"b{way}"] = flat.sum(axis=0)
            g[f"x{way}"] = x.T @ per_word
            d_x += per_word @ p[f"x{way}"].T
        spots = self.plain(spots)
        np.add.at(g["word"], [w for w, _ in spots], d_x[:, :WORD_DIM])
        for row, (_, grams) in zip(d_x[:, WORD_DIM:], spots):
            np.add.at(g["gram"], grams, row / max(1, len(grams)))
        return g


def _windows(texts: list[str | None]):
    """Distinct words, ``steps x windows`` word places, mask, and the text of each window."""
    known: dict[str, int] = {}
    rows, owner = [], []
    for i, text in enumerate(texts):
        ids = [known.setdefault(w, len(known)) for w in words_of(text)]
        for start in window_starts(len(ids)) if ids else ():
            rows.append(ids[start : start + WINDOW])
            owner.append(i)
    words, mask = np.zeros((WINDOW, len(rows)), np.int64), np.zeros((WINDOW, len(rows)), np.float32)
    for j, row in enumerate(rows):
        words[: len(row), j], mask[: len(row), j] = row, 1
    return list(known), words, mask, np.array(owner, np.int64)


def train(texts: list[str], toxic: list[int], seed: int = 1, epochs: int = 10, batch: int = 128, rate: float = 0.01) -> Network:
    """Fit a network to labelled texts.  Of toxic texts, the best window counts as toxic, and after
    the first epochs those above 0.9; others are left out.  At first the best is the one with the most
    telling word or trigram, by its share of toxic and of clean texts.  Clean windows are
    thinned to those that score highest and eight times as many at random.  Four words of
    ten enter by their trigrams alone, so that a word's stem counts and texts are not learned by heart."""
    net, rng = Network.new(seed), np.random.default_rng(seed)
    vocabulary, words, mask, owner = _windows(texts)
    spots = [word_inputs(w) for w in vocabulary]
    label = np.array(toxic, np.float32)[owner]
    telling = _telling(net, spots, words, mask, owner, np.array(toxic))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        score = _score_windows(net, spots, words, mask) if epoch else telling
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, score)
        chosen = np.flatnonzero((label == 1) & ((score >= best[owner] - 1e-6) | (epoch > 2) & (score > 0.9)))
        clean = np.flatnonzero(label == 0)
        hard = clean[np.argsort(-score[clean], kind="stable")[: len(chosen)]]
        use = np.concatenate([chosen, hard, rng.choice(clean, min(len(clean), 8 * len(chosen)), replace=False)])
        use = rng.permutation(use)
        for i in range(0, len(use), batch):
            at = use[i : i + batch]
            own, places = np.unique(words[:, at], return_inverse=True)
            g = net.gradients(places.reshape(WINDOW, -1), [spots[w] for w in own], mask[:, at], label[at], 1.0)
            step += 1
            for k, (one, two) in moment.items():
                one += 0.1 * (g[k] - one)
                two += 0.01 * (g[k] ** 2 - two)
                net.p[k] *= 1 - 0.02 * rate
                net.p[k] -= (rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def _telling(net: Network, spots, words, mask, owner, toxic) -> np.ndarray:
    """For each window the highest log odds of a word or trigram; marks the common ones in ``net``."""
    odds = []
    texts_of: list[set] = [set() for _ in spots]
    for j in range(words.shape[1]):
        for w in set(words[: int(mask[:, j].sum()), j].tolist()):
            texts_of[w].add(int(owner[j]))
    for size, places, common in ((WORDS, lambda s: [s[0]], net.common_words), (GRAMS, lambda s: s[1], net.common_grams)):
        holders: list[set] = [set() for _ in range(size)]
        for s, t in zip(spots, texts_of):
            for place in places(s):
                holders[place] |= t
        bad = np.array([sum(int(toxic[i]) for i in h) for h in holders], float)
        all_ = np.array([len(h) for h in holders], float)
        common[:] = all_ >= min(LEAST_TEXTS, max(2, round(len(toxic) / TEXTS_EACH)))
        share, other = (bad + 1) / (toxic.sum() + 2), (all_ - bad + 1) / ((1 - toxic).sum() + 2)
        own = np.where(common, np.log(share / other), -np.inf)
        odds.append(np.array([max(own[p] for p in places(s)) for s in spots]))
    each = np.maximum(*odds)
    return np.where(mask > 0, each[words], -np.inf).max(axis=0)


def _score_windows(net: Network, spots, words, mask) -> np.ndarray:
    pf, pb = net.projected(net.inputs(spots))
    parts = [net.forward(pf[words[:, i : i + STEP]], pb[words[:, i : i + STEP]], mask[:, i : i + STEP]) for i in range(0, words.shape[1], STEP)]
    return np.concatenate([np.zeros(0), *parts])


class Scorer:
    """Scores texts; keeps the projected inputs of words it has met."""

    def __init__(self, net: Network):
        self.net = net
        self._clear()

    def _clear(self):
        self.known: dict[str, int] = {}
        self.forward = np.zeros((1024, 3 * HIDDEN), np.float32)
        self.back = np.zeros((1024, 3 * HIDDEN), np.float32)

    def _learn(self, words: list[str]) -> None:
        start, end = len(self.known), len(self.known) + len(words)
        self.known.update(zip(words, range(start, end)))
        if end > len(self.forward):
            self.forward = np.resize(self.forward, (2 * end, 3 * HIDDEN))
            self.back = np.resize(self.back, (2 * end, 3 * HIDDEN))
        self.forward[start:end], self.back[start:end] = self.net.projected(self.net.inputs([word_inputs(w) for w in words]))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Highest window score of each text; 0 for null and for texts without words."""
        out = np.zeros(len(texts))
        rows, owner = [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            words = words_of(text)
            if len(self.known) > KEPT_WORDS and len(words) < KEPT_WORDS:
                self._flush(rows, owner, out)
                rows, owner = [], []
                self._clear()
            fresh = list({w for w in words if w not in self.known})
            if fresh:
                self._learn(fresh)
            ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            if not len(ids):
                continue
            starts = np.array(window_starts(len(ids)))
            at = starts[:, None] + np.arange(WINDOW)
            rows.append(np.where(at < len(ids), ids[np.minimum(at, len(ids) - 1)], -1))
            owner += [i] * len(starts)
            if len(owner) >= STEP:
                self._flush(rows, owner, out)
                rows, owner = [], []
        self._flush(rows, owner, out)
        return out

    def _flush(self, rows, owner, out):
        if not owner:
            return
        words = np.concatenate(rows).T
        owner = np.array(owner)
        for i in range(0, len(owner), STEP):
            part = words[:, i : i + STEP]
            mask = (part >= 0).astype(np.float32)
            score = self.net.forward(self.forward[np.maximum(part, 0)], self.back[np.maximum(part, 0)], mask)
            np.maximum.at(out, owner[i : i + STEP], score)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1_000, most_chars: int = 4_000, seed: int = 1) -> Network | None:
    """Train on ``docs (doc_id, text)`` with ``labels (doc_id, toxic)``, of ids whose crc32 mod 4 is not 2.

    The sample is bounded: at most ``per_class`` texts of each label, of at most ``most_chars``
    characters, drawn by a hash of the id; at most 32 MB reach the driver.  Where an id
    is labelled twice the higher label holds.  None if either label has no text.
    """
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select("doc_id", "text").where(learnable(F.col("doc_id")) & F.length("text").between(1, most_chars))
    rows = known.where(learnable(F.col("doc_id"))).withColumn("draw", F.xxhash64("doc_id", F.lit(seed)))
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect() if r.toxic in (0, 1)}
    share = lambda c: min(1.0, 2.5 * per_class / sizes[c])
    sample = []
    for c in sizes:
        # a threshold on the draw first, so that only a little more than asked for is sorted
        near = rows.where((F.col("toxic") == c) & (F.col("draw") <= F.lit(min(2**63 - 1, int(-(2**63) + share(c) * 2**64)))))
        picked = texts.join(F.broadcast(near.limit(4 * per_class)), "doc_id")
        sample += [(r.draw, r.text, c) for r in picked.orderBy("draw").limit(per_class).select("draw", "text").collect()]
    if len({c for *_, c in sample}) < 2:
        return None
    sample.sort()
    return train([t for _, t, _ in sample], [c for *_, c in sample], seed)


def toxicity_of(net: Network | None):
    """A column function: text to a score of 0 to 1, over all windows of whole texts.

    Null, empty and wordless texts score 0, as do all if there was nothing to learn from.
    """
    scorer = None

    def score(text: pa.Array) -> pa.Array:
        nonlocal scorer
        if net is None:
            return pa.array(np.zeros(len(text)))
        scorer = scorer or Scorer(net)
        return pa.array(np.clip(scorer.scores(text.to_pylist()), 0, 1).astype(np.float64))

    return F.arrow_udf(score, "double")
