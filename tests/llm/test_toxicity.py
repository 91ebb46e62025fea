"""Toxicity: every character is read, and small samples are learned from."""

import random

import numpy as np

from tessella.llm import toxicity


def test_long_words_are_read_to_their_end():
    text = "a" * 200 + "end  " + "x" * 64 + " short"
    words = toxicity.words_of(text)
    assert "".join(words) == text.replace(" ", "") and max(map(len, words)) <= toxicity.LONGEST
    assert toxicity.words_of("Two  Words") == ["two", "words"] and toxicity.words_of(None) == toxicity.words_of(" ") == []
    net = toxicity.Network.new(1)
    one, other = toxicity.Scorer(net).scores(["q" * 300 + "abc", "q" * 300 + "xyz"])
    assert one != other


def _texts(rng, n, toxic):
    words = [f"w{rng.randrange(300)}" for _ in range(60)]
    out = []
    for _ in range(n):
        text = rng.choices(words, k=40)
        if toxic:
            text[rng.randrange(40)] = rng.choice(["vile", "awful"])
        out.append(" ".join(text))
    return out


def test_few_labelled_texts_are_enough_for_plain_words():
    rng = random.Random(4)
    train = _texts(rng, 30, True) + _texts(rng, 150, False)
    net = toxicity.train(train, [1] * 30 + [0] * 150)
    bad, good = (toxicity.Scorer(net).scores(_texts(rng, 40, t)) for t in (True, False))
    assert np.mean(bad[:, None] > good[None, :]) > 0.9
