"""Language identification over words and pieces of any length."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ctxloom.llm import langid


def random_words(rng, n):
    return ["".join(rng.choice("abйじ") for _ in range(rng.randint(1, 30))) for _ in range(n)]


@pytest.fixture
def small():
    rng = random.Random(4)
    found = [bytes([b]) for b in range(256)] + [" ab".encode(), "abab".encode(), "йй".encode(), "じ".encode(), ("ab" * 12).encode()]
    pieces = langid.Pieces({p: i for i, p in enumerate(found)})
    log_p = np.log(np.random.default_rng(4).dirichlet(np.ones(len(found)), 3).T)
    return random_words(rng, 60) + ["ab" * 15], pieces, log_p


def test_long_words_have_the_sums_of_short_ones(small, monkeypatch):
    words, pieces, log_p = small
    weights = np.arange(1, len(words) + 1)
    short = langid.word_scores(words, pieces, log_p), langid.expected_counts(words, weights, pieces, log_p[:, :1])
    monkeypatch.setattr(langid, "_LONG_WORD", 3)
    assert np.allclose(langid.word_scores(words, pieces, log_p), short[0])
    assert np.allclose(langid.expected_counts(words, weights, pieces, log_p[:, :1]), short[1])


def test_pieces_longer_than_others_count(small):
    _, pieces, log_p = small
    without = dict(list(pieces.items())[:-1])
    word = "ab" * 12
    assert langid.word_scores([word], pieces, log_p)[0, 0] > langid.word_scores([word], without, log_p)[0, 0]


def test_a_word_of_many_letters_is_one_word():
    word = "д" * 200_000
    assert langid.words_of(f"a {word} b") == ["a", word, "b"]
    pieces = langid.Pieces({bytes([b]): b for b in range(256)})
    log_p = np.full((256, 2), np.log(1 / 256))
    assert np.allclose(langid.word_scores([word], pieces, log_p), (2 * len(word) + 1) * np.log(1 / 256))


def test_copies_do_not_lower_the_sample(spark):
    texts = ["same words in all of these"] * 1990 + [f"text number {i} of its own" for i in range(10)]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    different = docs.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0]
    assert langid._training_texts(docs, {"en": different}, 1000).count() == 11
