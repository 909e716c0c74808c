import random

import numpy as np
from pyspark.sql import functions as F

from tessera_spark.llm import brown
from tests.llm.conftest import SCHEMA, full


def test_tail_words_find_their_class(spark, monkeypatch):
    # Two alternating kinds of words whose endings say nothing; one word of each kind is a head item.
    monkeypatch.setattr(brown, "ITEM_BITS", 3)
    rng = random.Random(6)
    kinds = [[f"{chr(97 + k)}{i}end" for i in range(40)] for k in (0, 1)]
    rows = [full(k, " ".join(kinds[i % 2][0] if rng.random() < 0.4 else rng.choice(kinds[i % 2]) for i in range(200))) for k in range(60)]
    found = brown.score_texts(spark.createDataFrame(rows, SCHEMA)).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert (found.s - found.b) / found.n > 0.2  # log10(2) = 0.301 for a kind that is known


def test_emissions_of_head_shapes_and_tail_sum_to_one():
    counts = np.random.default_rng(0).integers(0, 9, brown.FIRST_WORD + 30)
    classes = np.arange(len(counts)) % 5
    words = np.array([9, 12, 40, 8])  # tail words, all of class 2
    tail = np.zeros((2, brown.CLASSES), np.int64)
    tail[:, 2] = words.sum(), len(words)
    bigrams = np.full((brown.CLASSES, brown.CLASSES), 2.0)
    model = brown.make_model(100, 20, classes, bigrams, counts, counts[: brown.SHAPES], np.minimum(counts[: brown.SHAPES], 2), tail)
    sums = np.bincount(classes, 10**model.emission, brown.CLASSES)
    sums[2] += (10 ** (np.log10(words + brown.HALF) - model.weights[2])).sum()
    assert np.allclose(sums[:5], 1)


def test_likelihood_prefers_classes_that_tell():
    told, mixed = np.zeros((4, 4)), np.zeros((4, 4))
    told[0, 1] = told[1, 0] = 50
    mixed[:2, :2] = 25
    assert brown.likelihood(told) > brown.likelihood(mixed)
