import math
import os.path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera_spark.functions import bands, paths, schedules, text
from tessera_spark.functions import vectors as V


def values(spark, rows, column, schema="v string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


PATHS = [
    "/a/b", "/a//b/", "/a/./b", "/a/../b", "/../a", "a/../..", "../a/../../b", "", ".", "/", "//a/b",
    "///a", "a/b/../c/./d//", "/a/b/../../..", "./x", "..",
]


def test_normalise_path_is_lexical(spark):
    assert values(spark, PATHS, paths.normalise_path(F.col("v"))) == [os.path.normpath(p) for p in PATHS]


def test_absolute_and_base_name(spark):
    assert values(spark, ["x/../y", "/z"], paths.absolute_path(F.col("v"), "/w")) == ["/w/y", "/z"]
    assert values(spark, PATHS, paths.base_name(F.col("v"))) == [os.path.basename(p) for p in PATHS]


def test_is_image(spark):
    names = ["a.PNG", "b.jpg", "c.JpEg", "d.bmp", "e.gif", "png", "f.png.txt"]
    assert values(spark, names, paths.is_image(F.col("v"))) == [True] * 4 + [False] * 3


def test_relative_to_schemes(spark):
    rows = ["file:/r/x/a.png", "hdfs://host:80/r/x/a.png", "/r/a.png", "/other/a.png", "/rr/a.png"]
    got = values(spark, rows, paths.relative_to(F.col("v"), "/r"))
    assert got == ["x/a.png", "x/a.png", "a.png", None, None]
    assert values(spark, rows[1:2], paths.relative_to(F.col("v"), "hdfs://host:80/r/")) == ["x/a.png"]


def test_output_folder(spark):
    rows = spark.createDataFrame(
        [("/in/cats", None), ("/in/normalized_cats", None), ("/in/cats", "/out")], "v string, e string"
    )
    got = [r[0] for r in rows.select(paths.output_folder(F.col("v"), F.col("e"), "/p")).collect()]
    assert got == ["/p/datasets/normalized/cats", "/in/normalized_cats", "/out"]


def test_text(spark):
    assert values(spark, ["x" * 9, "x" * 8], text.truncate(F.col("v"), 8, 8)) == ["x" * 8 + "...", "x" * 8]
    assert values(spark, ["\t a b　\n", "\x1c"], text.strip(F.col("v"))) == ["a b", ""]
    assert values(spark, [3725.4, 59.6, 0.5], text.duration_text(F.col("v")), "v double") == [
        "1h 2m 5s", "0h 0m 60s", "0h 0m 0s"
    ]
    assert values(spark, [7.9, 0.0], text.bar(F.col("v"), 15), "v double") == ["#" * 7 + "-" * 8, "-" * 15]
    assert values(spark, [12345], text.padded_name(F.lit("a"), F.col("v")), "v long") == ["a_12345.png"]
    assert values(spark, [0.123], text.percent_text(F.col("v"), 1), "v double") == ["12.3%"]
    assert values(spark, [1234567], text.thousands_text(F.col("v")), "v long") == ["1,234,567"]
    clock = F.col("v").cast("timestamp")
    assert values(spark, ["2024-01-01 03:04:05"], text.clock_text(clock)) == ["03:04:05"]


@pytest.mark.parametrize(
    "band, rows, want",
    [
        (bands.f1_band, [0.8, 0.6, 0.3, 0.29], ["Excellent", "Good", "Fair", "Poor"]),
        (bands.recall_band, [0.9, 0.7, 0.5, 0.4], ["Excellent", "Good", "Fair", "Poor"]),
        (bands.confidence_band, [0.7, 0.4, 0.39], ["High", "Medium", "Low"]),
        (bands.accuracy_flag, [0.81, 0.8, 0.5], ["GOOD", "OK", "TRAIN"]),
        (bands.f1_flag, [0.81, 0.8, 0.5], ["GREAT", "GOOD", "TRAIN"]),
    ],
)
def test_bands(spark, band, rows, want):
    assert values(spark, rows, band(F.col("v")), "v double") == want


def test_loss_flag(spark):
    rows = spark.createDataFrame([(2.0, 1.0), (1.0, 2.0), (1.0, 0.0)], "t double, v double")
    assert [r[0] for r in rows.select(bands.loss_flag(F.col("t"), F.col("v"))).collect()] == ["DOWN", "UP", "WAIT"]


def test_vector_expressions(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5, 4))
    mean, var, gamma, beta = (rng.uniform(0.5, 1.5, 4).tolist() for _ in range(4))
    weights, bias = rng.normal(size=(3, 4)).tolist(), [0.1, 0.2, 0.3]
    frame = spark.createDataFrame([(r.tolist(), 2) for r in x], "v array<double>, y int")
    v = F.col("v")

    def run(column):
        return np.array([r[0] for r in frame.select(column).collect()])

    soft = np.exp(x) / np.exp(x).sum(axis=1, keepdims=True)
    assert np.allclose(run(V.softmax(v)), soft)
    assert np.allclose(run(V.confidence(v)), soft.max(axis=1))
    assert np.allclose(run(V.probability_of(v, F.col("y"))), soft[:, 2])
    assert np.allclose(run(V.row_cross_entropy(v, F.col("y"))), -np.log(soft[:, 2]))
    assert np.allclose(run(V.linear(v, weights, bias)), x @ np.array(weights).T + bias)
    normed = (x - mean) / np.sqrt(np.array(var) + 1e-5) * gamma + beta
    assert np.allclose(run(V.batch_norm(v, mean, var, gamma, beta)), normed)
    assert np.allclose(run(V.leaky_relu(v)), np.where(x < 0, 0.02 * x, x))
    assert np.allclose(run(V.standardise(v, mean, var)), (x - mean) / var)
    assert np.allclose(run(V.project(v, mean, weights)), (x - mean) @ np.array(weights).T)


def test_argmax_takes_first_maximum(spark):
    rows = [[1.0, 3.0, 3.0], [2.0, 2.0, 1.0]]
    assert values(spark, rows, V.argmax(F.col("v")), "v array<double>") == [1, 0]


def test_softmax_of_large_logits(spark):
    assert values(spark, [[1000.0, 1000.0]], V.softmax(F.col("v")), "v array<double>") == [[0.5, 0.5]]


def test_schedules(spark):
    epochs = list(range(0, 101, 10))
    got = values(spark, epochs, schedules.cosine_lr(F.col("v"), 100), "v int")
    assert np.allclose(got, [1e-6 + 4.9e-5 * (1 + math.cos(math.pi * e / 100)) / 2 for e in epochs])
    got = values(spark, [0, 5, 10, 60, 110], schedules.warmup_factor(F.col("v"), 10, 110, 1.0, 2.0), "v int")
    assert np.allclose(got, [0, 1, 1, 0.5, 0])
    assert values(spark, [5, 10], schedules.warmup_factor(F.col("v"), 10, None, 1.0, 3.0), "v int") == [1.5, 1.0]


def test_cadence(spark):
    epochs = list(range(75))
    checked = [e for e, x in zip(epochs, values(spark, epochs, schedules.is_validated(F.col("v")), "v int")) if x]
    sampled = values(spark, epochs, schedules.is_sampled(F.col("v")), "v int")
    assert checked == list(range(4, 75, 5))
    assert [e for e in checked if sampled[e]] == [24, 49, 74] and sampled[0]
