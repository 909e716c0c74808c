import math
import os

import numpy as np
import pytest

from tessera_spark.operators import metrics as M
from tessera_spark.plans.evaluation import evaluate
from tessera_spark.sources import tables as IO

# Three classes and a fourth that is neither true nor predicted; class 2 is never predicted.
PAIRS = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(1, 0)] * 2 + [(2, 0)] + [(-1, 1)] * 5


@pytest.fixture
def cm(spark):
    scored = spark.createDataFrame(PAIRS, "label_id int, predicted_class int")
    return M.confusion(scored)


@pytest.fixture
def known(spark):
    return spark.createDataFrame([(i, f"c{i}") for i in range(4)], "label_id int, label_name string")


def test_report_with_unseen_classes(cm, known):
    rows = {r.label_id: r for r in M.class_report(cm, known).collect()}
    assert rows[0].precision == 0.5 and rows[0].recall == 0.75 and rows[0].f1 == 0.6
    assert (rows[2].precision, rows[2].recall, rows[2].f1, rows[2].support) == (0, 0, 0, 1)
    assert (rows[3].precision, rows[3].support, rows[3].performance) == (0, 0, "Poor")
    assert rows[0].performance == "Good"


def test_macro_leaves_out_absent_classes(cm):
    row = M.macro_metrics(cm).first()
    assert row.macro_recall == pytest.approx((0.75 + 0.5 + 0) / 3)
    assert row.macro_precision == pytest.approx((0.5 + 2 / 3 + 0) / 3)
    assert row.micro_accuracy == pytest.approx(5 / 9)
    assert M.accuracy(cm).first().accuracy == pytest.approx(5 / 9)


def test_dense_wide_and_normalised(cm, known, tmp_path, spark):
    dense = {(r.true_id, r.pred_id): r.n for r in M.confusion_dense(cm, known).collect()}
    assert len(dense) == 16 and dense[0, 1] == 1 and dense[3, 3] == 0
    shares = {(r.true_id, r.pred_id): r.share for r in M.confusion_normalized(cm, known).collect()}
    assert shares[1, 0] == 0.5 and shares[3, 0] is None
    wide = M.confusion_wide(cm, known, ["c0", "c1", "c2", "c3"])
    path = str(tmp_path / "cm")
    IO.export_confusion(wide, path)
    part = [f for f in os.listdir(path) if f.startswith("part-")]
    lines = open(os.path.join(path, part[0])).read().split()
    assert lines == ["true_label,c0,c1,c2,c3", "c0,3,1,0,0", "c1,2,2,0,0", "c2,1,0,0,0", "c3,0,0,0,0"]


def test_ranking_ties_keep_class_order(spark, known):
    scored = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 0)], "label_id int, predicted_class int")
    cm = M.confusion(scored)
    assert [r.label_id for r in M.recall_ranking(cm, known).collect()] == [1, 2, 0, 3]
    row = M.confusion_summary(cm, known).first()
    assert (row.best_class, row.worst_class, row.total, row.accuracy) == ("c1", "c3", 4, 0.5)


def test_distribution_ties_put_higher_id_first(spark, known):
    rows = [(c,) for c in [0, 0, 1, 1, 2]]
    got = M.prediction_distribution(spark.createDataFrame(rows, "predicted_class int"), known).collect()
    assert [(r.label_id, r.n) for r in got] == [(1, 2), (0, 2), (2, 1)]
    assert got[0].percentage == 40.0 and got[0].bar == "#" * 6 + "-" * 9


def test_confidence_uses_population_deviation(spark):
    rows = [(0, 0.2), (1, 0.4), (-1, 0.9)]
    got = {r.part: r for r in M.confidence_stats(spark.createDataFrame(rows, "label_id int, confidence_score double")).collect()}
    assert got["labelled"].std_confidence == pytest.approx(0.1)
    assert got["unlabelled"].std_confidence == 0 and got["all"].n == 3
    assert got["all"].std_confidence == pytest.approx(np.std([0.2, 0.4, 0.9]))


def test_cross_entropy(spark):
    rows = spark.createDataFrame([([0.0, 0.0], 0), ([1.0, 3.0], 1)], "logits array<double>, label_id int")
    want = (math.log(2) + math.log(1 + math.exp(-2))) / 2
    assert M.cross_entropy(rows).first().loss == pytest.approx(want)


def test_empty_confusion(spark, known):
    cm = M.confusion(spark.createDataFrame([], "label_id int, predicted_class int"))
    assert M.accuracy(cm).first().total == 0
    assert all(r.f1 == 0 for r in M.class_report(cm, known).collect())


def test_evaluation(spark, known):
    rows = [
        (i, c, p, 0.5 + i / 100, "val" if i % 2 else "train", f"/n/{i}.png") for i, (c, p) in enumerate(PAIRS)
    ]
    scored = spark.createDataFrame(
        rows, "embedding_index long, label_id int, predicted_class int, confidence_score double, split string, image_path string"
    )
    held_out, everything = evaluate(scored, known), evaluate(scored, known, split="all")
    assert held_out.summary.first().total == 4 and everything.summary.first().total == 9
    assert everything.samples.count() == 5 and everything.distribution.first().n == 5
    assert {r.part for r in everything.confidence.collect()} == {"labelled", "unlabelled", "all"}
    assert everything.macro.first().micro_accuracy == pytest.approx(5 / 9)
    assert everything.confusion.count() == everything.normalized.count() == 16
    assert everything.report.count() == everything.ranking.count() == 4


def test_validation_table(spark, known):
    sample = spark.createDataFrame(
        [("a.png", 0, 0, 0.9), ("b.png", 1, 9, 0.4)],
        "image_name string, label_id int, predicted_class int, confidence_score float",
    )
    got = {r.image_name: (r.true_label, r.pred_label, r.correct) for r in M.validation_sample_table(sample, known).collect()}
    assert got == {"a.png": ("c0", "c0", "CORRECT"), "b.png": ("c1", "Unknown_9", "WRONG")}
