import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera_spark.operators import runs as R
from tessera_spark.sources import runs as IO


def walk(values, patience, delta=1e-7):
    """Early stopping as a plain loop: stop epoch, best epoch, best value, misses."""
    best = best_epoch = stop = None
    misses = 0
    for epoch, value in values:
        if value is None or not math.isfinite(value):
            stop = epoch
        elif best is None or value - delta > best:
            best, best_epoch, misses = value, epoch, 0
        else:
            misses += 1
            if misses >= patience:
                stop = epoch
        if stop is not None:
            break
    return stop, best_epoch, best, misses, len(values)


def cases():
    rng = random.Random(9)
    made = {
        "tiny_gains": [0.5 + i * 3e-8 for i in range(60)],
        "steady": [i / 100 for i in range(40)],
        "flat": [0.3] * 30,
        "nan": [0.1, 0.2, float("nan"), 0.9],
        "nan_first": [float("nan"), 0.5],
        "infinite": [0.1, float("inf"), 0.2],
        "null": [0.4, None, 0.5],
        "one": [0.7],
        "late_best": [0.5] + [0.1] * 4 + [0.6] + [0.2] * 20,
        "falling": [-i for i in range(12)],
    }
    for i in range(40):
        n = rng.randrange(1, 80)
        kind = rng.choice([3, 40, 10**9])
        made[f"r{i}"] = [rng.randrange(kind) / kind * rng.choice([1, 1e-6]) for _ in range(n)]
    return {k: [(e * 2 + 1, None if v is None else float(v)) for e, v in enumerate(vs)] for k, vs in made.items()}


def test_early_stop_against_a_loop(spark, monkeypatch):
    # A short span makes even these runs cross bucket borders on the long route.
    monkeypatch.setattr(R, "integer_bucket", lambda key: F.floor(key / 16))
    data = cases()
    rows = [(k, e, v) for k, vs in data.items() for e, v in vs]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "run_id string, epoch int, value double").repartition(5)
    got = {
        r.run_id: (r.stop_epoch, r.best_epoch, r.best_value, r.misses, r.epochs)
        for r in R.early_stop(df, patience=5).collect()
    }
    assert got == {k: walk(vs, 5) for k, vs in data.items()}


def test_series_and_best_epoch(spark):
    rows = [("a", 0, "val", "recall", 0.5), ("a", 1, "val", "recall", 0.9), ("a", 2, "val", "recall", 0.9),
            ("a", 3, "val", "recall", float("nan")), ("a", 3, "train", "recall", 1.0)]
    metrics = spark.createDataFrame(rows, "run_id string, epoch int, phase string, name string, value double")
    assert tuple(R.best_epoch(R.series(metrics)).first()) == ("a", 1, 0.9, 3)


def test_progress(spark):
    rows = [("a", e, f"2024-01-01 00:0{e}:00") for e in range(3)]
    timed = spark.createDataFrame(rows, "run_id string, epoch long, t string").select(
        "run_id", "epoch", F.col("t").cast("timestamp").alias("ts")
    )
    got = {r.epoch: r for r in R.epoch_progress(timed, 10).collect()}
    assert got[0].eta is None and got[0].epoch_seconds is None
    assert (got[2].percent, got[2].bar, got[2].elapsed, got[2].eta, got[2].epoch_seconds) == (
        20.0, "####" + "-" * 16, 120.0, 480.0, 60.0
    )
    assert got[2].elapsed_text == "0h 2m 0s"


def test_run_lines(spark, tmp_path):
    lines = [
        "VALIDATION_RUN: epoch=4, time=2024-01-01 10:00:00.000001",
        "VISUALIZATION_ATTEMPT: epoch=24, validation_run=5, time=2024-01-01 10:00:00",
        "VISUALIZATION_SUCCESS: epoch=24, count=1",
        "TRAINING_COMPLETED: final_epoch=100, max_epochs=100, viz_count=4",
        "something else",
    ]
    path = str(tmp_path / "lines")
    for part in (lines[:3], lines[3:]):
        IO.append_run_events(spark.createDataFrame([("r", x) for x in part], "run_id string, line string"), path)
    got = {r.kind: r for r in R.parse_run_events(IO.read_run_lines(spark, path)).collect()}
    assert sorted(got) == ["TRAINING_COMPLETED", "VALIDATION_RUN", "VISUALIZATION_ATTEMPT", "VISUALIZATION_SUCCESS"]
    assert got["VALIDATION_RUN"].epoch == 4 and got["VALIDATION_RUN"].time.microsecond == 1
    assert got["VISUALIZATION_ATTEMPT"].fields["validation_run"] == "5"
    assert got["TRAINING_COMPLETED"].epoch == 100 and got["VISUALIZATION_SUCCESS"].time is None


def test_epoch_metrics_append(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for epoch in (0, 1):
        rows = [("r", epoch, "val", "recall", 0.1 * epoch)]
        IO.log_epoch_metrics(spark.createDataFrame(rows, "run_id string, epoch int, phase string, name string, value double"), path)
    assert IO.read_epoch_metrics(spark, path).count() == 2


def test_registry(spark, tmp_path):
    rows = [
        ("d", 1, "2024-02-01", "w", "p", "n", ["x"]),
        ("d", 0, "2024-01-01", "old", "p", "n", ["x"]),
        ("d", 0, "2024-01-02", "new", "p", "n", ["x"]),
        ("e", 1, "2024-01-02", "only", "p", "n", None),
    ]
    frame = spark.createDataFrame(
        rows, "dataset string, priority int, t string, run_id string, project string, name string, tags array<string>"
    ).withColumn("ts", F.col("t").cast("timestamp"))
    got = {r.dataset: r for r in R.run_registry(frame).collect()}
    assert got["d"].run_id == "new" and got["d"].tags == ["x", "testing", "evaluation", "confusion_matrix"]
    assert got["e"].tags == ["testing", "evaluation", "confusion_matrix"]
    IO.write_run_info(frame.select("run_id", "project", "name", "tags"), str(tmp_path / "info"))
    assert IO.read_run_info(spark, str(tmp_path / "info")).count() == 4


def test_flags_take_the_latest_value(spark):
    rows = [("a", 0, "val", "acc", 0.9), ("a", 5, "val", "acc", 0.6), ("a", 1, "train", "loss", 2.0),
            ("a", 1, "val", "loss", 1.0)]
    row = R.progress_flags(
        spark.createDataFrame(rows, "run_id string, epoch int, phase string, name string, value double")
    ).first()
    assert (row.val_acc, row.acc_flag, row.loss_flag, row.f1_flag) == (0.6, "OK", "DOWN", "TRAIN")


def test_long_run_spreads_over_tasks(spark):
    values = spark.range(4000).select(
        F.lit(1).alias("run_id"), F.col("id").alias("epoch"), F.sin(F.col("id") / 300).alias("value")
    )
    row = R.early_stop(values, patience=1000).first()
    want = walk([(i, math.sin(i / 300)) for i in range(4000)], 1000)
    assert (row.stop_epoch, row.best_epoch, row.misses) == (want[0], want[1], want[3])
    assert np.isclose(row.best_value, want[2])


def test_odd_event_lines(spark):
    lines = ["ERROR: epoch=N/A, reason=a, b, and c=d", "STEP: epoch=3, epoch=4", "STEP: nothing", "no kind"]
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r.line: r for r in R.parse_run_events(rows).collect()}
    assert len(got) == 3
    assert got[lines[0]].epoch is None and got[lines[0]].fields == {"epoch": "N/A", "reason": "a, b, and c=d"}
    assert got[lines[1]].epoch == 4 and got[lines[2]].fields == {}
