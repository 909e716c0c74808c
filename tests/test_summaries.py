import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera_spark.operators import logs
from tessera_spark.operators import runs as R
from tessera_spark.streaming import early_stop as early
from tessera_spark.streaming import logs as log_stream
from tessera_spark.streaming.common import stream_parquet
from tests.test_runs import cases, walk
from tests.test_streaming import in_files


def test_step_functions_equal_a_walk():
    rng = np.random.default_rng(4)
    for _ in range(500):
        values = np.unique(rng.integers(1, 60, rng.integers(1, 25))) / 10.0
        delta = rng.choice([0.0, 0.15, 0.5, 2.0])
        top = values[0] - rng.choice([0.05, 0.4])
        limits, exits = R.summarise(values, top, delta)
        for best in (top, top - delta, top - delta / 2):
            want, places = best, []
            for i, v in enumerate(values):
                if v - delta > want:
                    want, places = v, [*places, i]
            assert R.leave(limits, exits, best) == want
            assert R.improvements(values, best, delta).tolist() == places
        if values[-1] - delta <= top:
            continue
        assert R.leave(*R.summarise(values, -np.inf, delta), -np.inf) >= values[0]


def test_a_run_of_small_gains_equals_a_loop(spark, monkeypatch):
    monkeypatch.setattr(R, "integer_bucket", lambda key: F.floor(key / 16))
    rng = np.random.default_rng(5)
    series = np.cumsum(rng.random(1500) * 4e-8).tolist()
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(series)], "run_id long, epoch long, value double").repartition(7)
    row = R.early_stop(df, patience=60).first()
    want = walk(list(enumerate(series)), 60)
    assert (row.stop_epoch, row.best_epoch, row.best_value, row.misses, row.epochs) == want


@pytest.mark.parametrize("parts", [1, 4])
def test_early_stop_batches_equal_a_loop(spark, tmp_path, parts):
    data = {k: vs for k, vs in enumerate(cases().values()) if k < 24}
    rows = spark.createDataFrame([(k, e, v) for k, vs in data.items() for e, v in vs], "run_id long, epoch long, value double")
    folder = in_files([rows.filter(F.floor(F.col("epoch") * parts / 161) == i) for i in range(parts)], str(tmp_path))
    out = early.early_stop_batches(stream_parquet(spark, folder, rows.schema, maxBytesPerTrigger=1), str(tmp_path / "out"), 5)
    got = early.latest(spark.read.parquet(out).drop("batch")).collect()
    assert {r.run_id: (r.stop_epoch, r.best_epoch, r.best_value, r.misses, r.epochs) for r in got} == {k: walk(vs, 5) for k, vs in data.items()}
    assert all(r.late == 0 for r in got)


def test_early_stop_batches_count_late_epochs(spark, tmp_path):
    first = spark.createDataFrame([(1, 5, 0.5), (1, 6, float("nan")), (None, 1, 0.1)], "run_id long, epoch long, value double")
    late = spark.createDataFrame([(1, 2, 0.9), (1, 6, 0.9), (1, 7, 0.9)], first.schema)
    folder = in_files([first, late], str(tmp_path))
    out = early.early_stop_batches(stream_parquet(spark, folder, first.schema, maxBytesPerTrigger=1), str(tmp_path / "out"))
    row = early.latest(spark.read.parquet(out).drop("batch")).first()
    assert (row.stop_epoch, row.best_value, row.epochs, row.late) == (6, 0.5, 3, 2)


@pytest.mark.parametrize("parts", [1, 3])
def test_lines_by_time_do_not_depend_on_batches(spark, tmp_path, parts):
    rng = np.random.default_rng(7)
    rows = [(int(s), t, 0, str(rng.choice(["ready", "done", "epoch 3", "wait"]))) for s in (1, 1, 2) for t in range(40)]
    rows = [(s, t, k % 3, x) for k, (s, t, _, x) in enumerate(rows)]
    df = spark.createDataFrame(rows, "source long, turn long, line_no int, line string").dropDuplicates(["source", "turn", "line_no"])
    # A line comes up to two steps after its time; five turns of delay cover that.
    moved = F.pmod(F.hash("source", "turn", "line_no"), F.lit(5)) + F.col("turn")
    frames = [df.filter(F.least(F.floor(moved * parts / 44), F.lit(parts - 1)) == i) for i in range(parts)]
    folder = in_files(frames, str(tmp_path))
    out = str(tmp_path / "out")
    got = log_stream.log_filter_by_time(stream_parquet(spark, folder, df.schema, maxBytesPerTrigger=1), out, 5)
    want = logs.log_filter(df, "source", ["turn", "line_no"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert log_stream.late_lines(spark, out) == 0


def test_late_lines_are_counted(spark, tmp_path):
    schema = "source long, turn long, line_no int, line string"
    frames = [spark.createDataFrame(r, schema) for r in ([(1, 10, 0, "ready"), (1, 4, 0, "wait")], [(1, 3, 0, "lost"), (1, 8, 0, "wait"), (None, 9, 0, "x")], [(1, 20, 0, "ready")])]
    out = str(tmp_path / "out")
    got = log_stream.log_filter_by_time(stream_parquet(spark, in_files(frames, str(tmp_path)), frames[0].schema, maxBytesPerTrigger=1), out, 4)
    assert [r.turn for r in got.orderBy("turn").collect()] == [4, 10]
    assert log_stream.late_lines(spark, out) == 1
