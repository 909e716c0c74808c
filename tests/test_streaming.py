import os

import pytest
from pyspark.sql import functions as F

from tessera_spark.functions.text import explode_lines
from tessera_spark.operators import logs, mlp, runs
from tessera_spark.operators import embeddings as E
from tessera_spark.plans import tables
from tessera_spark.streaming import early_stop as early
from tessera_spark.streaming import logs as log_stream
from tessera_spark.streaming.common import run_to_table, stream_parquet
from tessera_spark.streaming.scoring import score_stream

SF = "/root/testdata/sf0.001"


def in_files(frames, folder):
    """One file per micro-batch, in order."""
    for i, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(f"{folder}/part{i}")
        for name in os.listdir(f"{folder}/part{i}"):
            if name.startswith("part-"):
                os.makedirs(f"{folder}/all", exist_ok=True)
                os.link(f"{folder}/part{i}/{name}", f"{folder}/all/{i}-{name}")
                os.utime(f"{folder}/all/{i}-{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    return f"{folder}/all"


def values_of(spark):
    return tables.read(spark, SF, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("epoch"), (F.col("value") / 1000).alias("value")
    )


@pytest.mark.parametrize("parts", [1, 4])
def test_early_stop_stream_equals_batch(spark, tmp_path, parts):
    values = values_of(spark)
    frames = [values.filter(F.floor(F.col("epoch") * parts / 1000) == i) for i in range(parts)]
    folder = in_files(frames, str(tmp_path))
    stream = stream_parquet(spark, folder, values.schema, maxBytesPerTrigger=1)
    states = spark.read.parquet(run_to_table(early.early_stop_stream(stream, 10), "t", str(tmp_path / "out")))
    got = early.latest(states).drop("late")
    want = runs.early_stop(values, 10)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    if parts > 1:
        assert states.count() > got.count()


def test_late_epochs_are_counted(spark, tmp_path):
    first = spark.createDataFrame([(1, 5, 0.5), (1, 6, float("nan"))], "run_id long, epoch long, value double")
    late = spark.createDataFrame([(1, 2, 0.9), (1, 6, 0.9), (1, 7, 0.9)], first.schema)
    folder = in_files([first, late], str(tmp_path))
    stream = stream_parquet(spark, folder, first.schema, maxBytesPerTrigger=1)
    states = spark.read.parquet(run_to_table(early.early_stop_stream(stream), "t", str(tmp_path / "out")))
    row = early.latest(states).first()
    assert (row.stop_epoch, row.best_value, row.epochs, row.late) == (6, 0.5, 3, 2)


def test_log_stream_equals_batch(spark, tmp_path):
    turns = tables.read(spark, SF, "conversations").select(F.col("conv_id").alias("source"), "turn", "text")
    folder = in_files([turns.filter("turn < 2"), turns.filter("turn >= 2")], str(tmp_path))
    stream = stream_parquet(spark, folder, turns.schema, maxBytesPerTrigger=1)
    out = run_to_table(log_stream.log_filter_stream(explode_lines(stream, "text")), "t", str(tmp_path / "out"))
    want = logs.log_filter(explode_lines(turns, "text"), "source", ["turn", "line_no"])
    got = spark.read.parquet(out)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


LINES = ["", "  ready ", "Epoch 3", "ready", "ready!", "step 1", ">> Validation epoch end: 5%", "50 %", "ready!"]
SHOWN = ["ready", "ready!", ">> Validation epoch end: 5%", "ready!"]


def test_repeats_across_noise_and_batches(spark, tmp_path):
    rows = [(1, i, 0, x) for i, x in enumerate(LINES)]
    df = spark.createDataFrame(rows, "source long, turn long, line_no int, line string")
    got = logs.log_filter(df, "source", ["turn", "line_no"]).orderBy("turn").collect()
    assert [r.line for r in got] == SHOWN
    small = logs.drop_repeats(logs.filter_lines(df), "source", ["turn", "line_no"], span=2).orderBy("turn")
    assert [r.line for r in small.collect()] == SHOWN
    folder = in_files([df.filter(F.col("turn") == i) for i in range(len(LINES))], str(tmp_path))
    stream = stream_parquet(spark, folder, df.schema, maxBytesPerTrigger=1)
    out = spark.read.parquet(run_to_table(log_stream.log_filter_stream(stream), "t", str(tmp_path / "out")))
    assert [r.line for r in out.orderBy("turn").collect()] == SHOWN


def test_score_stream_equals_batch(spark, tmp_path):
    rows = tables.read(spark, SF, "embeddings")
    network = tables.formula_network(4, 8, 3)
    steps = E.fit_steps(rows, components=4)
    folder = in_files([rows.filter("vec_id < 200"), rows.filter("vec_id >= 200")], str(tmp_path))
    stream = stream_parquet(spark, folder, rows.schema, maxBytesPerTrigger=1)
    out = spark.read.parquet(run_to_table(score_stream(stream, network, steps), "t", str(tmp_path / "out")))
    want = mlp.predict(E.transform_embeddings(rows, steps), network, "features")

    def table(frame):
        return {r.vec_id: (r.predicted_class, round(r.confidence_score, 9)) for r in frame.collect()}

    assert table(out) == table(want) and out.count() == 500


def test_a_restarted_stream_goes_on(spark, tmp_path):
    values = values_of(spark)
    folder = in_files([values.filter("epoch < 500")], str(tmp_path))
    out = str(tmp_path / "out")
    run_to_table(early.early_stop_stream(stream_parquet(spark, folder, values.schema), 10), "t", out)
    in_files([values.filter("epoch < 0"), values.filter("epoch >= 500")], str(tmp_path / "more"))
    for name in os.listdir(tmp_path / "more" / "all"):
        os.link(tmp_path / "more" / "all" / name, f"{folder}/late-{name}")
    run_to_table(early.early_stop_stream(stream_parquet(spark, folder, values.schema), 10), "t", out)
    got = early.latest(spark.read.parquet(out)).agg(F.sum("epochs"), F.sum("late")).first()
    assert tuple(got) == (1000, 0)


def test_fold_equals_a_loop():
    import math
    import random

    import numpy as np

    from tessera_spark.streaming.early_stop import fold

    rng = random.Random(8)
    for _ in range(2000):
        values = [rng.choice([0.1, 0.2, 0.2 + 1e-8, 0.3, 0.5, rng.random(), float("nan"), float("inf")][: rng.choice([6, 8])]) for _ in range(rng.randint(1, 15))]
        best, misses = rng.choice([(None, 0), (0.2, 0), (0.3, 1)])
        patience, state = rng.choice([2, 3, 50]), (best, None, misses, None)
        b, improved, m, stop = state
        for at, v in enumerate(values):
            if not math.isfinite(v):
                stop = at
            elif b is None or v - 1e-7 > b:
                b, improved, m = v, at, 0
            else:
                m += 1
                stop = at if m >= patience else None
            if stop is not None:
                break
        assert fold(np.array(values), best, misses, patience, 1e-7) == (b, improved, m, stop)
