"""Streams over tables that are folders of files, against the same tables in one file."""

from __future__ import annotations

import os
import shutil

import pytest

import __spark_entry__ as driver


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """The same rows as tables of one file, and as tables that are folders of three."""
    lines = ["ready", "ready", "Epoch 3", "wait", "done\nready", None]
    turns = [(c, t, "user", lines[(c + t) % 6]) for c in range(1, 30) for t in range(9)]
    vectors = [(k, k % 4, [float(k % 4 == d) + k / 1000 for d in range(4)]) for k in range(90)]
    tables = {
        "conversations": spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"),
        "embeddings": spark.createDataFrame(vectors, "vec_id long, label int, embedding array<float>"),
        "documents": spark.createDataFrame([(k, f"src{k % 9}") for k in range(90)], "doc_id long, source string"),
    }
    top = tmp_path_factory.mktemp("tables")
    for name, table in tables.items():
        table.repartition(3).write.parquet(f"{top}/folder/{name}.parquet")
        table.coalesce(1).write.parquet(f"{top}/{name}")
        os.makedirs(f"{top}/file", exist_ok=True)
        part = next(f for f in os.listdir(f"{top}/{name}") if f.startswith("part-"))
        shutil.copy(f"{top}/{name}/{part}", f"{top}/file/{name}.parquet")
    return f"{top}/file", f"{top}/folder"


@pytest.mark.parametrize("name", ["log_filter_by_time", "log_filter_stream", "score_stream", "score_stream_replayed"])
def test_a_folder_gives_the_rows_of_one_file(spark, both, name):
    file, folder = (sorted(map(tuple, driver.queries()[name](spark, sf).collect()), key=str) for sf in both)
    assert file and file == folder


@pytest.mark.parametrize("name", ["log_filter_by_time", "log_filter_stream"])
def test_lines_of_a_table_do_not_depend_on_the_bound_of_a_batch(spark, both, monkeypatch, name):
    monkeypatch.setattr("tessera_spark.streaming.common.MAX_BYTES_PER_TRIGGER", 1)
    want = driver.queries()["log_filter"](spark, both[1])
    got = driver.queries()[name](spark, both[1]).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
