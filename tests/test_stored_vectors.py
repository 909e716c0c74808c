"""Bucketed tables, .npy matrices and replayed micro-batches."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera_spark.operators import manifest as MF
from tessera_spark.sources import bucketed, npy
from tessera_spark.streaming.common import run_by_batch

N, D = 500, 6


@pytest.fixture(scope="module")
def matrix():
    return np.random.default_rng(3).normal(size=(N, D)).astype(np.float32)


@pytest.fixture(scope="module")
def vectors(spark, matrix):
    rows = [(i, matrix[i].tolist()) for i in range(N)]
    return spark.createDataFrame(rows, "embedding_index long, embedding array<float>").repartition(5)


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(i, f"n{i}") for i in range(0, N + 50, 3)], "embedding_index long, image_name string")


def test_bucketed_join_moves_no_rows(spark, tmp_path, vectors, names):
    paths = [str(tmp_path / p) for p in ("names", "vec'tors")]
    for frame, path in zip((names, vectors), paths, strict=True):
        bucketed.write_bucketed(frame, path, 4)
    opened = [bucketed.read_bucketed(spark, p) for p in paths]
    assert opened[1].schema == vectors.schema
    joined = bucketed.attach_bucketed(*opened)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    want = MF.attach_embeddings(names, vectors).collect()
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want)) and len(want) == 167
    # One file per bucket, and bucket against bucket also in another session.
    assert sum(f.endswith(".parquet") for f in os.listdir(paths[1])) == 4
    other = spark.newSession()
    again = bucketed.attach_bucketed(*[bucketed.read_bucketed(other, p) for p in paths])
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString() and again.count() == 167
    assert [bucketed.buckets_for(n, 10) for n in (0, 1, 10, 11)] == [1, 1, 1, 2]


def test_npy_files_of_numpy_are_read_in_ranges(spark, tmp_path, matrix):
    for kind in ("<f4", ">f8", "<i4", "<i8"):
        path = str(tmp_path / f"{kind[1:]}.npy")
        np.save(path, (matrix * 100).astype(kind))
        frame = npy.read_npy(spark, path, partition_bytes=100 * D * 4)
        assert frame.rdd.getNumPartitions() == -(-N // (100 * D * 4 // (D * int(kind[2]))))
        found = np.array([r.embedding for r in frame.orderBy("embedding_index").collect()])
        assert np.array_equal(found, (matrix * 100).astype(kind))
    assert npy.read_npy(spark, f"file://{path}").filter("embedding_index = 7").first().embedding == (matrix[7] * 100).astype(int).tolist()


def test_npy_round_trip(spark, tmp_path, matrix, vectors):
    path = str(tmp_path / "m.npy")
    npy.write_npy(vectors, path)
    assert np.array_equal(np.load(path), matrix)
    with pytest.raises(Exception, match="FileExists"):
        npy.write_npy(vectors, path)
    npy.write_npy(vectors.select("embedding_index", F.transform("embedding", lambda x: x.cast("double") * 2).alias("embedding")), path, "overwrite")
    assert np.array_equal(np.load(path), matrix.astype(float) * 2)
    assert os.listdir(tmp_path) == ["m.npy"]
    npy.write_npy(vectors.limit(0), str(tmp_path / "none.npy"))
    assert npy.read_npy(spark, str(tmp_path / "none.npy")).count() == 0


def test_npy_refuses_what_it_cannot_hold(spark, tmp_path, matrix, vectors):
    for bad in (vectors.filter("embedding_index <> 9"), vectors.unionByName(vectors.limit(1)), vectors.withColumn("embedding", F.when(F.col("embedding_index") != 3, F.col("embedding")))):
        with pytest.raises(ValueError):
            npy.write_npy(bad, str(tmp_path / "bad.npy"))
    np.save(tmp_path / "f.npy", np.asfortranarray(matrix))
    with pytest.raises(Exception, match="row by row"):
        npy.read_npy(spark, str(tmp_path / "f.npy")).count()
    np.save(tmp_path / "cut.npy", matrix)
    os.truncate(tmp_path / "cut.npy", 4000)
    with pytest.raises(Exception, match="ends before row"):
        npy.read_npy(spark, str(tmp_path / "cut.npy")).collect()


def test_a_failed_write_leaves_nothing(spark, tmp_path, vectors):
    broken = vectors.withColumn("embedding", F.when(F.col("embedding_index") < 400, F.col("embedding")).otherwise(F.array(F.assert_true(F.rand() < 2).cast("float"))))
    with pytest.raises(Exception):
        npy.write_npy(broken, str(tmp_path / "m.npy"))
    assert os.listdir(tmp_path) == []


def test_a_replayed_batch_is_not_there_twice(spark, tmp_path):
    source, output = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)

    def stop_after_second(number):
        if number == 1:
            raise RuntimeError("the job ended here")

    with pytest.raises(Exception, match="the job ended here"):
        run_by_batch(stream, "ids", output, stop_after_second)
    assert spark.read.parquet(output).count() == 20
    again = []
    run_by_batch(stream, "ids", output, again.append)
    assert again == [1, 2]
    assert sorted(r.id for r in spark.read.parquet(output).collect()) == list(range(30))
