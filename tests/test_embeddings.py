import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera_spark.operators import embeddings as E
from tessera_spark.operators.encode import model_source
from tessera_spark.sources import tables as IO


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 6)) @ rng.normal(size=(6, 6)) + 5
    x[:, 2] = 1.5
    return x.astype(np.float32)


@pytest.fixture(scope="module")
def rows(spark, matrix):
    data = [(i, r.tolist(), -1 if i % 5 == 0 else i % 3) for i, r in enumerate(matrix)]
    return spark.createDataFrame(data, "embedding_index long, embedding array<float>, label_id int").repartition(4)


def collect(df, column="features"):
    return np.array([r[column] for r in df.orderBy("embedding_index").collect()])


def test_scaler_matches_population_statistics(rows, matrix):
    stats = E.dimension_moments(rows).orderBy("dim").collect()
    x = matrix.astype(float)
    assert np.allclose([r["mean"] for r in stats], x.mean(axis=0))
    scale = x.std(axis=0)
    scale[2] = 1.0
    assert np.allclose([r["scale"] for r in stats], scale)
    done, _ = E.fit_transform_embeddings(rows)
    assert np.allclose(collect(done), (x - x.mean(axis=0)) / scale, atol=1e-9)
    assert np.all(collect(done)[:, 2] == 0)


def test_fit_on_labelled_rows_only(rows, matrix):
    scaler = E.fit_scaler(rows, fit_on="labelled")
    keep = np.arange(len(matrix)) % 5 != 0
    assert np.allclose(scaler.getOrDefault("mean"), matrix[keep].astype(float).mean(axis=0))


@pytest.mark.parametrize("standardize", [True, False])
def test_pca_against_svd(rows, matrix, standardize):
    x = matrix.astype(float)
    x = x - x.mean(axis=0)
    if standardize:
        dev = x.std(axis=0)
        x = x / np.where(dev == 0, 1, dev)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    done, steps = E.fit_transform_embeddings(rows, standardize=standardize, components=3)
    parts = E.principal_components(steps)
    assert np.allclose(np.abs((parts * vt[:3]).sum(axis=1)), 1, atol=1e-6)
    assert all(p[np.abs(p).argmax()] > 0 for p in parts)
    assert E.explained_variance(steps) == pytest.approx((s[:3] ** 2).sum() / (s**2).sum())
    assert np.allclose(collect(done), x @ parts.T, atol=1e-6)
    assert E.output_dimension(steps, 6) == 3


def test_processors_round_trip(rows, tmp_path):
    done, steps = E.fit_transform_embeddings(rows, components=2)
    path = str(tmp_path / "steps")
    IO.save_processors(steps, path)
    again = E.transform_embeddings(rows, IO.load_processors(path))
    assert np.allclose(collect(done), collect(again))
    plain = E.transform_embeddings(rows, IO.load_processors(None))
    assert np.allclose(collect(plain), collect(rows, "embedding"))


def test_noise_is_repeatable_and_shaped(spark):
    rows = spark.range(2000).select("id", F.array_repeat(F.lit(1.0), 8).alias("v"))
    noisy = E.noisy_features(F.col("v"), F.col("id"))
    a = np.array([r[0] for r in rows.select(noisy).collect()])
    b = np.array([r[1] for r in sorted(rows.repartition(3).select("id", noisy).collect())])
    assert np.array_equal(a, b)
    kept = a[a != 0]
    assert abs((a == 0).mean() - 0.1) < 0.01
    assert abs(kept.mean() - 1) < 0.01 and abs(kept.std() - 0.1) < 0.01


def test_several_encoders(spark):
    rows = spark.createDataFrame([([1.0, 2.0], [3.0])], "a array<float>, b array<float>")
    joined = rows.select(E.combine_encoders(F.col("a"), F.col("b")).alias("embedding"))
    assert tuple(E.embedding_dim(joined).first()) == (3, 1)


def test_value_range(rows, matrix):
    row = E.value_range(rows).first()
    assert (row.min_label, row.max_label) == (-1, 2)
    assert row.min_value == pytest.approx(float(matrix.min())) and row.max_value == pytest.approx(float(matrix.max()))


def test_null_vectors_are_left_out_of_fits_and_stay_null(spark, rows, matrix):
    broken = rows.select("label_id", F.lit(None).cast("array<float>").alias("embedding")).limit(2)
    mixed = rows.select("label_id", "embedding").unionByName(broken)
    plain, _ = E.fit_transform_embeddings(rows.select("label_id", "embedding"), components=2)
    done, _ = E.fit_transform_embeddings(mixed, components=2)
    got = [r.features for r in done.collect()]
    assert got.count(None) == 2
    expected = sorted(r.features for r in plain.collect())
    assert np.allclose(sorted(g for g in got if g), expected)
    assert E.dimension_moments(mixed).agg(F.max("n")).first()[0] == len(matrix)


def test_model_source(spark):
    rows = spark.createDataFrame([("ViT-B-16-SigLIP-512",), ("RN50",)], "n string")
    source = model_source(F.col("n"))
    assert [tuple(r) for r in rows.select(source["hub"], source["name"]).collect()] == [
        ("hf-hub:timm", "ViT-B-16-SigLIP-512"), ("RN50", "openai")
    ]


def test_config_tables(spark, tmp_path):
    from tessera_spark import schemas

    config = IO.model_config(spark, 64, (8, 4), [("hf-hub:timm", "x")], ["a", "b"])
    path = str(tmp_path / "config")
    IO.write_config(config, path)
    assert IO.read_config(spark, path).first() == config.first()
    processor = spark.createDataFrame(
        [(("m", "p", "cpu", 256, 4, None, True), 64, False, True)], schemas.PROCESSOR_CONFIG
    )
    IO.write_config(processor, path + "2")
    assert IO.read_config(spark, path + "2", schemas.PROCESSOR_CONFIG).first() == processor.first()


def test_embeddings_table(spark, tmp_path):
    rows = spark.createDataFrame([(0, "/a.png", [0.5, 1.0])], "embedding_index long, image_path string, embedding array<double>")
    IO.write_embeddings(rows, str(tmp_path / "e"))
    assert tuple(IO.read_embeddings(spark, str(tmp_path / "e")).first()) == (0, "/a.png", [0.5, 1.0])
