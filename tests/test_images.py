import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import png
from tessera_spark.operators import checks, encode
from tessera_spark.operators import images as I
from tessera_spark.sources import files as S

RNG = np.random.default_rng(0)
GRAY, RGB, RGBA = (RNG.integers(0, 256, s, dtype=np.uint8) for s in ((9, 7), (12, 10, 3), (6, 6, 4)))


@pytest.fixture
def root(write_tree):
    return write_tree(
        {
            "cat/gray.png": png(GRAY), "cat/rgb.PNG": png(RGB), "dog/rgba.png": png(RGBA),
            "dog/broken.png": png(RGB)[:60], "dog/junk.jpg": b"not an image",
        }
    )


def by_name(frame):
    return {r.image_path.rsplit("/", 1)[1]: r for r in frame.collect()}


def test_reading_and_undecodable(spark, root):
    images = S.read_images(spark, root)
    found = by_name(images)
    assert sorted(n for n, r in found.items() if r.error is None) == ["gray.png", "rgb.PNG", "rgba.png"]
    assert sorted(n for n, r in found.items() if r.data is None and r.error) == ["broken.png", "junk.jpg"]
    r = found["rgb.PNG"]
    assert np.array_equal(I.to_rgb(I.pixels(r.height, r.width, r.nChannels, r.data)), RGB)
    g = found["gray.png"]
    assert np.array_equal(I.to_rgb(I.pixels(g.height, g.width, g.nChannels, g.data))[:, :, 1], GRAY)
    bad = S.undecodable(S.list_raw_files(spark, root), images).collect()
    assert sorted(r.original_path.rsplit("/", 1)[1] for r in bad) == ["broken.png", "junk.jpg"]


def test_normalized_images(spark, root, tmp_path):
    done = I.normalize_images(S.read_images(spark, root), 20, 16)
    path = str(tmp_path / "pixels")
    S.write_normalized(done, path)
    back = by_name(S.read_normalized(spark, path))
    assert all((r.width, r.height) == (20, 16) and len(r.data) == 320 * r.nChannels for r in back.values())
    assert [back[n].nChannels for n in ("gray.png", "rgb.PNG", "rgba.png")] == [1, 3, 4]
    assert checks.wrong_size(done, 20, 16).count() == 0 and checks.wrong_size(done).count() == 3


def test_augmentation_depends_on_key_only(spark, root):
    images = S.read_images(spark, root)
    once = I.augment_images(images, 2, CHANGES)
    again = I.augment_images(images.repartition(5), 2, CHANGES)

    def table(frame):
        return {(r.image_path, r.aug_version): bytes(r.data) for r in frame.collect()}

    a = table(once)
    assert a == table(again) and len(a) == 9
    assert len(set(a.values())) == 9
    other = table(I.augment_images(images, 2, CHANGES, seed=7))
    assert all((a[k] == other[k]) == (k[1] == 0) for k in a)


def test_hooks_are_applied():
    image = RNG.integers(0, 256, (6, 4, 3), dtype=np.uint8)
    assert np.array_equal(I.nearest(image, 6, 4), image)
    assert np.array_equal(I.nearest(image, 3, 2), image[::2, ::2])
    assert np.array_equal(I.nearest(image, 12, 8)[::2, ::2], image)


def _darker(image, rng):
    return image // 2


def _noisy(image, rng):
    return np.clip(image + rng.integers(-9, 10, image.shape), 0, 255).astype(np.uint8)


CHANGES = ((1.0, _noisy), (0.5, _darker))


def test_augment_flushes_in_portions(spark, root, monkeypatch):
    monkeypatch.setattr(I, "FLUSH_BYTES", 1)
    assert I.augment_images(S.read_images(spark, root), 3, CHANGES).count() == 12


def _means():
    def encode_batch(batch):
        if any(image.shape[0] == 12 for image in batch):
            raise RuntimeError("cannot take twelve rows")
        return np.stack([image.reshape(-1, 3).mean(axis=0) for image in batch])

    return encode_batch


def test_embedding_keeps_failures_as_rows(spark, root):
    images = S.read_images(spark, root).coalesce(1)
    done = encode.embed(images, _means)
    rows = by_name(done)
    assert rows["rgb.PNG"].embedding is None and "twelve" in rows["rgb.PNG"].error
    assert np.allclose(rows["gray.png"].embedding, [GRAY.mean()] * 3) and rows["gray.png"].error is None
    assert np.allclose(rows["rgba.png"].embedding, RGBA[:, :, :3].reshape(-1, 3).mean(axis=0))
    assert sorted(by_name(encode.failed_rows(done))) == ["broken.png", "junk.jpg", "rgb.PNG"]


def test_embedding_reports_bad_pixels(spark):
    rows = spark.createDataFrame(
        [("/a", 2, 2, 1, bytearray(b"1234")), ("/b", 9, 9, 1, bytearray(b"1"))],
        "image_path string, height int, width int, nChannels int, data binary",
    ).coalesce(1)
    got = {r.image_path: r for r in encode.embed(rows, _means).collect()}
    assert got["/a"].error is None and got["/b"].embedding is None and got["/b"].error


def test_encoder_runs_once_and_takes_equal_columns(spark, monkeypatch):
    # Height and width are the same expression here, which Spark hands to a UDF only once.
    monkeypatch.setattr(encode, "spread_rows", lambda df, key: df)
    rows = spark.range(5).select(
        F.col("id").cast("string").alias("image_path"),
        F.sqrt(F.lit(4) + F.col("id") * 0).cast("int").alias("height"),
        F.sqrt(F.lit(4) + F.col("id") * 0).cast("int").alias("width"),
        F.lit(1).alias("nChannels"),
        F.unhex(F.lit("01020304")).alias("data"),
    )
    done = encode.embed(rows, _means).filter("embedding is not null")
    assert done.count() == 5 and done.first().embedding == [2.5, 2.5, 2.5]
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_input_is_spread_and_read_once(spark):
    from tessera_spark.session import spread_rows

    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    schema = "image_path string, height int, width int, nChannels int, data binary"
    rows = spark.createDataFrame([(f"/{k}", 1, 1, 1, bytearray(b"7")) for k in range(40)], schema)
    source = rows.coalesce(1).mapInPandas(counted, rows.schema)
    done = encode.embed(I.normalize_images(source), _means)
    assert reads.value == 0
    assert done.filter("error is null").count() == 40 and reads.value == 40
    assert spread_rows(rows, "image_path").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert I.normalize_images(rows.limit(1)).select(F.length("data")).first()[0] == 224 * 224


def test_every_file_is_listed(spark, write_tree):
    body = png(np.full((2, 3, 3), 9, np.uint8))
    names = {
        "cat/a.png": body, "cat/_DSC0001.png": body, "cat/.b.png": body, "_cats/x.png": body, "cat/zero.png": b"",
        "test_data/zero.txt": b"", "test_data/t.png": body, ".hidden/deeper/no.png": body, "root.JPG": b"broken",
    }
    root = write_tree(names)
    found = {r.path[len(root) + 1 :]: r.length for r in S.list_raw_files(spark, root).collect()}
    assert found == {n: len(b) for n, b in names.items() if n.count("/") < 2}
    images = {r.image_path[len(root) + 1 :]: r for r in S.read_images(spark, root).collect()}
    assert set(images) == {n for n in found if n.lower().endswith(("png", "jpg"))}
    assert images["cat/a.png"].error is None and images["cat/_DSC0001.png"].error and images["cat/zero.png"].error

    def decode(content):
        if not content.startswith(b"\x89PNG"):
            raise ValueError("no image")
        return np.full((1, 2, 3), len(content) % 7, np.uint8)

    decoded = {r.image_path[len(root) + 1 :]: r.error for r in S.read_images(spark, root, decode=decode).collect()}
    assert {n for n, e in decoded.items() if e} == {"cat/zero.png", "root.JPG"}
    assert sorted(S.list_dataset_files(spark, root).filter("dataset = 'cat'").select("file_name").toPandas()["file_name"]) == [
        ".b.png", "_DSC0001.png", "a.png", "zero.png"
    ]


def test_from_files_to_report(spark, write_tree, tmp_path):
    """Raw tree to evaluated classifier, each stage a table; one image is broken."""
    from tessera_spark.operators import manifest as MF
    from tessera_spark.operators import mlp, split
    from tessera_spark.plans.evaluation import evaluate
    from tessera_spark.sources import tables

    tree = {f"{label}/{k}.png": png(np.full((4, 4, 3), level + k, np.uint8)) for label, level in (("dark", 10), ("light", 200)) for k in range(8)}
    tree |= {"dark/broken.png": b"no image", "stray.png": png(np.full((4, 4, 3), 99, np.uint8))}
    root, out = write_tree(tree), str(tmp_path / "out")
    listing = S.list_raw_files(spark, root)
    pixels = S.read_images(spark, root, listing)
    rows = MF.build_manifest(listing, root, out, failed=S.undecodable(listing, pixels))
    augmented = MF.augment_fanout(rows)
    tables.write_manifest(augmented, f"{out}/manifest")
    augmented = tables.read_manifest(spark, f"{out}/manifest", augmented=True)
    S.write_normalized(MF.with_normalized_paths(I.normalize_images(pixels, 4, 4), augmented), f"{out}/images")
    vectors = encode.embed(S.read_normalized(spark, f"{out}/images"), lambda: lambda batch: np.stack([[i.mean(), 128.0] for i in batch]))
    tables.write_embeddings(MF.with_embedding_index(vectors, augmented), f"{out}/embeddings")
    joined = MF.attach_embeddings(augmented, tables.read_embeddings(spark, f"{out}/embeddings"))
    assert joined.count() == 17 and joined.filter("embedding is null").count() == 0
    parts = split.stratified_split(joined.filter("label_id >= 0"), "embedding_index")
    centred = parts.withColumn("embedding", F.expr("transform(embedding, v -> float(v - 128))"))
    network = mlp.centroid_network(centred.filter("split = 'train'"))
    classes = augmented.filter("label_id >= 0").select("label_id", "label_name").distinct()
    report = evaluate(mlp.predict(centred, network), classes).report.collect()
    assert {r.label_name for r in report} == {"dark", "light"} and all(r.f1 == 1.0 for r in report)
