import pytest
from pyspark.sql import functions as F

from tessera_spark.operators import checks, labels
from tessera_spark.operators import manifest as MF
from tessera_spark.plans import tables
from tessera_spark.sources import files as S
from tessera_spark.sources import tables as IO

SF = "/root/testdata/sf0.001"


def build(spark, root, limit=None, failed=None):
    rows = MF.build_manifest(S.list_raw_files(spark, root), root, "/out", limit, failed).orderBy("position")
    return rows.collect()


def names(rows):
    return [(r.image_name, r.label_name, r.label_id) for r in rows]


TREE = {
    "cat/b.png": b"x", "cat/a.PNG": b"x", "cat/notes.txt": b"x", "cat/deep/x.png": b"x",
    "ant/z.jpeg": b"x", "root1.bmp": b"x", "readme.md": b"x",
    "test_data/0.txt": b"x", "test_data/1.png": b"x", "test_data/2.png": b"x",
}


def test_tree(spark, write_tree):
    rows = build(spark, write_tree(TREE))
    assert names(rows) == [
        ("ant_0000.png", "ant", 0),
        ("cat_0000.png", "cat", 1),
        ("cat_0001.png", "cat", 1),
        ("test_root_0000.png", "test", -1),
        ("test_orig_0001.png", "test", -1),
        ("test_orig_0002.png", "test", -1),
    ]
    assert [r.image_path for r in rows][1] == "/out/cat/cat_0000.png"
    assert rows[-1].image_path == "/out/test_data/test_orig_0002.png"
    assert all(r.is_test == (r.label_id == -1) and r.label_prediction is None for r in rows)


@pytest.mark.parametrize("limit, moved", [(None, {}), (0, {}), (1, {"cat": 1}), (5, {})])
def test_limit(spark, write_tree, limit, moved):
    root = write_tree(TREE)
    named = MF.name_files(MF.number_files(S.list_raw_files(spark, root), root), "/out", limit)
    assert {r.raw_label: r.moved for r in MF.moved_to_test(named).collect()} == moved
    if moved:
        row = named.filter("is_overflow").first()
        assert (row.image_name, row.label_name, row.is_test) == ("test_cat_0001.png", "test", True)


def test_empty_and_unlabelled_only(spark, write_tree):
    assert build(spark, write_tree({"readme.md": b"x"})) == []
    root = write_tree({"test_data/a.png": b"x"})
    rows = MF.build_manifest(S.list_raw_files(spark, root), root, "/out")
    summary = MF.manifest_summary(rows).first()
    assert (summary.total, summary.train_rows, summary.test_rows, summary.labels) == (1, 0, 1, 0)


def test_failed_images_leave_gaps(spark, write_tree):
    root = write_tree(TREE)
    broken = S.list_raw_files(spark, root).filter(F.col("path").endswith("a.PNG")).select(
        F.col("path").alias("original_path")
    )
    assert ("cat_0001.png", "cat", 1) in names(build(spark, root, failed=broken))
    assert ("cat_0000.png", "cat", 1) not in names(build(spark, root, failed=broken))


def test_folder_named_like_the_unlabelled_part(spark, write_tree):
    root = write_tree({"test/a.png": b"x", "cat/a.png": b"x"})
    rows = MF.build_manifest(S.list_raw_files(spark, root), root, "/out")
    found = checks.sentinel_violations(rows).collect()
    assert [(r.label_name, r.is_test, r.label_id) for r in found] == [("test", False, -1)]


@pytest.mark.parametrize("copies", [0, 2])
def test_fanout_keys(spark, copies):
    files = tables.listing(spark, SF)
    made = MF.build_manifest(files, "/raw", "/out", 10)
    order = [r.image_path for r in made.orderBy("position").collect()]
    n = len(order)
    got = {
        (r.image_path, r.aug_version): r.embedding_index
        for r in MF.augment_fanout(made.repartition(7), copies).collect()
    }
    want = {(p, 0): i for i, p in enumerate(order)}
    want |= {(p, a): n + i * copies + a - 1 for i, p in enumerate(order) for a in range(1, copies + 1)}
    assert got == want


def test_union_sources_orders_branches(spark):
    frames = [spark.createDataFrame([(p,)], "path string") for p in ("/r/l/a.png", "/r/b.png", "/r/test_data/c.png")]
    union = MF.union_sources(*frames).orderBy("_source")
    assert [r.path for r in union.collect()] == ["/r/l/a.png", "/r/b.png", "/r/test_data/c.png"]
    one_scan = MF.classify_files(frames[0].union(frames[1]).union(frames[2]), "/r").orderBy("_source")
    assert [(r.path, r._source) for r in union.collect()] == [(r.path, r._source) for r in one_scan.collect()]


def test_positional_check_reports_missing_and_duplicates(spark):
    left = spark.createDataFrame([(0,), (1,), (2,)], "embedding_index long")
    right = spark.createDataFrame([(0,), (0,), (5,)], "embedding_index long")
    row = checks.positional_check(left, right).first()
    assert tuple(row) == (3, 3, 2, 1, 1)


def test_wrong_dimension_and_files(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, None)], "embedding_index long, embedding array<float>")
    assert {r.embedding_index for r in checks.wrong_dimension(rows, 2).collect()} == {1, 2}
    listed = spark.createDataFrame([("/a",)], "path string")
    manifest = spark.createDataFrame([("/a",), ("/b",)], "image_path string")
    assert [r.image_path for r in MF.missing_files(manifest, listed).collect()] == ["/b"]
    assert [r.image_path for r in MF.existing_files(manifest, listed).collect()] == ["/a"]


def test_labels(spark):
    rows = spark.createDataFrame([("b", 3), ("a", 5), ("b", 9), ("test", 0)], "label_name string, position long")
    known = labels.first_appearance_ids(rows)
    assert {r.label_name: r.label_id for r in known.collect()} == {"b": 0, "a": 1}
    more = rows.union(spark.createDataFrame([("new", 11)], rows.schema))
    coded = {r.position: r.label_id for r in labels.encode_labels(more, known).collect()}
    assert coded == {3: 0, 5: 1, 9: 0, 0: -1, 11: None}
    by_map = rows.select(labels.label_lookup(F.col("label_name"), {"b": 0, "a": 1}).alias("i"), "position")
    assert {r.position: r.i for r in by_map.collect()} == {3: 0, 5: 1, 9: 0, 0: -1}
    ids = spark.createDataFrame([(0,), (7,)], "i int")
    assert {r.i: r.label_name for r in labels.decode_labels(ids, known, "i").collect()} == {0: "b", 7: "Unknown_7"}


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_manifest_round_trip(spark, tmp_path, form):
    made = MF.build_manifest(tables.listing(spark, SF), "/raw", "/out", 10)
    path = str(tmp_path / f"m.{form}")
    IO.write_manifest(made, path, form)
    back = IO.read_manifest(spark, path, form)
    assert back.schema.fieldNames() == made.drop("position").columns
    assert sorted(map(str, back.collect())) == sorted(map(str, made.drop("position").collect()))


def test_listing_holds_names_only(spark, write_tree):
    listing = S.list_raw_files(spark, write_tree(TREE))
    assert listing.columns == ["path", "length", "modificationTime"]
    assert {r.length for r in listing.collect()} == {len(body) for name, body in TREE.items() if name.count("/") < 2}


def test_row_filters(spark):
    rows = spark.createDataFrame(
        [("p", "n", "a", False, 0), ("p", "n", "test", True, -1)],
        "image_path string, image_name string, label_name string, is_test boolean, label_id int",
    )
    assert MF.train_rows(rows).count() == MF.test_rows(rows).count() == 1
    assert MF.labelled_rows(rows).first().label_name == "a"
    assert MF.unlabelled_rows(rows).first().label_name == "test"
    assert MF.info_columns(rows).columns == ["image_path", "image_name", "label_name", "label_id"]
