from pyspark.sql import functions as F

from tessera_spark.operators import checks, inventory
from tessera_spark.sources import files as S


def test_inventory_from_folders(spark, tmp_path):
    layout = {
        "none": [], "csv": ["image_classifier_data.csv"],
        "vectors": ["image_classifier_data.csv", "image_embeddings.npy"],
        "half": ["image_classifier_data.csv", "image_embeddings.npy", "model.pth"],
        "full": ["image_classifier_data.csv", "image_embeddings.npy", "model.pth", "model_config.json"],
    }
    for name, files in layout.items():
        for file in [*files, "other.txt"] if files else []:
            target = tmp_path / "normalized" / name / file
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_text("x")
    raw = spark.createDataFrame([(n,) for n in layout], "dataset string")
    listed = S.list_dataset_files(spark, str(tmp_path / "normalized"))
    table = inventory.dataset_inventory(raw, listed, "/d/raw", "/d/normalized/")
    stages = {r.name: r.stage for r in table.collect()}
    assert stages == {
        "none": "needs_csv", "csv": "needs_embeddings", "vectors": "ready_to_train",
        "half": "ready_to_train", "full": "trained",
    }
    starts = {r.name: r.start_from for r in inventory.with_start_stage(table).collect()}
    assert starts["none"] == "csv" and starts["half"] == "train" and starts["full"] is None
    row = inventory.dataset_lookup(table, "full").first()
    assert row.model_path == "/d/normalized/full/model.pth" and row.raw_path == "/d/raw/full"
    assert inventory.dataset_lookup(table, "absent").count() == 0
    ready = {r.name: (r.can_embed, r.can_train, r.can_evaluate) for r in checks.stage_ready(table).collect()}
    assert ready["half"] == (True, True, False) and ready["none"] == (False, False, False)


def test_stage_summary(spark):
    rows = [
        ("csv_generation", True, "2024-01-01 01:02:03", "x" * 51, None),
        ("csv_generation", False, "2023-01-01 00:00:00", "old", None),
        ("model_testing", True, "2024-01-01 05:00:00", None, "done"),
        ("model_training", False, "2024-01-01 05:00:00", "path", None),
    ]
    events = spark.createDataFrame(rows, "stage string, completed boolean, t string, output_path string, results string")
    got = inventory.stage_summary(events.withColumn("time", F.col("t").cast("timestamp"))).orderBy("place").collect()
    assert [r.stage_name for r in got] == ["CSV Generation", "Embedding Generation", "Model Training", "Model Testing"]
    assert got[0].output == "x" * 47 + "..." and got[0].completion_time == "01:02:03"
    assert (got[1].completed, got[1].output) == (False, "N/A")
    assert (got[2].completed, got[2].completion_time) == (False, "N/A")
    assert got[3].output == "done"
