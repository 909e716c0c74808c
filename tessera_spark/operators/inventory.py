"""Dataset inventory and stage overview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera_spark.functions import bands
from tessera_spark.functions.text import clock_text, truncate
from tessera_spark.schemas import DATASET_STATUS

# Artefact names of a dataset folder and the stages of a run.
MANIFEST_FILE = "image_classifier_data.csv"
EMBEDDINGS_FILE = "image_embeddings.npy"
WEIGHTS_FILE = "model.pth"
CONFIG_FILE = "model_config.json"
STAGES = (
    ("CSV Generation", "csv_generation"),
    ("Embedding Generation", "embedding_generation"),
    ("Model Training", "model_training"),
    ("Model Testing", "model_testing"),
)


def artefact_flags(files: DataFrame) -> DataFrame:
    """``(dataset, file_name)`` rows to one row of presence flags per dataset; combined before
    the shuffle."""

    def has(name: str) -> Column:
        return F.bool_or(F.col("file_name") == name)

    return files.groupBy("dataset").agg(
        has(MANIFEST_FILE).alias("has_csv"),
        has(EMBEDDINGS_FILE).alias("has_embeddings"),
        (has(WEIGHTS_FILE) & has(CONFIG_FILE)).alias("has_model"),
    )


def dataset_inventory(raw: DataFrame, files: DataFrame, raw_root: str, normalized_root: str) -> DataFrame:
    """Status of every raw dataset ``(dataset)``, from the files of its normalised folder."""
    found = raw.select("dataset").distinct().join(artefact_flags(files), "dataset", "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("has_csv", "has_embeddings", "has_model")]
    home = F.concat(F.lit(normalized_root.rstrip("/") + "/"), "dataset")

    def inside(name: str) -> Column:
        return F.concat(home, F.lit("/" + name))

    flagged = found.select("dataset", *flags)
    return flagged.select(
        F.col("dataset").alias("name"),
        F.concat(F.lit(raw_root.rstrip("/") + "/"), "dataset").alias("raw_path"),
        home.alias("normalized_path"),
        inside(MANIFEST_FILE).alias("csv_path"),
        inside(EMBEDDINGS_FILE).alias("embeddings_path"),
        inside(WEIGHTS_FILE).alias("model_path"),
        "has_csv",
        "has_embeddings",
        "has_model",
        bands.stage_of(F.col("has_csv"), F.col("has_embeddings"), F.col("has_model")).alias("stage"),
    ).select(*DATASET_STATUS.fieldNames())


def dataset_lookup(inventory: DataFrame, name: str) -> DataFrame:
    """The status record of one dataset; empty when there is none."""
    return inventory.filter(F.col("name") == name).limit(1)


def with_start_stage(inventory: DataFrame) -> DataFrame:
    return inventory.withColumn("start_from", bands.start_stage(F.col("stage")))


def stage_summary(events: DataFrame) -> DataFrame:
    """Latest state of the four stages from ``stage, completed, time, output_path, results``.
    Stages that never completed show N/A."""
    spark = events.sparkSession
    names = spark.createDataFrame(
        [(i, label, key) for i, (label, key) in enumerate(STAGES)],
        "place int, stage_name string, stage string",
    )
    latest = events.groupBy("stage").agg(
        F.max(
            F.struct("time", "completed", F.coalesce("output_path", "results").alias("output"))
        ).alias("_e")
    )
    done = F.coalesce(F.col("_e.completed"), F.lit(False))
    missing = F.lit("N/A")
    return names.join(latest, "stage", "left").select(
        "place",
        "stage_name",
        done.alias("completed"),
        F.when(done, F.coalesce(clock_text(F.col("_e.time")), missing)).otherwise(missing).alias("completion_time"),
        F.when(done, F.coalesce(truncate(F.col("_e.output"), 50, 47), missing)).otherwise(missing).alias("output"),
    )
