"""Data-quality checks: the assertions of the workflow as tables of findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.functions.paths import TEST_LABEL, TEST_LABEL_ID
from tessera_spark.operators.labels import dense_classes


def positional_check(manifest: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Rows and distinct keys of both tables, and rows without a partner on either side. Both
    sides are combined per key before they meet, so duplicates cannot multiply."""
    key = "embedding_index"
    left = manifest.groupBy(key).agg(F.count(F.lit(1)).alias("_m"))
    right = embeddings.groupBy(key).agg(F.count(F.lit(1)).alias("_e"))
    both = left.join(right, key, "full_outer").na.fill(0, ["_m", "_e"])
    return both.agg(
        F.coalesce(F.sum("_m"), F.lit(0)).alias("manifest_rows"),
        F.coalesce(F.sum("_e"), F.lit(0)).alias("embedding_rows"),
        F.coalesce(F.sum(F.when(F.col("_e") == 0, F.col("_m"))), F.lit(0)).alias("manifest_only"),
        F.coalesce(F.sum(F.when(F.col("_m") == 0, F.col("_e"))), F.lit(0)).alias("embeddings_only"),
        F.count_if(F.col("_e") > 1).alias("duplicate_keys"),
    )


def wrong_dimension(embeddings: DataFrame, dimension: int) -> DataFrame:
    size = F.size("embedding")
    return embeddings.filter((size != dimension) | F.col("embedding").isNull()).select(
        "embedding_index", size.alias("dimension")
    )


def sentinel_violations(manifest: DataFrame) -> DataFrame:
    """Rows where the unlabelled id, the flag and the unlabelled name disagree, such as those
    of a raw folder that bears the unlabelled name."""
    by_id = F.col("label_id") == TEST_LABEL_ID
    by_name = F.col("label_name") == TEST_LABEL
    return manifest.filter(
        F.col("label_id").isNull() | (by_id != F.col("is_test")) | (by_id != by_name)
    )


def class_coverage(split: DataFrame, classes: DataFrame) -> DataFrame:
    """Per class: rows, train rows, and whether it is missing from the train part or too
    small for a stratified split."""
    counts = split.groupBy("label_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("split") == "train").alias("train_rows")
    )
    return dense_classes(counts, classes).select(
        "label_id",
        "label_name",
        "rows",
        "train_rows",
        (F.col("train_rows") == 0).alias("missing_in_train"),
        (F.col("rows") < 2).alias("too_small"),
    )


def class_count_check(split: DataFrame) -> DataFrame:
    """Number of classes over all labelled rows (used) and over the train part (smaller when
    the highest class fell wholly into validation)."""
    train = F.when(F.col("split") == "train", F.col("label_id"))
    return split.agg(
        (F.max("label_id") + 1).alias("num_classes"), (F.max(train) + 1).alias("train_classes")
    ).withColumn("differs", ~F.col("num_classes").eqNullSafe(F.col("train_classes")))


def wrong_size(images: DataFrame, width: int = 224, height: int = 224) -> DataFrame:
    return images.filter((F.col("width") != width) | (F.col("height") != height)).select(
        "image_path", "width", "height"
    )


def stage_ready(inventory: DataFrame) -> DataFrame:
    """Whether the artefacts each stage needs are present."""
    return inventory.select(
        "name",
        F.col("has_csv").alias("can_embed"),
        (F.col("has_csv") & F.col("has_embeddings")).alias("can_train"),
        (F.col("has_csv") & F.col("has_embeddings") & F.col("has_model")).alias("can_evaluate"),
    )
