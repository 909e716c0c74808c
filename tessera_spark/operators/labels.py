"""Label dimension: ids by first appearance, encoding, decoding, dense classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera_spark.functions.paths import TEST_LABEL, TEST_LABEL_ID
from tessera_spark.session import small_side


def distinct_labels(df: DataFrame, label: str = "label_name", position: str = "position") -> DataFrame:
    """Labels other than the unlabelled one with the position of their first row."""
    return (
        df.filter(F.col(label) != TEST_LABEL)
        .groupBy(F.col(label).alias("label_name"))
        .agg(F.min(position).alias("first_position"))
    )


def first_appearance_ids(df: DataFrame, label: str = "label_name", position: str = "position") -> DataFrame:
    """``classes(label_id, label_name)``: ids 0..k-1 in order of first appearance. The window
    runs over one row per label, after the rows are aggregated."""
    rank = F.row_number().over(W.orderBy("first_position")) - 1
    return distinct_labels(df, label, position).select(rank.cast("int").alias("label_id"), "label_name")


def class_names(df: DataFrame, position: str = "embedding_index") -> DataFrame:
    """First label name per id. Names are first reduced to one row per (id, name), so that the
    large aggregation keeps only a number per key."""
    seen = (
        df.filter(F.col("label_id") >= 0)
        .groupBy("label_id", "label_name")
        .agg(F.min(position).alias("_first"))
    )
    return seen.groupBy("label_id").agg(F.min_by("label_name", "_first").alias("label_name"))


def encode_labels(df: DataFrame, classes: DataFrame, label: str = "label_name") -> DataFrame:
    """Add ``label_id``: the unlabelled name gets -1, a name without a class gets null."""
    names = classes.select(F.col("label_name").alias("_name"), F.col("label_id").alias("_id"))
    joined = df.join(small_side(names), F.col(label) == F.col("_name"), "left")
    encoded = F.when(F.col(label) == TEST_LABEL, TEST_LABEL_ID).otherwise(F.col("_id"))
    return joined.withColumn("label_id", encoded.cast("int")).drop("_name", "_id")


def decode_labels(
    df: DataFrame, classes: DataFrame, id_column: str, out: str = "label_name", checked: bool = True
) -> DataFrame:
    """Add the class name of an id; an id beyond the classes becomes ``Unknown_<id>``. Set
    ``checked`` to False for a side whose size is already known to be small."""
    names = classes.select(F.col("label_id").alias("_id"), F.col("label_name").alias("_name"))
    side = small_side(names) if checked else names
    joined = df.join(side, F.col(id_column) == F.col("_id"), "left")
    unknown = F.concat(F.lit("Unknown_"), F.col(id_column).cast("string"))
    return joined.withColumn(out, F.coalesce(F.col("_name"), unknown)).drop("_id", "_name")


def label_lookup(label: Column, classes: dict[str, int]) -> Column:
    """Dictionary form of ``encode_labels`` for a handful of classes known to the caller."""
    pairs = [F.lit(v) for item in {**classes, TEST_LABEL: TEST_LABEL_ID}.items() for v in item]
    return F.create_map(*pairs)[label]


def dense_classes(per_class: DataFrame, classes: DataFrame) -> DataFrame:
    """Keep classes without a row: their measures become zero."""
    return classes.join(per_class, "label_id", "left").na.fill(0)
