"""The given tables seen as listings, vectors, runs and log lines.

Every row of a table takes part: what a column value means is mapped, nothing is left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera_spark.functions.paths import TEST_LABEL, TEST_LABEL_ID
from tessera_spark.functions.text import explode_lines
from tessera_spark.operators.mlp import Layer, Network, centroid_network, predict
from tessera_spark.operators.numbering import integer_bucket, rank_in_group
from tessera_spark.operators.split import stratified_split
from tessera_spark.streaming.common import stream_table

RAW_ROOT, NORMALIZED_ROOT = "/raw", "/normalized"
# A document's source says where its file lies and of which type it is.
ROOT_SOURCE, TEST_SOURCE = "src0", "src1"
SUFFIX_OF_SOURCE = {"src2": ".txt", "src3": ".JPG", "src4": ".bmp", "src5": ".jpeg", "src6": ".PNG"}
TEXT_LANGUAGE = "de"
# An event's type is read as an artefact, a metric series, a stage or a kind of log line.
ARTEFACT_OF_EVENT = {
    "click": "image_classifier_data.csv",
    "error": "image_embeddings.npy",
    "purchase": "model.pth",
    "signup": "model_config.json",
    "view": "notes.txt",
}
SERIES_OF_EVENT = {
    "click": ("train", "loss"),
    "error": ("val", "loss"),
    "purchase": ("train", "acc"),
    "signup": ("val", "acc"),
    "view": ("val", "f1_score"),
}
STAGE_OF_EVENT = {
    "click": "csv_generation",
    "error": "embedding_generation",
    "purchase": "model_training",
    "signup": "model_testing",
    "view": "other",
}
KIND_OF_EVENT = {
    "click": "VALIDATION_RUN",
    "error": "VISUALIZATION_FAILED",
    "purchase": "VISUALIZATION_ATTEMPT",
    "signup": "VISUALIZATION_SUCCESS",
    "view": "TRAINING_COMPLETED",
}


_schemas: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Its footer is looked at once; later reads state the schema."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def stream(spark: SparkSession, sf_dir: str, name: str, whole: bool = False) -> DataFrame:
    """One of the given tables as a stream."""
    return stream_table(spark, f"{sf_dir}/{name}.parquet", read(spark, sf_dir, name).schema, whole)


def lookup(column: str, values: dict[str, str]):
    out = None
    for key, value in values.items():
        out = F.when(F.col(column) == key, value) if out is None else out.when(F.col(column) == key, value)
    return out


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a raw folder: root files, a test folder, and label folders by language."""
    suffix = (
        F.when((F.col("source") == TEST_SOURCE) & (F.col("lang") == TEXT_LANGUAGE), ".txt")
        .otherwise(F.coalesce(lookup("source", SUFFIX_OF_SOURCE), F.lit(".png")))
    )
    folder = (
        F.when(F.col("source") == ROOT_SOURCE, "")
        .when(F.col("source") == TEST_SOURCE, "test_data/")
        .otherwise(F.concat("lang", F.lit("/")))
    )
    return read(spark, sf_dir, "documents").select(
        F.concat(F.lit(RAW_ROOT + "/"), folder, F.col("doc_id").cast("string"), suffix).alias("path"),
        F.col("n_chars").alias("length"),
        "doc_id",
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with file and label columns. The document of the same number says whether
    the file lies in the unlabelled part."""
    sources = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "source")
    unlabelled = F.coalesce(F.col("source").isin(ROOT_SOURCE, TEST_SOURCE), F.lit(False))
    label = F.when(unlabelled, F.lit(TEST_LABEL_ID)).otherwise(F.col("label"))
    name = F.when(unlabelled, TEST_LABEL).otherwise(F.concat(F.lit("class_"), F.col("label").cast("string")))
    file_name = F.format_string("%s_%04d.png", name, F.col("vec_id"))
    return read(spark, sf_dir, "embeddings").join(sources, "vec_id", "left").select(
        F.col("vec_id").alias("embedding_index"),
        F.concat(F.lit(NORMALIZED_ROOT + "/"), name, F.lit("/"), file_name).alias("image_path"),
        file_name.alias("image_name"),
        name.alias("label_name"),
        unlabelled.alias("is_test"),
        label.cast("int").alias("label_id"),
        "embedding",
    )


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "embeddings")
        .groupBy(F.col("label").cast("int").alias("label_id"))
        .agg(F.concat(F.lit("class_"), F.first("label").cast("string")).alias("label_name"))
    )


def labelled_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = vectors(spark, sf_dir).filter(F.col("label_id") >= 0)
    return stratified_split(labelled, "embedding_index")


def scored(spark: SparkSession, sf_dir: str, part: str = "val") -> tuple[DataFrame, Network]:
    """Rows of one part ('val', 'unlabelled' or 'all') scored by the centroid head of the
    train part."""
    split = labelled_split(spark, sf_dir)
    network = centroid_network(split.filter(F.col("split") == "train"))
    if part == "val":
        rows = split.filter(F.col("split") == "val")
    elif part == "unlabelled":
        rows = vectors(spark, sf_dir).filter(F.col("label_id") == TEST_LABEL_ID)
    else:
        rows = vectors(spark, sf_dir)
    return predict(rows, network), network


def _grid(rows: int, cols: int) -> np.ndarray:
    return np.sin(np.arange(rows)[:, None] * 7.0 + np.arange(cols)[None, :])


def linear_formula(inputs: int, outputs: int) -> Network:
    """One linear layer whose numbers follow a closed formula, so that SQL can write them too."""
    return [Layer(_grid(outputs, inputs), np.cos(np.arange(outputs, dtype=float)), None)]


def formula_network(inputs: int, hidden: int, outputs: int) -> Network:
    """The same with a hidden layer before it."""
    unit = np.arange(hidden, dtype=float)
    norm = {
        "bn_mean": np.sin(unit) / 10,
        "bn_var": 1 + np.cos(unit) ** 2,
        "bn_gamma": 1 + np.sin(unit + 1) / 2,
        "bn_beta": np.cos(unit) / 10,
    }
    return [Layer(_grid(hidden, inputs), np.cos(unit), norm), *linear_formula(hidden, outputs)]


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runs: the user is the run, the place of an event in its run the epoch."""
    events = read(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        (F.col("value") / 1000).alias("value"),
    )
    key = F.col("event_id")
    return rank_in_group(events, ["run_id"], [key], integer_bucket(key), "epoch")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as log lines: source, turn, line number and text."""
    turns = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("source"), "turn", "text"
    )
    return explode_lines(turns, "text")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a square gray image: element i is pixel i, scaled from [-1, 1]."""
    side = F.sqrt(F.size("embedding")).cast("int")
    level = F.transform(
        "embedding", lambda v: F.lpad(F.hex(F.round((v.cast("double") + 1) * 127.5).cast("int")), 2, "0")
    )
    return read(spark, sf_dir, "embeddings").select(
        F.concat(F.lit(NORMALIZED_ROOT + "/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("image_path"),
        side.alias("height"),
        side.alias("width"),
        F.lit(1).alias("nChannels"),
        F.unhex(F.array_join(level, "")).alias("data"),
    )
