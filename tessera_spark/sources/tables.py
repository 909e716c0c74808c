"""Readers and writers of the stage tables. Parquet is the working form, CSV and JSON the
exchange forms. Each stage writes a path of its own, never one it reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera_spark import schemas
from tessera_spark.operators.mlp import Network, layers_frame, network_from

# Cuts a table of hot partitions into files of about this many rows.
MAX_RECORDS_PER_FILE = 5_000_000


def _read(spark: SparkSession, path: str, schema: StructType, form: str) -> DataFrame:
    reader = spark.read.schema(schema)
    if form == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(form).load(path)


def _write(df: DataFrame, path: str, form: str, mode: str) -> None:
    writer = df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if form == "csv":
        writer = writer.option("header", True)
    writer.format(form).save(path)


def read_manifest(spark: SparkSession, path: str, form: str = "parquet", augmented: bool = False) -> DataFrame:
    return _read(spark, path, schemas.AUGMENTED_MANIFEST if augmented else schemas.MANIFEST, form)


def write_manifest(df: DataFrame, path: str, form: str = "parquet", mode: str = "errorifexists") -> None:
    names = schemas.AUGMENTED_MANIFEST if "embedding_index" in df.columns else schemas.MANIFEST
    _write(df.select(*names.fieldNames()), path, form, mode)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.EMBEDDINGS, "parquet")


def write_embeddings(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.EMBEDDINGS.fields]
    _write(df.select(*columns), path, "parquet", mode)


def export_results(scored: DataFrame, path: str, form: str = "parquet", mode: str = "errorifexists") -> None:
    _write(scored.select(*schemas.SCORED.fieldNames()), path, form, mode)


def read_results(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.SCORED, form)


def export_confusion(wide: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The k x k matrix as one CSV with class names as first column and header."""
    rows = wide.orderBy("label_id").drop("label_id").coalesce(1)
    rows.write.mode(mode).option("header", True).csv(path)


def write_config(config: DataFrame, path: str, mode: str = "errorifexists") -> None:
    config.coalesce(1).write.mode(mode).json(path)


def read_config(spark: SparkSession, path: str, schema: StructType = schemas.MODEL_CONFIG) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def model_config(
    spark: SparkSession,
    input_size: int,
    hidden_units: Sequence[int],
    clip_models: Sequence[tuple[str, str]],
    class_labels: Sequence[str],
) -> DataFrame:
    """One-row configuration table."""
    row = (input_size, len(class_labels), list(hidden_units), list(clip_models), list(class_labels))
    return spark.createDataFrame([row], schemas.MODEL_CONFIG)


def save_layers(spark: SparkSession, network: Network, path: str, mode: str = "errorifexists") -> None:
    layers_frame(spark, network).write.mode(mode).parquet(path)


def load_layers(spark: SparkSession, path: str) -> Network:
    """Network of a stored layer table; a missing path is an error."""
    return network_from(spark.read.schema(schemas.LAYERS).parquet(path))


def save_processors(steps: PipelineModel, path: str) -> None:
    steps.write().overwrite().save(path)


def load_processors(path: str | None) -> PipelineModel:
    """Fitted steps; without a path no step is applied."""
    return PipelineModel.load(path) if path else PipelineModel(stages=[])
