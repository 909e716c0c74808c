"""Append-only run tables. An append that names its writer and batch can be repeated safely."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera_spark import schemas
from tessera_spark.sources import append_log


def log_epoch_metrics(metrics: DataFrame, path: str, writer: str | None = None, batch: int = 0) -> None:
    append_log.append(metrics.select(*schemas.EPOCH_METRICS.fieldNames()), path, writer, batch)


def read_epoch_metrics(spark: SparkSession, path: str) -> DataFrame:
    return append_log.read(spark, path, schemas.EPOCH_METRICS)


def append_run_events(lines: DataFrame, path: str, writer: str | None = None, batch: int = 0) -> None:
    append_log.append(lines.select(*schemas.RUN_LINES.fieldNames()), path, writer, batch)


def read_run_lines(spark: SparkSession, path: str) -> DataFrame:
    return append_log.read(spark, path, schemas.RUN_LINES)


def write_run_info(info: DataFrame, path: str, mode: str = "append") -> None:
    info.write.mode(mode).json(path)


def read_run_info(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN_INFO).json(path)
