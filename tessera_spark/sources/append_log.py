"""Append-only tables that several writers share. A commit is named by its writer and a batch number:
a repeated one replaces itself, so a retried job appends nothing twice. Small files are compacted
behind a list of the commits that went into the compacted rows.

Layout below a path: ``commits/writer=W/batch=N`` holds the rows of one commit,
``compacted/V/rows`` and ``compacted/V/members`` those of compaction V and the names of its commits.
Members are written after the rows, so a compaction that ended early is never read; the newest whole
one counts. One compaction runs at a time; appending meanwhile is allowed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera_spark.session import delete_folder, materialise, small_side

COMMIT = "writer string, batch long"


def _folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    files, target = _folder(spark, path)
    return files.exists(target)


def _names(spark: SparkSession, path: str) -> list[str]:
    files, target = _folder(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def _newest(spark: SparkSession, path: str) -> int | None:
    whole = [int(v) for v in _names(spark, f"{path}/compacted") if _exists(spark, f"{path}/compacted/{v}/members/_SUCCESS")]
    return max(whole, default=None)


def _members(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).parquet(f"{path}/compacted/{version}/members")


def append(rows: DataFrame, path: str, writer: str | None = None, batch: int = 0) -> None:
    """Append the rows as commit (writer, batch); without a writer as a commit of its own. A commit
    that was compacted already is left as it is. A writer's name must be able to name a folder."""
    spark = rows.sparkSession
    writer = writer or uuid.uuid4().hex
    done = _members(spark, path, _newest(spark, path)).filter((F.col("writer") == writer) & (F.col("batch") == batch))
    if done.isEmpty():
        rows.write.mode("overwrite").parquet(f"{path}/commits/writer={writer}/batch={batch}")


def _open(spark: SparkSession, path: str, schema: StructType, version: int | None) -> DataFrame | None:
    """Rows of the commits that are not compacted, with the names of their commits."""
    if not _names(spark, f"{path}/commits"):
        return None
    named = StructType([*schema.fields, *StructType.fromDDL(COMMIT).fields])
    rows = spark.read.schema(named).parquet(f"{path}/commits")
    return rows.join(small_side(_members(spark, path, version)), ["writer", "batch"], "left_anti")


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows appended so far, each once."""
    version = _newest(spark, path)
    parts = [_open(spark, path, schema, version)]
    if version is not None:
        parts.append(spark.read.schema(schema).parquet(f"{path}/compacted/{version}/rows"))
    parts = [p.select(*schema.fieldNames()) for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def compact(spark: SparkSession, path: str, schema: StructType, files: int = 1) -> None:
    """Bring the rows of all commits into a few files. The commits are listed first: those that come
    meanwhile stay as they are. Folders of commits and of the compaction before are deleted at the end,
    so readers that began earlier should have ended."""
    version = _newest(spark, path)
    rows = _open(spark, path, schema, version)
    if rows is None:
        return
    members = materialise(rows.select("writer", "batch").distinct())
    listed = [(r["writer"], r["batch"]) for r in members.toLocalIterator()]
    fresh = rows.join(small_side(members), ["writer", "batch"], "left_semi").select(*schema.fieldNames())
    target = f"{path}/compacted/{0 if version is None else version + 1}"
    if version is not None:
        fresh = fresh.unionByName(spark.read.schema(schema).parquet(f"{path}/compacted/{version}/rows"))
    fresh.repartition(files).write.mode("overwrite").parquet(f"{target}/rows")
    _members(spark, path, version).unionByName(members).coalesce(1).write.mode("overwrite").parquet(f"{target}/members")
    for writer, batch in listed:
        delete_folder(spark, f"{path}/commits/writer={writer}/batch={batch}")
    if version is not None:
        delete_folder(spark, f"{path}/compacted/{version}")
