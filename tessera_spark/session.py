"""Session helpers: shared checkpoint folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Dimension tables (classes, per-class quotas, chunk offsets) are broadcast up to this many
# rows; beyond it the join is left to Spark, which shuffles and splits skewed partitions.
MAX_BROADCAST_ROWS = 100_000


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    folder of its own, because no other machine could read it.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            current = tempfile.mkdtemp(prefix="tessera-checkpoints-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder once nothing reads it any more."""
    if not path.startswith(f"{checkpoint_dir(spark).rstrip('/')}/tables/"):
        raise ValueError(f"{path} is no scratch table")
    delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller wrote, on whatever file system it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder; later reads see the same rows and partitions."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Compute a dimension table once. Up to ``max_rows`` rows it becomes a local relation and
    True is returned with it; a larger one goes to the shared folder."""
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows <= max_rows:
        return df.sparkSession.createDataFrame(rows, df.schema), True
    return materialise(df), False


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A dimension table for a join: broadcast when its counted size allows, else as it is."""
    kept, small = settle(df, max_rows)
    return F.broadcast(kept) if small else kept


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt over all cores by a key, for work that is heavy per row. The number of
    partitions is stated, so nothing has to be run to learn how many there are."""
    spark = df.sparkSession
    wanted = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(wanted, key)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that were not started with it. A job
    submitted with ``--py-files`` does not need this."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(package)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for file in sorted(files):
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    out.write(full, os.path.join(name, os.path.relpath(full, package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
