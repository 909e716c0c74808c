"""Listing of raw folders and reading or writing of image tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera_spark import schemas
from tessera_spark.functions import paths as P
from tessera_spark.schemas import IMAGE_PIXELS, LISTING
from tessera_spark.session import materialise

# Folders below the root that are looked into: the root itself and the folders in it. The
# manifest knows no deeper files; ``levels`` of a call may say otherwise.
LEVELS = 2
_ENTRIES = "path string, length long, modificationTime timestamp, is_folder boolean"
# Content of files is handed on in portions of about this size.
FLUSH_BYTES = 32 << 20

#: Bytes of a file to an array of height x width x channels in blue, green, red order.
Decoder = Callable[[bytes], np.ndarray]


def _file_system(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it and what stands before the path in an address."""
    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, inner, path[: len(path) - len(inner)] if path.endswith(inner) else ""


def _list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entries of each folder, one folder's at a time. Every name counts, also those that begin
    with a dot or underscore, and files without content."""
    for batch in batches:
        for folder in batch["path"]:
            system, inner, before = _file_system(folder)
            found = system.get_file_info(fs.FileSelector(inner, allow_not_found=False))
            yield pd.DataFrame(
                {
                    "path": [before + i.path for i in found],
                    "length": pd.array([i.size for i in found], dtype="Int64"),
                    "modificationTime": pd.to_datetime([i.mtime for i in found], utc=True).tz_localize(None),
                    "is_folder": [i.type == fs.FileType.Directory for i in found],
                }
            )


def list_raw_files(spark: SparkSession, root: str, levels: int = LEVELS) -> DataFrame:
    """One row per file below ``root``, whatever its name or size. Folders are listed by tasks,
    one level of the tree after the other; the driver never holds the entries. The address is
    read by ``pyarrow.fs``, so it must be of a kind that library opens (local, s3, gs, hdfs with
    its native client); any table with ``path`` can be handed to the manifest operators
    instead."""
    folders = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string")
    parts = max(2, spark.sparkContext.defaultParallelism)
    out = None
    for level in range(levels):
        spread = folders.repartition(parts, "path") if level else folders
        entries = materialise(spread.mapInPandas(_list_folders, _ENTRIES))
        files = entries.filter("not is_folder").select(*LISTING.fieldNames())
        out = files if out is None else out.unionByName(files)
        folders = entries.filter("is_folder").select("path")
    return out


def list_dataset_files(spark: SparkSession, root: str) -> DataFrame:
    """``(dataset, file_name)`` of files directly inside the dataset folders of ``root``."""
    relative = P.relative_to(F.col("path"), root)
    return (
        list_raw_files(spark, root)
        .select(F.split(relative, "/").alias("_p"))
        .filter(F.size("_p") == 2)
        .select(F.col("_p")[0].alias("dataset"), F.col("_p")[1].alias("file_name"))
    )


def decode_files(listing: DataFrame, decode: Decoder) -> DataFrame:
    """Pixels of listed files by a decoder of the user's, and ``error`` where it fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*IMAGE_PIXELS.fieldNames(), "error"]
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string()]

        def batch_of(rows):
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                try:
                    system, inner, _ = _file_system(path)
                    with system.open_input_stream(inner) as stream:
                        image = np.ascontiguousarray(decode(stream.read()), dtype=np.uint8)
                    image = image if image.ndim == 3 else image[:, :, None]
                    rows.append((path, *image.shape, image.tobytes(), None))
                    held += image.size
                except Exception as problem:
                    rows.append((path, None, None, None, None, str(problem) or repr(problem)))
                if held >= FLUSH_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
        yield batch_of(rows)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in IMAGE_PIXELS.fields) + ", error string"
    return listing.select("path").mapInArrow(run, schema)


def read_images(spark: SparkSession, root: str, listing: DataFrame | None = None, decode: Decoder | None = None) -> DataFrame:
    """Pixels of all images below ``root``, and ``error`` for those that have none: one row per
    listed image, so nothing is lost silently.

    Spark's image source decodes; it cannot see names that begin with a dot or underscore. With
    ``decode`` every file is read and decoded by that function instead.
    """
    listing = (list_raw_files(spark, root) if listing is None else listing).filter(P.is_image(F.col("path")))
    if decode is not None:
        return decode_files(listing, decode)
    image = F.col("image")
    seen = (
        spark.read.format("image")
        .option("dropInvalid", True)
        .option("recursiveFileLookup", True)
        .load(root)
        .select(
            P.strip_scheme(image["origin"]).alias("_plain"),
            image["height"].alias("height"),
            image["width"].alias("width"),
            image["nChannels"].alias("nChannels"),
            image["data"].alias("data"),
        )
    )
    listed = listing.select(F.col("path").alias("image_path"), P.strip_scheme(F.col("path")).alias("_plain"))
    error = F.when(F.col("data").isNull(), "not decoded")
    return listed.join(seen, "_plain", "left").drop("_plain").withColumn("error", error)


def undecodable(listing: DataFrame, images: DataFrame) -> DataFrame:
    """Listed images without pixels, as ``original_path``."""
    decoded = images.filter(F.col("data").isNotNull()).select(P.strip_scheme(F.col("image_path")).alias("_plain"))
    listed = listing.filter(P.is_image(F.col("path"))).withColumn(
        "_plain", P.strip_scheme(F.col("path"))
    )
    return listed.join(decoded, "_plain", "left_anti").select(F.col("path").alias("original_path"))


def write_normalized(images: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Pixel table; metadata of the source files has no column to live in."""
    images.filter(F.col("data").isNotNull()).select(*IMAGE_PIXELS.fieldNames()).write.mode(mode).parquet(path)


def read_normalized(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.IMAGE_PIXELS).parquet(path)
