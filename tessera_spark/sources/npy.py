"""NumPy ``.npy`` matrices as a Spark source and sink.

``spark.read.format("npy").load(path)`` has one row per matrix row: ``embedding_index`` and
``embedding``. The header is parsed once, on the driver; a partition is a range of rows, read by
offset, so a file of any size is never held whole. Paths may have any scheme that pyarrow knows.

``write_npy`` is the way back, in two phases. The driver lays out a file of the final size beside the
target; each task writes its rows at the places their index gives; the commit renames the file, and
an abort removes it. A task that runs again writes the same bytes to the same places. The index has
to be dense from 0, which is checked beforehand. Writing by place needs a folder that all executors
share as a file system; object stores cannot do it.
"""

from __future__ import annotations

import io
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

#: Bytes of matrix rows that one partition covers, and that one Arrow batch holds.
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
_KINDS = {"f4": FloatType(), "f8": DoubleType(), "i4": IntegerType(), "i8": LongType()}
_HEADER_MOST = 1 << 16


@dataclass(frozen=True)
class Header:
    rows: int
    columns: int
    kind: str  # as numpy writes it, with byte order
    start: int

    @property
    def row_bytes(self) -> int:
        return self.columns * np.dtype(self.kind).itemsize


def _opened(path: str):
    if "://" not in path and not path.startswith("file:"):
        return pa.fs.LocalFileSystem().open_input_file(os.path.abspath(path))
    system, inner = pa.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return system.open_input_file(inner)


def read_header(path: str) -> Header:
    with _opened(path) as file:
        head = io.BytesIO(file.read(_HEADER_MOST))
    version = np.lib.format.read_magic(head)
    parse = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, by_column, kind = parse(head)
    if len(shape) != 2 or by_column or kind.str[1:] not in _KINDS:
        raise ValueError(f"{path} holds no matrix of numbers kept row by row: shape {shape}, type {kind.str}")
    return Header(shape[0], shape[1], kind.str, head.tell())


def _schema(kind: str) -> StructType:
    return StructType([StructField("embedding_index", LongType()), StructField("embedding", ArrayType(_KINDS[kind[1:]]))])


class Rows(InputPartition):
    def __init__(self, low: int, high: int):
        super().__init__((low, high))


class NpyReader(DataSourceReader):
    def __init__(self, path: str, partition_bytes: int):
        self._path, self._head = path, read_header(path)
        self._step = max(1, partition_bytes // max(1, self._head.row_bytes))

    def partitions(self) -> list[Rows]:
        return [Rows(k, min(k + self._step, self._head.rows)) for k in range(0, self._head.rows, self._step)] or [Rows(0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        low, high = partition.value
        head, most = self._head, max(1, BATCH_BYTES // max(1, self._head.row_bytes))
        with _opened(self._path) as file:
            file.seek(head.start + low * head.row_bytes)
            for first in range(low, high, most):
                rows = min(most, high - first)
                body = file.read(rows * head.row_bytes)
                if len(body) != rows * head.row_bytes:
                    raise ValueError(f"{self._path} ends before row {first + rows}")
                cells = np.frombuffer(body, head.kind).astype(np.dtype(head.kind).newbyteorder("="), copy=False)
                places = pa.array(np.arange(rows + 1, dtype=np.int32) * head.columns)
                vectors = pa.ListArray.from_arrays(places, pa.array(cells))
                yield pa.record_batch([pa.array(np.arange(first, first + rows)), vectors], ["embedding_index", "embedding"])


@dataclass
class Written(WriterCommitMessage):
    rows: int


class NpyWriter(DataSourceArrowWriter):
    def __init__(self, path: str, rows: int, columns: int, kind: str):
        self._path, self._unfinished = path, f"{path}.{uuid.uuid4().hex}"
        with open(self._unfinished, "wb") as file:
            np.lib.format.write_array_header_1_0(file, {"descr": kind, "fortran_order": False, "shape": (rows, columns)})
            start = file.tell()
            file.truncate(start + rows * columns * np.dtype(kind).itemsize)
        self._head = Header(rows, columns, kind, start)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done, head = 0, self._head
        with open(self._unfinished, "r+b") as file:
            for batch in iterator:
                vectors = batch.column("embedding")
                cells = vectors.flatten().to_numpy(zero_copy_only=False).astype(head.kind).reshape(-1, head.columns)
                index = batch.column("embedding_index").to_numpy()
                # Neighbouring rows go out in one piece.
                for run in np.split(np.arange(len(index)), np.flatnonzero(np.diff(index) != 1) + 1):
                    if len(run):
                        file.seek(head.start + int(index[run[0]]) * head.row_bytes)
                        file.write(cells[run[0] : run[-1] + 1].tobytes())
                done += len(index)
            file.flush()
            os.fsync(file.fileno())
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        written = sum(m.rows for m in messages if m is not None)
        if written != self._head.rows:
            self.abort(messages)
            raise ValueError(f"{written} rows written instead of {self._head.rows}")
        os.replace(self._unfinished, self._path)

    def abort(self, messages: list[Written | None]) -> None:
        if os.path.exists(self._unfinished):
            os.remove(self._unfinished)


class NpySource(DataSource):
    """Options: ``path``; to write also ``rows``, ``columns`` and ``kind``, which ``write_npy`` finds."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> StructType:
        return _schema(read_header(self.options["path"]).kind)

    def reader(self, schema: StructType) -> NpyReader:
        return NpyReader(self.options["path"], int(self.options.get("partitionBytes", PARTITION_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> NpyWriter:
        path = self.options["path"].removeprefix("file://").removeprefix("file:")
        if os.path.exists(path) and not overwrite:
            raise FileExistsError(path)
        return NpyWriter(path, int(self.options["rows"]), int(self.options["columns"]), self.options["kind"])


def read_npy(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """``embedding_index`` and ``embedding`` of a stored matrix."""
    spark.dataSource.register(NpySource)
    return spark.read.format("npy").option("partitionBytes", partition_bytes).load(path)


def write_npy(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write ``embedding`` by ``embedding_index`` as one matrix. Mode ``append`` refuses a file that
    is there, ``overwrite`` replaces it when the new one is whole."""
    spark, index = df.sparkSession, F.col("embedding_index").cast("long")
    size = F.size("embedding")
    found = df.agg(
        F.count("*"), F.count_distinct(index), F.min(index), F.max(index), F.min(size), F.max(size), F.count("embedding"),
        F.count_if(F.exists("embedding", lambda x: x.isNull())),
    ).first()
    rows, distinct, low, high, narrow, wide, vectors, holes = found
    if rows and (distinct != rows or low != 0 or high != rows - 1):
        raise ValueError("embedding_index has to be dense from 0")
    if narrow != wide or vectors != rows or holes:
        raise ValueError("vectors have to be there, whole and of one length")
    element = df.schema["embedding"].dataType.elementType
    kind = {FloatType(): "<f4", DoubleType(): "<f8", IntegerType(): "<i4", LongType(): "<i8"}[element]
    spark.dataSource.register(NpySource)
    # Sorted inside a task, so that rows lie side by side where the input was dealt by ranges.
    ordered = df.select(index.alias("embedding_index"), "embedding").sortWithinPartitions("embedding_index")
    ordered.write.format("npy").mode(mode).options(rows=rows, columns=wide or 0, kind=kind).save(path)
