"""Shared parts of the streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tessera_spark.session import delete_folder, materialise, scratch_path

MAX_BYTES_PER_TRIGGER = 1 << 30
NO_LIMIT = (1 << 63) - 1


def stream_parquet(
    spark: SparkSession, folder: str, schema: StructType | str, glob: str | None = None, **options
) -> DataFrame:
    """File stream of a folder. ``maxBytesPerTrigger`` bounds a micro-batch, and with it the
    rows that one key can bring at a time to a stateful step."""
    options.setdefault("maxBytesPerTrigger", MAX_BYTES_PER_TRIGGER)
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.options(**options).parquet(folder)


def stream_table(spark: SparkSession, path: str, schema: StructType | str, whole: bool = False) -> DataFrame:
    """File stream of a table that is one file or a folder of files, on whatever file system it lies.
    The files of a table have no order among them, so a step that goes by the order of rows takes the
    table ``whole``, in one micro-batch: cut anywhere, rows would seem to come late."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    options = {"maxBytesPerTrigger": NO_LIMIT} if whole else {}
    if files.getFileStatus(target).isDirectory():
        return stream_parquet(spark, path, schema, **options)
    return stream_parquet(spark, target.getParent().toString(), schema, glob=target.getName(), **options)


def run_to_table(stream: DataFrame, name: str, output: str | None = None) -> str:
    """Process what is available into a Parquet table and return its path. Progress and state
    live beside it in the shared folder, so a restarted job goes on where it stopped."""
    spark = stream.sparkSession
    output = output or scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", f"{output}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return output


def run_by_batch(stream: DataFrame, name: str, output: str | None = None, after: Callable[[int], None] | None = None) -> str:
    """As ``run_to_table``, each micro-batch into a folder of its own that its number names. A batch
    that is run again, because the job ended between writing it and noting that it is done, replaces
    what it wrote before: no row is there twice. ``after`` is called once a batch is written."""
    output = output or scratch_path(stream.sparkSession, name)

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{output}/batch={number}")
        if after is not None:
            after(number)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{output}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return output


def run_with_state(stream: DataFrame, step: Callable, schemas: dict[str, str], output: str) -> None:
    """Micro-batches with state in tables: ``step(batch, state)`` gets a batch and the named tables of
    the batch before and returns the rows to write and the new tables. A hot key is thus worked on by
    many tasks, with every batch operator at hand. Rows and state of a batch stand in folders that its
    number names: a batch that is run again reads the same state and replaces what it wrote. Of the
    state the last two batches are kept; a table costs one write of all its rows a batch."""
    spark = stream.sparkSession

    def advance(rows: DataFrame, number: int) -> None:
        state = read_state(spark, schemas, output, number - 1)
        shown, after = step(materialise(rows), state)
        for name, table in after.items():
            table.write.mode("overwrite").parquet(f"{output}-state/{number}/{name}")
        shown.write.mode("overwrite").parquet(f"{output}/batch={number}")
        spark.createDataFrame([(number,)], "number long").coalesce(1).write.mode("overwrite").parquet(f"{output}-newest")
        if number > 1:
            delete_folder(spark, f"{output}-state/{number - 2}")

    query = (
        stream.writeStream.foreachBatch(advance)
        .option("checkpointLocation", f"{output}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_state(spark: SparkSession, schemas: dict[str, str], output: str, number: int | None = None) -> dict[str, DataFrame]:
    """The state tables after a batch, by default the newest; before the first they are empty."""
    if number is None:
        found = spark.read.schema("number long").parquet(f"{output}-newest").first()
        number = found["number"]
    if number < 0:
        return {name: spark.createDataFrame([], schema) for name, schema in schemas.items()}
    return {name: spark.read.schema(schema).parquet(f"{output}-state/{number}/{name}") for name, schema in schemas.items()}
