"""The log-line filter over a stream. The pattern part is stateless and runs before the
shuffle; per source only the last kept line is remembered.

``log_filter_stream`` takes lines in the order they come. ``log_filter_by_time`` takes them by their
event time: lines out of order wait until the watermark has passed them, so the lines shown do not
depend on how the input was cut into micro-batches, and a source with most of the lines is worked on in
buckets of its time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera_spark.operators.logs import drop_repeats, filter_lines
from tessera_spark.session import materialise
from tessera_spark.streaming.common import read_state, run_with_state

OUTPUT = "source long, turn long, line_no int, line string"
STATE = "line string"


def log_filter_stream(lines: DataFrame) -> DataFrame:
    """Shown lines of a stream of ``(source long, turn long, line_no int, line string)``."""

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["turn", "line_no"], kind="stable")
        before = rows["line"].shift(1)
        if state.exists:
            before.iloc[0] = state.get[0]
        state.update((rows["line"].iloc[-1],))
        yield rows.loc[rows["line"] != before, ["source", "turn", "line_no", "line"]]

    return (
        filter_lines(lines)
        .select("source", "turn", "line_no", "line")
        .groupBy("source")
        .applyInPandasWithState(advance, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
    )


TABLES = {"waiting": OUTPUT, "last": OUTPUT, "mark": "seen long, late long"}
ORDER = ["turn", "line_no"]


def _release(ready: DataFrame, last: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shown lines of those that are ready, and every source's new last line. A source's last line
    stands before its new ones and is not shown again."""
    rows = materialise(ready.withColumn("_new", F.lit(True)).unionByName(last.withColumn("_new", F.lit(False))))
    shown = drop_repeats(rows, "source", ORDER).filter("_new").drop("_new")
    newest = rows.groupBy("source").agg(F.max(F.struct(*ORDER, "line")).alias("_l"))
    return shown, newest.select("source", "_l.*")


def log_filter_by_time(lines: DataFrame, output: str, delay: int) -> DataFrame:
    """Shown lines of a stream of ``(source long, turn long, line_no int, line string)``, where ``turn``
    is the event time. The watermark lies ``delay`` below the highest time of the batches so far; lines
    at or below the watermark before their batch are late: counted (``late_lines``), never shown. What
    still waits at the end is shown as if the watermark had passed it, in a folder that the next run of
    the job replaces. Lines without source or time are left out; a line that comes twice is one repeat
    after the other."""

    def step(batch: DataFrame, state: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, DataFrame]]:
        mark = state["mark"].first()
        seen, late = (mark["seen"], mark["late"]) if mark else (None, 0)
        batch = batch.filter("source IS NOT NULL AND turn IS NOT NULL")
        on_time = F.lit(True) if seen is None else F.col("turn") > seen - delay
        counts = batch.agg(F.max("turn").alias("seen"), F.count_if(~on_time).alias("late")).first()
        seen = max((s for s in (seen, counts["seen"]) if s is not None), default=None)
        waiting = state["waiting"].unionByName(filter_lines(batch.filter(on_time)))
        passed = F.lit(False) if seen is None else F.col("turn") <= seen - delay
        shown, last = _release(waiting.filter(passed), state["last"])
        mark = batch.sparkSession.createDataFrame([(seen, late + counts["late"])], TABLES["mark"])
        return shown, {"waiting": waiting.filter(~passed), "last": last, "mark": mark}

    spark = lines.sparkSession
    run_with_state(lines.select("source", "turn", "line_no", "line"), step, TABLES, output)
    rest = read_state(spark, TABLES, output)
    _release(rest["waiting"], rest["last"])[0].write.mode("overwrite").parquet(f"{output}/batch=-1")
    return spark.read.parquet(output).drop("batch")


def late_lines(spark: SparkSession, output: str) -> int:
    """Lines so far that came after the watermark had passed them."""
    return read_state(spark, TABLES, output)["mark"].first()["late"]
