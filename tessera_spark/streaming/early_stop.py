"""Early stopping over a stream of metric values, keyed by run.

State per run is a handful of numbers. Values of a micro-batch are taken in epoch order; an
epoch not after the last one seen is late: it is ignored and counted. Every micro-batch emits
one row per run it touched, and ``latest`` keeps the newest of them.

``early_stop_stream`` holds the state in Spark's store and takes a micro-batch's rows of a run in one
task. ``early_stop_batches`` holds it in tables and resolves each batch by bucketed prefix maxima, so a
run with most of the rows is spread over tasks. Both give the same rows, but for two values of one epoch
in one batch: there the first to come counts, or the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera_spark.operators.runs import MIN_DELTA, PATIENCE, resume_early_stop
from tessera_spark.session import materialise, small_side
from tessera_spark.streaming.common import run_with_state

OUTPUT = (
    "run_id long, stop_epoch long, best_epoch long, best_value double, misses long, "
    "epochs long, late long"
)
STATE = (
    "last_epoch long, stop_epoch long, best_epoch long, best_value double, misses long, "
    "epochs long, late long"
)


def fold(values: np.ndarray, best: float | None, misses: int, patience: int, min_delta: float) -> tuple[float | None, int | None, int, int | None]:
    """Fold the next values of a run in order: (best, place of its last improvement here, misses,
    place where it stops). Only a value above all before it can improve, so only those are
    walked; where misses reach the patience follows from the places of the improvements."""
    broken = np.flatnonzero(~np.isfinite(values))
    end = int(broken[0]) if len(broken) else len(values)
    before = np.maximum.accumulate(np.concatenate([[-np.inf if best is None else best], values[:end]]))[:-1]
    improved, last = None, -1 - misses
    for at in np.flatnonzero(values[:end] > before).tolist():
        if at - last - 1 >= patience:
            break
        if best is None or values[at] - min_delta > best:
            best, improved, last = float(values[at]), at, at
    if last + patience < end:
        return best, improved, patience, last + patience
    return best, improved, end - 1 - last, end if end < len(values) else None


def early_stop_stream(values: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA) -> DataFrame:
    """State rows for a stream of ``(run_id long, epoch long, value double)``."""

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            last, stop, best_epoch, best, misses, epochs, late = state.get
        else:
            last, stop, best_epoch, best, misses, epochs, late = None, None, None, None, 0, 0, 0
        rows = pd.concat(list(batches)).sort_values("epoch", kind="stable")
        fresh = ~rows["epoch"].duplicated().to_numpy()
        if last is not None:
            fresh &= (rows["epoch"] > last).to_numpy()
        late += int((~fresh).sum())
        rows = rows[fresh]
        number = rows["epoch"].to_numpy()
        if len(number):
            last, epochs = int(number[-1]), epochs + len(number)
        if len(number) and stop is None:
            best, improved, misses, stopped = fold(rows["value"].to_numpy(dtype=float), best, misses, patience, min_delta)
            best_epoch = best_epoch if improved is None else int(number[improved])
            stop = None if stopped is None else int(number[stopped])
        kept = (last, stop, best_epoch, best, misses, epochs, late)
        state.update(kept)
        yield pd.DataFrame(
            {
                "run_id": [key[0]],
                "stop_epoch": pd.array([stop], dtype="Int64"),
                "best_epoch": pd.array([best_epoch], dtype="Int64"),
                "best_value": [best],
                "misses": [misses],
                "epochs": [epochs],
                "late": [late],
            }
        )

    return (
        values.select("run_id", "epoch", "value")
        .groupBy("run_id")
        .applyInPandasWithState(advance, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
    )


LAST = {"runs": f"{OUTPUT}, last_epoch long"}


def early_stop_batches(values: DataFrame, output: str, patience: int = PATIENCE, min_delta: float = MIN_DELTA) -> str:
    """State rows for a stream of ``(run_id long, epoch long, value double)``, written below ``output``
    in folders by batch; returns ``output``. Runs without a name are left out."""

    def step(batch: DataFrame, state: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, DataFrame]]:
        before = state["runs"]
        known = small_side(before.select("run_id", "last_epoch", "stop_epoch"))
        rows = batch.filter("run_id IS NOT NULL AND epoch IS NOT NULL").groupBy("run_id", "epoch")
        rows = materialise(
            rows.agg(F.min("value").alias("value"), F.count(F.lit(1)).alias("_n"))
            .join(known, "run_id", "left")
            .withColumn("_fresh", F.col("last_epoch").isNull() | (F.col("epoch") > F.col("last_epoch")))
        )
        fresh = F.col("_fresh").cast("long")
        touched = rows.groupBy("run_id").agg(
            F.sum(fresh).alias("_new"),
            F.sum(F.col("_n") - fresh).alias("_late"),
            F.max(F.when(F.col("_fresh"), F.col("epoch"))).alias("_last"),
        )
        active = rows.filter(F.col("_fresh") & F.col("stop_epoch").isNull())
        begun = before.filter("stop_epoch IS NULL AND best_epoch IS NOT NULL").join(active.select("run_id").distinct(), "run_id", "left_semi")
        values = begun.select("run_id", F.col("best_epoch").alias("epoch"), F.col("best_value").alias("value"), (F.col("misses") + 1).alias("weight"))
        values = values.unionByName(active.select("run_id", "epoch", "value", F.lit(1).cast("long").alias("weight")))
        now = resume_early_stop(values, patience, min_delta).select("run_id", *(F.col(c).alias(f"_{c}") for c in ("stop_epoch", "best_epoch", "best_value", "misses")))
        # ``before`` and ``touched`` have one row per run, like ``now``.
        joined = before.join(touched, "run_id", "full").join(now, "run_id", "left")
        zero = F.lit(0).cast("long")
        after = joined.select(
            "run_id",
            F.coalesce("stop_epoch", "_stop_epoch").alias("stop_epoch"),
            F.coalesce("_best_epoch", "best_epoch").alias("best_epoch"),
            F.coalesce("_best_value", "best_value").alias("best_value"),
            F.coalesce("_misses", "misses", zero).alias("misses"),
            (F.coalesce("epochs", zero) + F.coalesce("_new", zero)).alias("epochs"),
            (F.coalesce("late", zero) + F.coalesce("_late", zero)).alias("late"),
            F.coalesce("_last", "last_epoch").alias("last_epoch"),
            F.col("_new").isNotNull().alias("_touched"),
        )
        after = materialise(after)
        return after.filter("_touched").drop("_touched", "last_epoch"), {"runs": after.drop("_touched")}

    run_with_state(values.select("run_id", "epoch", "value"), step, LAST, output)
    return output


def latest(states: DataFrame) -> DataFrame:
    """Newest state row of every run; counters only grow, so they order the rows."""
    order = F.struct(F.col("epochs") + F.col("late"))
    columns = [c for c in states.columns if c != "run_id"]
    newest = states.groupBy("run_id").agg(F.max_by(F.struct(*columns), order).alias("_s"))
    return newest.select("run_id", "_s.*")
