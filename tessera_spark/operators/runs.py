"""Training-run tables: best epoch, early stopping, progress, event lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera_spark.functions import bands, schedules
from tessera_spark.functions.text import bar, duration_text
from tessera_spark.operators.numbering import integer_bucket, previous_in_group, prefix_in_group
from tessera_spark.session import materialise, small_side

# Patience and smallest gain of early stopping, monitored series.
PATIENCE = 50
MIN_DELTA = 1e-7
MONITORED = "val_recall"


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def series(metrics: DataFrame, name: str = MONITORED) -> DataFrame:
    """One monitored series of ``epoch_metrics`` as (run_id, epoch, value)."""
    return metrics.filter(F.concat_ws("_", "phase", "name") == name).select("run_id", "epoch", "value")


def best_epoch(values: DataFrame) -> DataFrame:
    """Epoch with the highest value per run, the earliest on ties, and the last epoch, whose
    weights are the ones a run leaves behind. Non-numbers never win."""
    rank = F.struct(
        F.when(F.isnan("value"), float("-inf")).otherwise(F.col("value")).alias("value"),
        (-F.col("epoch")).alias("back"),
    )
    best = values.groupBy("run_id").agg(F.max(rank).alias("_b"), F.max("epoch").alias("last_epoch"))
    return best.select(
        "run_id", (-F.col("_b.back")).alias("best_epoch"), F.col("_b.value").alias("best_value"), "last_epoch"
    )


def early_stop(values: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA) -> DataFrame:
    """Where early stopping ends each run of ``(run_id, epoch, value)``.

    A value improves when it exceeds the best improvement so far by more than ``min_delta``;
    after ``patience`` epochs without one, or at a value that is not finite, the run stops.
    Returns ``run_id, stop_epoch`` (null when it never stops)``, best_epoch, best_value,
    misses`` (epochs without improvement when it ended)`` , epochs``. Epochs are unique per run.

    A run is never gathered. Only a strict running maximum can be an improvement, and one that
    exceeds the previous maximum by more than ``min_delta`` surely is. Both follow from a prefix
    maximum over epoch buckets. Records with a smaller gain depend on the improvements before
    them: each bucket is summed up as a function from the best before it to the best after it,
    and these functions are applied in turn (``_small_gains``).
    """
    return resume_early_stop(values.withColumn("weight", F.lit(1).cast("long")), patience, min_delta)


def resume_early_stop(values: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA) -> DataFrame:
    """``early_stop`` for runs that began before. A row of weight w stands for itself and w - 1
    epochs after it that did not improve; ``epochs`` counts weights. So the state of a run
    (its best epoch and value, and the misses since) is one row before the new ones."""
    epoch = F.col("epoch").cast("long")
    finite = _finite(F.col("value"))
    clean = F.when(finite, F.col("value"))
    order, bucket = [F.col("epoch")], integer_bucket(epoch)
    ranked = prefix_in_group(
        values, ["run_id"], order, bucket, {"_pos": ("sum", F.col("weight")), "_top": ("max", clean)}
    ).withColumn("_pos", F.coalesce(F.col("_pos"), F.lit(0)) + 1)
    ranked = materialise(ranked)
    totals = ranked.groupBy("run_id").agg(
        F.max(F.col("_pos") + F.col("weight") - 1).alias("epochs"), F.min(F.when(~finite, F.col("_pos"))).alias("_broken")
    )
    records = ranked.filter(finite & (F.col("_top").isNull() | (F.col("value") > F.col("_top"))))
    unsure = F.col("_top").isNotNull() & (F.col("value") - min_delta <= F.col("_top"))
    if records.filter(unsure).isEmpty():
        improved = records.select("run_id", "epoch", "value", "_pos")
    else:
        improved = materialise(_small_gains(records, min_delta))
    linked = previous_in_group(
        improved, ["run_id"], ["epoch"], bucket, {"_previous": "_pos"}
    )
    gap_stop = F.when(
        F.col("_pos") - F.col("_previous") - 1 >= patience, F.col("_previous") + patience
    )
    stops = (
        totals.join(
            linked.groupBy("run_id").agg(F.min(gap_stop).alias("_gap"), F.max("_pos").alias("_last")),
            "run_id",
            "left",
        )
        .withColumn(
            "_stop",
            F.least(
                "_broken",
                "_gap",
                F.when(F.col("epochs") - F.col("_last") >= patience, F.col("_last") + patience),
            ),
        )
        .select("run_id", "epochs", "_broken", "_stop")
    )
    stops = materialise(stops)
    at_stop = ranked.join(
        stops.filter(F.col("_stop").isNotNull()).select("run_id", F.col("_stop").alias("_pos")),
        ["run_id", "_pos"],
    ).select("run_id", F.col("epoch").cast("long").alias("stop_epoch"))
    best = (
        improved.join(small_side(stops), "run_id")
        .filter(F.col("_stop").isNull() | (F.col("_pos") <= F.col("_stop")))
        .groupBy("run_id")
        .agg(
            F.max("value").alias("best_value"),
            F.max("epoch").cast("long").alias("best_epoch"),
            F.max("_pos").alias("_best_pos"),
        )
    )
    end = F.coalesce(F.col("_stop"), F.col("epochs"))
    # The value that broke a run off counts neither as improvement nor as miss.
    counted = F.when(F.col("_stop") == F.col("_broken"), end - 1).otherwise(end)
    return (
        stops.join(at_stop, "run_id", "left")
        .join(best, "run_id", "left")
        .select(
            "run_id",
            "stop_epoch",
            "best_epoch",
            "best_value",
            F.coalesce(counted - F.col("_best_pos"), F.lit(0)).alias("misses"),
            "epochs",
        )
    )


def summarise(values: np.ndarray, top: float, min_delta: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising records of one bucket as a step function (limits, exits): from a best b before the
    bucket, the best after it is the exit of the first limit above b, or b beyond all of them.

    From any improvement the next one is the first record that exceeds it by more than
    ``min_delta``, so each record has one exit. The best before lies at most at ``top``, the
    highest value before; steps above it cannot be entered and are left out. Step functions
    compose to step functions, in any grouping of the buckets.
    """
    low = values - min_delta
    following = np.searchsorted(low, values, "right")
    exits = np.empty(len(values))
    for i in range(len(values) - 1, -1, -1):
        exits[i] = values[i] if following[i] == len(values) else exits[following[i]]
    reach = int(np.searchsorted(low, top, "right")) + 1
    last = np.append(np.flatnonzero(np.diff(exits)), len(exits) - 1)
    keep = last[: int(np.searchsorted(last, reach - 1)) + 1]
    return low[keep], exits[keep]


def leave(limits: np.ndarray, exits: np.ndarray, best: float) -> float:
    """The best after a bucket, from the best before it."""
    at = int(np.searchsorted(limits, best, "right"))
    return float(exits[at]) if at < len(exits) else best


def improvements(values: np.ndarray, best: float, min_delta: float) -> np.ndarray:
    """Places of the improvements among rising records, from the best before them."""
    low = values - min_delta
    places = []
    at = int(np.searchsorted(low, best, "right"))
    while at < len(values):
        places.append(at)
        at = int(np.searchsorted(low, values[at], "right"))
    return np.array(places, np.int64)


def _small_gains(records: DataFrame, min_delta: float) -> DataFrame:
    """Improvements among records. One row per run and epoch bucket, a short step function, is
    read in order, streaming, with one number held; rows of a run meet only in their bucket."""
    keys = ["run_id", "_bucket"]
    bucketed = materialise(
        records.select("run_id", "epoch", "value", "_pos", "_top", integer_bucket(F.col("epoch").cast("long")).alias("_bucket"))
    )

    def sum_up(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        top = table.column("_top")[0].as_py()
        limits, exits = summarise(table.column("value").to_numpy(), -np.inf if top is None else top, min_delta)
        return pa.table({**{k: table.column(k).slice(0, 1) for k in keys}, "limits": [limits], "exits": [exits]})

    types = {c: t for c, t in bucketed.dtypes}
    named = ", ".join(f"{k} {types[k]}" for k in keys)
    functions = bucketed.groupBy(*keys).applyInArrow(sum_up, f"{named}, limits array<double>, exits array<double>")

    def scan(batches):
        run, best = None, -np.inf
        for batch in batches:
            entries = []
            for name, limits, exits in zip(batch["run_id"], batch["limits"], batch["exits"]):
                if name != run:
                    run, best = name, -np.inf
                entries.append(best)
                best = leave(np.asarray(limits), np.asarray(exits), best)
            yield batch[keys].assign(_entry=entries)

    entries = functions.repartition("run_id").sortWithinPartitions(*keys).mapInPandas(scan, f"{named}, _entry double")

    def pick(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        found = improvements(table.column("value").to_numpy(), table.column("_entry")[0].as_py(), min_delta)
        return table.take(found).select(["run_id", "epoch", "value", "_pos"])

    return bucketed.drop("_top").join(entries, keys).groupBy(*keys).applyInArrow(pick, records.select("run_id", "epoch", "value", "_pos").schema)


def epoch_progress(timed: DataFrame, total_epochs: int) -> DataFrame:
    """Percent, bar, elapsed time, remaining time and last epoch's seconds for
    ``(run_id, epoch, ts)``."""
    starts = timed.groupBy("run_id").agg(F.min_by("ts", "epoch").alias("_start"))
    looked = previous_in_group(
        timed.select("run_id", "epoch", "ts"),
        ["run_id"],
        ["epoch"],
        integer_bucket(F.col("epoch")),
        {"_before": "ts"},
    )

    def seconds(later: str, earlier: str) -> Column:
        return (F.unix_micros(later) - F.unix_micros(earlier)) / 1e6

    epoch = F.col("epoch")
    percent = epoch / total_epochs * 100
    elapsed = seconds("ts", "_start")
    eta = F.when(epoch > 0, F.try_divide(elapsed, epoch.cast("double")) * (total_epochs - epoch))
    return looked.join(small_side(starts), "run_id").select(
        "run_id",
        "epoch",
        percent.alias("percent"),
        bar(percent / 5, 20).alias("bar"),
        elapsed.alias("elapsed"),
        duration_text(elapsed).alias("elapsed_text"),
        eta.alias("eta"),
        seconds("ts", "_before").alias("epoch_seconds"),
    )


def validation_cadence(epochs: DataFrame) -> DataFrame:
    """Epochs with a validation run, its number, and whether samples are drawn."""
    epoch = F.col("epoch")
    return epochs.filter(schedules.is_validated(epoch)).withColumns(
        {
            "validation_run": schedules.validation_run(epoch),
            "sampled": schedules.is_sampled(epoch),
        }
    )


def progress_flags(metrics: DataFrame) -> DataFrame:
    """Latest value of the tracked series per run, with the status words."""
    names = ["train_loss", "val_loss", "train_acc", "val_acc", "train_f1_score", "val_f1_score"]
    latest = (
        metrics.withColumn("_series", F.concat_ws("_", "phase", "name"))
        .groupBy("run_id")
        .pivot("_series", names)
        .agg(F.max_by("value", "epoch"))
        .na.fill(0.0, names)
    )
    return latest.select(
        "run_id",
        *names,
        bands.loss_flag(F.col("train_loss"), F.col("val_loss")).alias("loss_flag"),
        bands.accuracy_flag(F.col("val_acc")).alias("acc_flag"),
        bands.f1_flag(F.col("val_f1_score")).alias("f1_flag"),
    )


def event_line(kind: Column, **fields: Column) -> Column:
    """``KIND: key=value, key=value``."""
    pairs = [F.concat(F.lit(f"{name}="), value.cast("string")) for name, value in fields.items()]
    return F.concat(kind, F.lit(": "), F.concat_ws(", ", *pairs))


def parse_run_events(lines: DataFrame, line: str = "line") -> DataFrame:
    """Kind and fields of event lines; lines of another form are left out. A field begins at
    ``name=`` after the kind or a comma, so a value may hold commas itself; an epoch that is no
    number is null."""
    kind = F.regexp_extract(line, r"^([A-Z_]+): ", 1)
    parsed = lines.withColumn("kind", kind).filter(F.col("kind") != "")
    pairs = F.split(F.expr(f"substring({line}, length(kind) + 3)"), r", (?=[A-Za-z_]\w*=)")
    named = F.filter(F.transform(pairs, lambda p: F.split(p, "=", 2)), lambda p: F.size(p) == 2)
    # Of a name that occurs twice the last value counts.
    last = F.filter(named, lambda p, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda q: q[0] == p[0]))
    fields = F.map_from_entries(F.transform(last, lambda p: F.struct(p[0], p[1])))
    return parsed.withColumn("fields", fields).withColumns(
        {
            "epoch": F.coalesce(F.col("fields")["epoch"], F.col("fields")["final_epoch"]).try_cast("int"),
            "time": F.col("fields")["time"].try_cast("timestamp"),
        }
    )


def run_registry(candidates: DataFrame) -> DataFrame:
    """Run info per dataset: the lowest priority number (dataset location before working
    location), the newest within it; evaluation tags are appended. Rows combine before the
    shuffle, so a dataset with very many entries is no hot group."""
    info = F.struct("run_id", "project", "name", "tags")
    best = candidates.groupBy("dataset").agg(
        F.min_by(info, F.struct("priority", -F.unix_micros("ts"), "run_id")).alias("_i")
    )
    added = F.array(*[F.lit(t) for t in ("testing", "evaluation", "confusion_matrix")])
    tags = F.concat(F.coalesce("_i.tags", F.array().cast("array<string>")), added)
    return best.select("dataset", "_i.run_id", "_i.project", "_i.name", tags.alias("tags"))
