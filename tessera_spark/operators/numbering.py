"""Row numbers without a single-task window.

A window over one huge group runs in one task. Here every group is cut into buckets that are
monotone in its order: rows are numbered inside a bucket, the bucket counts (combined before
the shuffle) give each bucket its offset, and the offset is joined back. A group holding a
third of all rows is therefore spread over many tasks like any other.

Two ways to cut:

* ``rank_in_group`` for orders with a computable bucket: integer keys (fixed spans) and md5
  order (leading hex digits, uniform by construction). Lazy, one shuffle of the rows.
* ``number_by_range`` for any other order, such as paths: Spark's range partitioning of the
  sorted rows, fixed by a checkpoint so that both passes see the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera_spark.functions.permutation import permuted
from tessera_spark.session import materialise, small_side

# Rows of one bucket are sorted by one task.
INTEGER_SPAN = 1 << 18
HASH_DIGITS = 4
DEFAULT_BATCH = 256
_ROW_BITS = (1 << 33) - 1


def order_hash(seed: int | str, *keys: Column) -> Column:
    """md5 of ``seed:key[:key...]``; a reproducible shuffle independent of partitioning."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def hash_bucket(digest: Column, digits: int = HASH_DIGITS) -> Column:
    return F.left(digest, F.lit(digits))


def integer_bucket(key: Column, span: int = INTEGER_SPAN) -> Column:
    return F.floor(key / span)


def _before(fn: str, column: Column | str, window) -> Column:
    return getattr(F, fn)(column).over(window.rowsBetween(W.unboundedPreceding, -1))


def prefix_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    bucket: Column,
    measures: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Add running ``sum`` or ``max`` over the rows before the current one, per group; null in
    the first row. ``bucket`` must be monotone in ``order``; group columns must not be null.
    The result is lazy."""
    group = list(group)
    sources = {f"_in_{out}": column for out, (_, column) in measures.items()}
    tagged = df.withColumn("_bucket", bucket).withColumns(sources)
    totals = tagged.groupBy(*group, "_bucket").agg(
        *[getattr(F, fn)(f"_in_{out}").alias(f"_all_{out}") for out, (fn, _) in measures.items()]
    )
    across = W.partitionBy(*group).orderBy("_bucket")
    carried = totals.select(
        *group,
        "_bucket",
        *[_before(fn, f"_all_{out}", across).alias(f"_carry_{out}") for out, (fn, _) in measures.items()],
    )
    inside = W.partitionBy(*group, "_bucket").orderBy(*order)
    local = tagged.select(
        *df.columns,
        "_bucket",
        *[_before(fn, f"_in_{out}", inside).alias(f"_local_{out}") for out, (fn, _) in measures.items()],
    )

    def merge(out: str, fn: str) -> Column:
        here, carry = F.col(f"_local_{out}"), F.col(f"_carry_{out}")
        both = F.greatest(here, carry) if fn == "max" else here + carry
        return F.coalesce(both, here, carry).alias(out)

    return local.join(carried, [*group, "_bucket"]).select(
        *df.columns, *[merge(out, fn) for out, (fn, _) in measures.items()]
    )


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    bucket: Column,
    out: str = "position",
) -> DataFrame:
    """Add the 0-based position of each row in its group."""
    ranked = prefix_in_group(df, group, order, bucket, {out: ("sum", F.lit(1))})
    return ranked.withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("long"))


def previous_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    values: dict[str, str],
) -> DataFrame:
    """Add, for each ``out: column`` of ``values``, the column's value in the preceding row of
    the group; null in the first row. Rows look back inside their bucket, and the last row of
    each bucket is handed to the next one, so no group is scanned by a single task. Group
    columns must not be null."""
    group = list(group)
    inside = W.partitionBy(*group, "_bucket").orderBy(*order)
    # Stated here, so that Spark need not infer it on one side only: both sides of the join
    # below then have the same shuffle, which is run once.
    tagged = df.withColumn("_bucket", bucket)
    for column in (*group, "_bucket"):
        tagged = tagged.filter(F.col(column).isNotNull())
    looked = tagged.select(
        "*",
        *[F.lag(source).over(inside).alias(out) for out, source in values.items()],
        (F.row_number().over(inside) == 1).alias("_first"),
        F.lead(F.lit(True), 1, False).over(inside).alias("_more"),
    )
    across = W.partitionBy(*group).orderBy("_bucket")
    handed = looked.filter(~F.col("_more")).select(
        *group,
        "_bucket",
        *[F.lag(source).over(across).alias(f"_carry_{out}") for out, source in values.items()],
    )
    # Every bucket has a last row, so the inner join keeps all rows.
    joined = looked.join(handed, [*group, "_bucket"])
    return joined.select(
        *df.columns,
        *[
            F.when(F.col("_first"), F.col(f"_carry_{out}")).otherwise(F.col(out)).alias(out)
            for out in values
        ],
    )


def number_by_range(
    df: DataFrame,
    order: Sequence[str],
    group: Sequence[str] = (),
    position: str = "position",
    index: str | None = None,
) -> DataFrame:
    """Add the 0-based ``position`` over all rows and, if asked, the 0-based ``index`` in the
    row's group. ``order`` must start with the group columns and be unique over the rows."""
    group = list(group)
    if list(order[: len(group)]) != group:
        raise ValueError("the order must start with the group columns")
    fixed = materialise(df.repartitionByRange(*order).sortWithinPartitions(*order))
    tagged = fixed.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_row"),
    )
    runs = tagged.groupBy("_part", *group).agg(
        F.min("_row").alias("_start"), F.count(F.lit(1)).alias("_n")
    )
    # One row per partition and group: the groups of a partition are runs of its sorted rows.
    sizes = runs.groupBy("_part").agg(F.sum("_n").alias("_n"))
    parts = sizes.select(
        "_part",
        F.coalesce(_before("sum", "_n", W.partitionBy().orderBy("_part")), F.lit(0)).alias("_part_offset"),
    )
    offsets = runs.join(parts, "_part")
    if group:
        earlier = _before("sum", "_n", W.partitionBy(*group).orderBy("_part"))
        offsets = offsets.withColumn("_group_offset", F.coalesce(earlier, F.lit(0)))
    else:
        offsets = offsets.withColumn("_group_offset", F.col("_part_offset"))
    offsets = small_side(offsets.drop("_n"))
    numbered = tagged.join(offsets, ["_part", *group]).withColumn(
        position, F.col("_row") + F.col("_part_offset")
    )
    if index is not None:
        numbered = numbered.withColumn(
            index, F.col("_row") - F.col("_start") + F.col("_group_offset")
        )
    return numbered.drop("_part", "_row", "_start", "_part_offset", "_group_offset")


def assign_batches(
    df: DataFrame,
    key: str,
    batch_rows: int = DEFAULT_BATCH,
    shuffle: bool = True,
    seed: int = 42,
    epoch: int = 0,
    out: str = "batch",
) -> DataFrame:
    """Batch number of every row: md5 order that changes with the epoch, or key order. The
    last batch may be short."""
    if shuffle:
        hashed = df.withColumn("_digest", order_hash(f"{seed}:{epoch}", F.col(key)))
        order, bucket = [F.col("_digest"), F.col(key)], hash_bucket(F.col("_digest"))
    else:
        hashed = df.withColumn("_digest", F.lit(None).cast("string"))
        order, bucket = [F.col(key)], integer_bucket(F.col(key))
    ranked = rank_in_group(hashed, [], order, bucket, "_rank")
    return ranked.withColumn(out, F.floor(F.col("_rank") / batch_rows)).drop("_digest", "_rank")


def permuted_batches(
    df: DataFrame,
    index: str,
    rows: int,
    batch_rows: int = DEFAULT_BATCH,
    seed: int = 42,
    epoch: int = 0,
    out: str = "batch",
) -> DataFrame:
    """Batch number of every row in an order that changes with the epoch, for rows whose ``index``
    is dense from 0 to ``rows`` - 1. The place is computed from the index, so no row is moved."""
    return df.withColumn(out, F.floor(permuted(F.col(index), rows, f"{seed}:{epoch}") / batch_rows))
