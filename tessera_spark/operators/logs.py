"""Log-line filter: keep what matters, drop noise and immediate repeats."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera_spark.functions.text import strip
from tessera_spark.functions.vectors import let
from tessera_spark.operators.numbering import integer_bucket, previous_in_group

# A line with one of the first patterns is always kept, else one of the second
# drops it.
KEEP_PATTERNS = (
    ">> validation epoch end:",
    ">> triggering validation",
    ">> successfully completed validation",
    ">> failed validation",
    "validation_viz_stats:",
    ">> setup validation visualization",
)
NOISE_PATTERNS = (
    "epoch",
    "batch",
    "loss:",
    "accuracy:",
    "learning rate",
    "val_loss",
    "val_acc",
    "step",
    "/",
    "%",
)


def _contains_any(text: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in patterns])


def is_shown(stripped: Column) -> Column:
    """Whether a stripped line passes. The lowered text is bound once: as a plain expression a
    filter would lower the line again for every pattern."""
    passes = let(
        F.lower(stripped),
        lambda low: ~_contains_any(low, NOISE_PATTERNS) | _contains_any(low, KEEP_PATTERNS),
    )
    return (stripped != "") & passes


def filter_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Stripped lines that pass the patterns."""
    return lines.withColumn(line, strip(F.col(line))).filter(is_shown(F.col(line)))


def drop_repeats(kept: DataFrame, source: str, order: Sequence[str], span: int = 4096) -> DataFrame:
    """Drop a kept line equal to the kept line before it in its source. The first order
    column is an integer; a source is looked through in buckets of ``span`` of its values."""
    looked = previous_in_group(
        kept, [source], list(order), integer_bucket(F.col(order[0]), span), {"_previous": "line"}
    )
    repeated = F.col("_previous").eqNullSafe(F.col("line"))
    return looked.filter(~repeated).drop("_previous")


def log_filter(lines: DataFrame, source: str, order: Sequence[str]) -> DataFrame:
    return drop_repeats(filter_lines(lines), source, order)
