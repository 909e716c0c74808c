"""Learning-rate and cadence expressions on an epoch column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Start and end of the cosine schedule, cadence of validation and of the
# validation samples.
LR_START, LR_END = 5e-5, 1e-6
VALIDATE_EVERY = 5
SAMPLE_EVERY_EPOCHS = 25
SAMPLE_EVERY_VALIDATIONS = 5


def cosine_lr(epoch: Column, total: Column | int, start: float = LR_START, end: float = LR_END) -> Column:
    return F.lit(end) + F.lit(start - end) * (1 + F.cos(F.pi() * epoch / total)) / 2


def warmup_factor(
    epoch: Column, warmup: int, total: int | None, base: float, peak: float
) -> Column:
    """Multiplier of the base rate: linear up to ``warmup``, then half a cosine down to zero
    at ``total``, or constant one when ``total`` is None."""
    rising = F.lit(peak / base) * (epoch / warmup)
    after = (
        F.lit(1.0)
        if total is None
        else 0.5 * (1 + F.cos(F.pi() * (epoch - warmup) / (total - warmup)))
    )
    return F.when(epoch < warmup, rising).otherwise(after)


def validation_run(epoch: Column) -> Column:
    return (F.floor(epoch / VALIDATE_EVERY) + 1).cast("int")


def is_validated(epoch: Column) -> Column:
    """Validation follows every fifth epoch, counted from 0: 4, 9, 14, ..."""
    return (epoch + 1) % VALIDATE_EVERY == 0


def is_sampled(epoch: Column) -> Column:
    return (epoch % SAMPLE_EVERY_EPOCHS == 0) | (
        validation_run(epoch) % SAMPLE_EVERY_VALIDATIONS == 0
    )
