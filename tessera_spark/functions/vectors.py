"""Row-wise vector expressions on ``array`` columns (double precision)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the network: negative slope and batch-norm epsilon.
LEAKY_SLOPE = 0.02
BATCH_NORM_EPS = 1e-5


def literal_array(values: Sequence[float]) -> Column:
    """A model-sized constant; Catalyst folds it into one array literal."""
    return F.array(*[F.lit(float(v)) for v in values])


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once. Inside a lambda, an expression on the row
    would be evaluated again for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def vector_sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return vector_sum(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def _weights(logits: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over exp(logit - largest logit)."""
    return let(
        F.struct(doubles(logits).alias("x"), F.array_max(doubles(logits)).alias("top")),
        lambda s: let(F.transform(s["x"], lambda v: F.exp(v - s["top"])), body),
    )


def softmax(logits: Column) -> Column:
    return _weights(
        logits, lambda w: let(vector_sum(w), lambda total: F.transform(w, lambda v: v / total))
    )


def confidence(logits: Column) -> Column:
    """Largest softmax probability; the largest weight is exp(0)."""
    return _weights(logits, lambda w: 1.0 / vector_sum(w))


def probability_of(logits: Column, class_id: Column) -> Column:
    return _weights(logits, lambda w: F.get(w, class_id) / vector_sum(w))


def argmax(vector: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def row_cross_entropy(logits: Column, class_id: Column) -> Column:
    logits = doubles(logits)
    return (
        F.log(_weights(logits, vector_sum)) + F.array_max(logits) - F.get(logits, class_id)
    )


def linear(vector: Column, weights: Sequence[Sequence[float]], bias: Sequence[float]) -> Column:
    """Small linear layer as an expression; larger layers belong in ``operators.mlp``."""
    return F.array(*[dot(vector, literal_array(row)) + F.lit(float(b)) for row, b in zip(weights, bias)])


def batch_norm(
    vector: Column,
    mean: Sequence[float],
    variance: Sequence[float],
    gamma: Sequence[float],
    beta: Sequence[float],
) -> Column:
    """Batch normalisation with stored statistics, as used outside training."""
    slope = literal_array([g / (v + BATCH_NORM_EPS) ** 0.5 for g, v in zip(gamma, variance)])
    centre, shift = literal_array(mean), literal_array(beta)
    return F.transform(
        doubles(vector), lambda x, i: (x - F.get(centre, i)) * F.get(slope, i) + F.get(shift, i)
    )


def leaky_relu(vector: Column, slope: float = LEAKY_SLOPE) -> Column:
    return F.transform(vector, lambda v: F.when(v < 0, v * slope).otherwise(v))


def standardise(vector: Column, mean: Sequence[float], scale: Sequence[float]) -> Column:
    centre, width = literal_array(mean), literal_array(scale)
    return F.transform(doubles(vector), lambda x, i: (x - F.get(centre, i)) / F.get(width, i))


def project(vector: Column, mean: Sequence[float], components: Sequence[Sequence[float]]) -> Column:
    """Centre and project onto a few component rows."""
    centred = F.transform(doubles(vector), lambda x, i: x - F.get(literal_array(mean), i))
    return F.array(*[dot(centred, literal_array(row)) for row in components])
