"""Scoring with a multilayer perceptron stored as a layer table.

Weights are model-sized: they are read once, checked, broadcast, and applied to whole Arrow
batches with one matrix product per layer. Rows stay where they are; nothing is shuffled. The
UDFs are marked as not repeatable: a later filter on their result would otherwise be pushed
below and score every row a second time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera_spark.functions.vectors import BATCH_NORM_EPS, LEAKY_SLOPE
from tessera_spark.operators.embeddings import vector_means
from tessera_spark.schemas import LAYERS, SCORED

# Broadcast bound of a network in bytes of its parameters, half of Spark's default limit for
# results on the driver.
MAX_NETWORK_BYTES = 512 << 20
_NORM = ("bn_mean", "bn_var", "bn_gamma", "bn_beta")


@dataclass
class Layer:
    """Linear layer with optional batch-norm; a normalised layer ends in a leaky ReLU."""

    weight: np.ndarray
    bias: np.ndarray
    norm: dict[str, np.ndarray] | None = None


Network = list[Layer]


def check_size(parameters: int) -> None:
    """A network is broadcast and passes through the driver, so its size is bounded."""
    if 8 * parameters > MAX_NETWORK_BYTES:
        raise ValueError(f"{parameters} parameters exceed the bound of {MAX_NETWORK_BYTES} bytes")


def layers_frame(spark: SparkSession, network: Network) -> DataFrame:
    """Layer table of a network."""
    arrays = []
    for i, layer in enumerate(network):
        arrays += [(i, "weight", layer.weight), (i, "bias", layer.bias)]
        arrays += [(i, kind, values) for kind, values in (layer.norm or {}).items()]
    table = pa.table(
        {
            "layer": pa.array([i for i, _, _ in arrays], pa.int32()),
            "kind": pa.array([kind for _, kind, _ in arrays], pa.string()),
            "rows": pa.array([a.shape[0] for _, _, a in arrays], pa.int32()),
            "cols": pa.array([a.shape[1] if a.ndim == 2 else 1 for _, _, a in arrays], pa.int32()),
            "values": pa.array([a.astype(float).ravel() for _, _, a in arrays], pa.list_(pa.float64())),
        }
    )
    return spark.createDataFrame(table, LAYERS)


def network_from(layers: DataFrame) -> Network:
    """Network of a layer table. The parameter count is checked before anything is fetched."""
    count = layers.agg(F.sum(F.col("rows").cast("long") * F.col("cols"))).first()[0]
    if count is None:
        raise ValueError("the layer table is empty")
    check_size(count)
    table = layers.toArrow()
    parts: dict[int, dict[str, np.ndarray]] = {}
    for i in range(table.num_rows):
        layer, kind, rows, cols = (table.column(c)[i].as_py() for c in ("layer", "kind", "rows", "cols"))
        values = table.column("values")[i].values.to_numpy()
        parts.setdefault(layer, {})[kind] = values.reshape(rows, cols) if kind == "weight" else values
    network = []
    for i in sorted(parts):
        found = parts[i]
        norm = {k: found[k] for k in _NORM} if "bn_mean" in found else None
        network.append(Layer(found["weight"], found["bias"], norm))
    return network


def forward(x: np.ndarray, network: Network) -> np.ndarray:
    """Logits of a batch, with stored statistics and dropout off."""
    for layer in network:
        x = x @ layer.weight.T + layer.bias
        if layer.norm is not None:
            n = layer.norm
            x = (x - n["bn_mean"]) / np.sqrt(n["bn_var"] + BATCH_NORM_EPS) * n["bn_gamma"] + n["bn_beta"]
            x = np.where(x < 0, x * LEAKY_SLOPE, x)
    return x


def batch_matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """Dense matrix of the non-null vectors of a list column."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    rows = len(column) - column.null_count
    return values.reshape(rows, -1) if rows else values.reshape(0, 0)


def spread(values: pa.Array, column: pa.Array) -> pa.Array:
    """Results of the non-null rows, back in the places of ``column``."""
    if column.null_count == 0:
        return values
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    places = pa.array(np.cumsum(valid) - 1, mask=~valid)
    return values.take(places)


def list_array(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int64) * width, type=pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


def logits_column(spark: SparkSession, network: Network, vector: Column) -> Column:
    shared = spark.sparkContext.broadcast(network)

    @F.arrow_udf("array<double>")
    def logits(column: pa.Array) -> pa.Array:
        x = batch_matrix(column)
        if not len(x):
            return pa.nulls(len(column), pa.list_(pa.float64()))
        return spread(list_array(forward(x, shared.value)), column)

    return logits.asNondeterministic()(vector)


def mlp_forward(df: DataFrame, network: Network, vector: str = "embedding", output: str = "logits") -> DataFrame:
    return df.withColumn(output, logits_column(df.sparkSession, network, F.col(vector)))


def predict(df: DataFrame, network: Network, vector: str = "embedding") -> DataFrame:
    """Add ``predicted_class`` (first maximum) and ``confidence_score`` (its softmax
    probability, double). The logits stay inside the Python worker, so two numbers per row
    come back."""
    shared = df.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("predicted_class int, confidence_score double")
    def score(column: pa.Array) -> pa.Array:
        x = batch_matrix(column)
        fields = [pa.field("predicted_class", pa.int32()), pa.field("confidence_score", pa.float64())]
        if not len(x):
            return pa.nulls(len(column), pa.struct(fields))
        logits = forward(x, shared.value)
        best = logits.argmax(axis=1)
        total = np.exp(logits - logits.max(axis=1, keepdims=True)).sum(axis=1)
        scored = pa.StructArray.from_arrays(
            [pa.array(best.astype(np.int32)), pa.array(1.0 / total)], fields=fields
        )
        return spread(scored, column)

    scored = df.withColumn("_score", score.asNondeterministic()(F.col(vector)))
    return scored.select(*df.columns, "_score.predicted_class", "_score.confidence_score")


def as_scored(df: DataFrame) -> DataFrame:
    """Columns and types of the scored table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCORED.fields])


def centroid_network(df: DataFrame, vector: str = "embedding") -> Network:
    """One linear layer whose weight rows are the class means of ``df``; classes must be
    0..k-1 and each must have rows. Whole vectors are combined per class before the shuffle;
    the size is checked by class count and dimension before the means are fetched."""
    shape = df.filter(F.col(vector).isNotNull()).agg(F.max("label_id"), F.max(F.size(vector))).first()
    if shape[0] is None:
        raise ValueError("no labelled rows to take class means of")
    check_size((shape[0] + 1) * shape[1])
    means = vector_means(df, vector, "label_id").select("label_id", "mean").toArrow()
    weight = np.zeros((shape[0] + 1, shape[1]))
    weight[means.column("label_id").to_numpy()] = np.array(means.column("mean").to_pylist())
    return [Layer(weight, np.zeros(len(weight)))]
