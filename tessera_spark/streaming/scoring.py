"""Score embeddings as they arrive. Stateless: no shuffle, no watermark."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tessera_spark.operators.embeddings import transform_embeddings
from tessera_spark.operators.mlp import Network, predict


def score_stream(
    vectors: DataFrame, network: Network, steps: PipelineModel | None = None
) -> DataFrame:
    """Fitted steps, then prediction, on a streaming (or batch) frame with ``embedding``."""
    if steps is None or not steps.stages:
        return predict(vectors, network)
    ready = transform_embeddings(vectors, steps, "features")
    return predict(ready, network, "features").drop("features")
