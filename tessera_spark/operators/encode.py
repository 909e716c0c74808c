"""Images to vectors with a pluggable encoder."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera_spark.operators.images import pixels, to_rgb
from tessera_spark.session import spread_rows

# Model names served by the hub source, and the two sources.
HUB_MODELS = ("ViT-SO400M-14-SigLIP-384", "ViT-B-16-SigLIP-512", "ViT-L-14-SigLIP-384")
HUB_SOURCE = "hf-hub:timm"
PLAIN_PRETRAINED = "openai"

Encoder = Callable[[list[np.ndarray]], np.ndarray]

_RESULT = T.StructType(
    [T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())]
)


def model_source(name: Column) -> dict[str, Column]:
    """The (source, variant) pair of a model name."""
    hub = name.isin(*HUB_MODELS)
    return {
        "hub": F.when(hub, HUB_SOURCE).otherwise(name),
        "name": F.when(hub, name).otherwise(PLAIN_PRETRAINED),
    }


def embed(images: DataFrame, make_encoder: Callable[[], Encoder], batch_size: int = 256) -> DataFrame:
    """Add ``embedding`` and ``error``. ``make_encoder`` runs once per Python worker and
    returns a function from a list of RGB arrays to one vector per image. When a batch fails,
    its images are tried one by one, so only those that fail themselves end up with a null
    vector and the message. An ``error`` that the images bring, for want of pixels, is kept."""

    def make_predict():
        encoder = make_encoder()

        def attempt(images):
            vectors = np.asarray(encoder(images), dtype=np.float32)
            if len(vectors) != len(images):
                raise ValueError("the encoder returned a different number of vectors")
            return list(vectors)

        def predict(height, width, channels, data):
            decoded, found = {}, {}
            errors = np.full(len(data), "", dtype=object)
            for i, shape in enumerate(zip(height, width, channels)):
                try:
                    decoded[i] = to_rgb(pixels(*[int(v) for v in shape], data[i]))
                except Exception as problem:
                    errors[i] = str(problem) or repr(problem)
            try:
                found = dict(zip(decoded, attempt(list(decoded.values())))) if decoded else {}
            except Exception:
                for i, image in decoded.items():
                    try:
                        found[i] = attempt([image])[0]
                    except Exception as problem:
                        errors[i] = str(problem) or repr(problem)
            width_out = len(next(iter(found.values()))) if found else 1
            vectors = np.full((len(data), width_out), np.nan, dtype=np.float32)
            for i, vector in found.items():
                vectors[i] = vector
            return {"embedding": vectors, "error": errors}

        return predict

    # Marked as not repeatable, so that a later filter on the result is not pushed below and
    # the encoder run a second time for it.
    run = predict_batch_udf(
        make_predict, return_type=_RESULT, batch_size=batch_size
    ).asNondeterministic()
    done = spread_rows(images, "image_path").withColumn(
        "_e", run(F.struct("height", "width", "nChannels", "data"))
    )
    error = F.nullif(F.col("_e.error"), F.lit(""))
    if "error" in images.columns:
        error = F.coalesce(F.col("error"), error)
    return done.select(
        *[c for c in images.columns if c not in ("height", "width", "nChannels", "data", "error")],
        F.when(F.col("_e.error") == "", F.col("_e.embedding")).alias("embedding"),
        error.alias("error"),
    )


def failed_rows(embedded: DataFrame) -> DataFrame:
    return embedded.filter(F.col("error").isNotNull())
