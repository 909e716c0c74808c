"""Image tables: resize to one size, and seeded variants. Pixels are rows of
``image_path, height, width, nChannels, data`` in the channel order of Spark's image source
(blue, green, red[, alpha]).

What is done to a single image is the user's: a resize function and a list of transforms are handed
in, as an encoder is (``operators.encode``). This module deals images over the cluster, bounds the
portions and makes the draws reproducible."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera_spark.schemas import IMAGE_PIXELS
from tessera_spark.session import spread_rows

# Size of normalised images.
WIDTH = HEIGHT = 224

#: An image and the wanted height and width to the resized image.
Resize = Callable[[np.ndarray, int, int], np.ndarray]
#: An image and a seeded generator to the changed image.
Transform = Callable[[np.ndarray, np.random.Generator], np.ndarray]

_VARIANTS = T.StructType(
    [IMAGE_PIXELS["image_path"], T.StructField("aug_version", T.IntegerType()), *IMAGE_PIXELS.fields[1:]]
)
_VARIANT_COLUMNS = _VARIANTS.fieldNames()


def pixels(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)


def nearest(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """The pixel at the same relative place."""
    rows = np.arange(height) * image.shape[0] // height
    cols = np.arange(width) * image.shape[1] // width
    return image[rows[:, None], cols]


# Pixels are handed back in portions of about this size, however many images a batch brings
# and however many variants are made of each.
FLUSH_BYTES = 32 << 20

Variants = Callable[[np.ndarray, str], Iterator[tuple[int, np.ndarray]]]


def _each_image(df: DataFrame, variants: Variants) -> DataFrame:
    """``image_path, aug_version`` and pixels of the variants of every image that has pixels. An
    image crosses to Python once, in Arrow batches bounded by
    ``spark.sql.execution.arrow.maxBytesPerBatch``."""
    source = spread_rows(df.filter(F.col("data").isNotNull()).select(*IMAGE_PIXELS.fieldNames()), "image_path")

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                image = pixels(r.height, r.width, r.nChannels, r.data)
                for version, out in variants(image, r.image_path):
                    rows.append((r.image_path, version, *out.shape, out.tobytes()))
                    held += out.size
                    if held >= FLUSH_BYTES:
                        yield pd.DataFrame(rows, columns=_VARIANT_COLUMNS)
                        rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=_VARIANT_COLUMNS)

    return source.mapInPandas(run, _VARIANTS)


def normalize_images(images: DataFrame, width: int = WIDTH, height: int = HEIGHT, resize: Resize = nearest) -> DataFrame:
    """Resize to one size. Only pixels are kept, so metadata has nowhere to survive; the
    channel count stays."""

    def variants(image, path):
        yield 0, np.ascontiguousarray(resize(image, height, width), dtype=np.uint8)

    return _each_image(images, variants).drop("aug_version")


def to_rgb(image: np.ndarray) -> np.ndarray:
    """Three channels in red, green, blue order: gray is repeated, alpha dropped."""
    if image.shape[2] == 1:
        return np.repeat(image, 3, axis=2)
    return image[:, :, 2::-1]


def augment_images(
    images: DataFrame,
    copies: int,
    transforms: Sequence[tuple[float, Transform]],
    seed: int = 42,
) -> DataFrame:
    """Originals (``aug_version`` 0, untouched) and ``copies`` variants of every image, each made
    by the given transforms in order, with the given chances. The random draws depend on seed, path and version only; the copies are made where the image
    already is."""

    def variants(image, path):
        yield 0, image
        for version in range(1, copies + 1):
            rng = np.random.default_rng([seed, zlib.crc32(path.encode()), version])
            out = image
            for chance, transform in transforms:
                if rng.random() < chance:
                    out = transform(out, rng)
            yield version, np.ascontiguousarray(out)

    return _each_image(images, variants)
