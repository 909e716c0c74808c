"""Principal components by a random range: no d x d matrix anywhere.

Vectors of a random subspace of k + 8 directions are multiplied by X'X and made orthonormal again, at
least ``rounds`` times and until the components satisfy their eigen equation; X'(X W) is one pass over
the rows with sums per task. The last pass takes the QR factor of X W by tall-skinny QR: each task one
factor per batch of rows, factors stacked and factored again over as many levels as needed. Its singular
values are the deviations of the components. The driver holds d x (k + 8) numbers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.common import _py2java
from pyspark.ml.feature import PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.session import materialise

OVERSAMPLE = 8
ROUNDS = 2
MOST_ROUNDS = 100
TOLERANCE = 1e-9
FACTORS_PER_GROUP = 64


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(0)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _times(rows: DataFrame, basis: np.ndarray) -> tuple[np.ndarray, float]:
    """X'(X W) and the sum of all squares, from rows of one array column."""
    told = rows.sparkSession.sparkContext.broadcast(basis)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = told.value
        total, squares = np.zeros_like(w), 0.0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                total += x.T @ (x @ w)
                squares += float((x * x).sum())
        lines = [*total, np.append(squares, np.zeros(w.shape[1] - 1))]
        yield pa.RecordBatch.from_pydict({"line": np.arange(len(lines)), "v": [r.tolist() for r in lines]})

    parts = rows.mapInArrow(sums, "line long, v array<double>")
    added = parts.groupBy("line").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).orderBy("line").toArrow()
    lines = np.array(added.column("v").to_pylist())
    told.destroy()
    return lines[:-1], float(lines[-1, 0])


def _upper(stack: np.ndarray) -> np.ndarray:
    return np.linalg.qr(stack, mode="r")


def tall_factor(rows: DataFrame, basis: np.ndarray, group: int = FACTORS_PER_GROUP) -> np.ndarray:
    """R of the QR factors of X W."""
    width = basis.shape[1]
    told = rows.sparkSession.sparkContext.broadcast(basis)

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            if batch.num_rows:
                r = _upper(np.vstack([r, _matrix(batch) @ told.value]))
        if len(r):
            yield pa.RecordBatch.from_pydict({"part": [0], "r": [r.tobytes()]})

    def merge(table: pa.Table) -> pa.Table:
        stack = [np.frombuffer(b).reshape(-1, width) for b in table.column("r").to_pylist()]
        return pa.table({"part": table.column("part").slice(0, 1), "r": [_upper(np.vstack(stack)).tobytes()]})

    parts = rows.mapInArrow(factor, "part long, r binary").withColumn("part", F.spark_partition_id().cast("long"))
    while True:
        parts = materialise(parts)
        if parts.count() <= group:
            break
        parts = parts.withColumn("part", F.floor(F.col("part") / group)).groupBy("part").applyInArrow(merge, "part long, r binary")
    told.destroy()
    stack = [np.frombuffer(r["r"]).reshape(-1, width) for r in parts.collect()]  # at most ``group`` small factors
    return _upper(np.vstack(stack))


def components(rows: DataFrame, size: int, k: int, rounds: int = ROUNDS, tolerance: float = TOLERANCE, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(d x k components, shares of the variance) of centred rows, one array column without nulls."""
    width = min(size, k + OVERSAMPLE)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))[0]
    for turn in range(MOST_ROUNDS):
        image, squares = _times(rows, basis)
        values, turned = np.linalg.eigh(basis.T @ image)
        turned = turned[:, ::-1][:, :k]
        rest = image @ turned - basis @ turned * values[::-1][:k]
        if turn >= rounds and np.abs(rest).max() <= tolerance * max(values[-1], 1e-300):
            break
        basis = np.linalg.qr(image)[0]
    upper = tall_factor(rows, basis)
    _, deviations, turned = np.linalg.svd(upper)
    return basis @ turned.T[:, :k], (np.pad(deviations, (0, width - len(deviations))) ** 2 / (squares or 1.0))[:k]


def fit(rows: DataFrame, column: str, size: int, k: int, **options) -> PCAModel:
    """As MLlib's own estimator: a stage from ``_vector`` to ``_components``. ``column`` is an array."""
    found, shares = components(rows.select(column), size, k, **options)
    context = rows.sparkSession.sparkContext
    parts = (DenseMatrix(size, k, found.T.ravel()), DenseVector(shares))
    made = context._jvm.org.apache.spark.ml.feature.PCAModel(f"PCA_{uuid.uuid4().hex[:12]}", *(_py2java(context, p) for p in parts))
    model = PCAModel(made)
    model._set(k=k)
    return model.setInputCol("_vector").setOutputCol("_components")
