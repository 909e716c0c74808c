"""Standardisation and principal components of the embedding column."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera_spark.functions import vectors as V
from tessera_spark.functions.paths import TEST_LABEL_ID
from tessera_spark.operators import random_range


def value_range(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Smallest and largest label, and smallest and largest vector element."""
    return df.agg(
        F.min("label_id").alias("min_label"),
        F.max("label_id").alias("max_label"),
        F.min(F.array_min(vector)).cast("double").alias("min_value"),
        F.max(F.array_max(vector)).cast("double").alias("max_value"),
    )


def vector_means(df: DataFrame, vector: str = "embedding", *group: str) -> DataFrame:
    """Mean, population deviation and number of the vectors that are not null, as arrays per
    group. Whole vectors are combined on each task, so cells never become rows."""
    known = df.filter(F.col(vector).isNotNull()).withColumn("_v", array_to_vector(V.doubles(F.col(vector))))
    summary = Summarizer.metrics("mean", "variance", "count").summary(F.col("_v"))
    found = known.groupBy(*group).agg(summary.alias("_s"))
    n = F.col("_s.count")
    # MLlib's variance is the sample's.
    deviation = F.transform(vector_to_array("_s.variance"), lambda v: F.sqrt(v * (n - 1) / n))
    return found.filter(n > 0).select(*group, vector_to_array("_s.mean").alias("mean"), deviation.alias("deviation"), n.alias("n"))


def dimension_moments(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(dim, mean, scale, n)``: mean and population deviation of every dimension; a constant
    dimension gets scale 1. Null vectors are left out."""
    cells = F.arrays_zip("mean", "deviation")
    rows = vector_means(df, vector).select("n", F.posexplode(cells).alias("dim", "_c"))
    scale = F.when(F.col("_c.deviation") == 0, 1.0).otherwise(F.col("_c.deviation"))
    return rows.select("dim", F.col("_c.mean").alias("mean"), scale.alias("scale"), "n")


class Standardize(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / scale on an array column, as a stage that saves with its pipeline."""

    mean = Param(Params._dummy(), "mean", "mean per dimension", TypeConverters.toListFloat)
    scale = Param(Params._dummy(), "scale", "scale per dimension", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol="embedding", outputCol="standardized", mean=None, scale=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        column = F.col(self.getInputCol())
        return dataset.withColumn(
            self.getOutputCol(),
            V.standardise(column, self.getOrDefault("mean"), self.getOrDefault("scale")),
        )


class ArrayToVector(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Array column to ML vector. Later stages cannot read a null, so a null becomes a vector of
    ``size`` zeros; ``transform_embeddings`` makes it a null again."""

    size = Param(Params._dummy(), "size", "elements of a vector", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, size=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        zeros = F.array_repeat(F.lit(0.0), self.getOrDefault("size"))
        return dataset.withColumn(
            self.getOutputCol(), array_to_vector(F.coalesce(V.doubles(F.col(self.getInputCol())), zeros))
        )


def fit_scaler(
    df: DataFrame, vector: str = "embedding", fit_on: str = "all", output: str = "standardized"
) -> Standardize:
    """Scaler over all rows, or only the labelled ones. What reaches the driver is two numbers
    per dimension."""
    if fit_on == "labelled":
        df = df.filter(F.col("label_id") != TEST_LABEL_ID)
    found = vector_means(df, vector).first()
    if found is None:
        raise ValueError("no vectors to fit a scaler on")
    scale = [d if d else 1.0 for d in found["deviation"]]
    return Standardize(inputCol=vector, outputCol=output, mean=found["mean"], scale=scale)


def fit_steps(
    df: DataFrame,
    vector: str = "embedding",
    standardize: bool = True,
    components: int | None = None,
    fit_on: str = "all",
    method: str = "covariance",
) -> PipelineModel:
    """Fit the optional steps in order on the vectors that are not null. The components come from a distributed covariance,
    one pass, and the driver holds dimension squared numbers whatever the rows; or with ``method``
    "randomized" from a random range, several passes, and it holds dimension x (components + 8).
    MLlib's projection does not subtract a mean, so data that was not standardised is centred by its
    own stage."""
    stages: list = []
    column = vector
    df = df.filter(F.col(vector).isNotNull())
    if standardize or components:
        scaler = fit_scaler(df, vector, fit_on)
        if not standardize:
            scaler._set(scale=[1.0] * len(scaler.getOrDefault("mean")))
        stages.append(scaler)
        column = "standardized"
    if components:
        size = len(stages[0].getOrDefault("mean"))
        stages.append(ArrayToVector(inputCol=column, outputCol="_vector", size=size))
        if method == "randomized":
            stages.append(random_range.fit(stages[0].transform(df), column, size, components))
        else:
            stages.append(PCA(k=components, inputCol="_vector", outputCol="_components"))
    return Pipeline(stages=stages).fit(df)


def pca_model(steps: PipelineModel):
    """The PCA stage of fitted steps, or None."""
    found = [s for s in steps.stages if hasattr(s, "explainedVariance")]
    return found[0] if found else None


def _signs(model) -> list[float]:
    """+1 or -1 per component, making its largest absolute loading positive. A component's
    direction is otherwise arbitrary."""
    loadings = model.pc.toArray()
    top = abs(loadings).argmax(axis=0)
    return [1.0 if loadings[row, i] >= 0 else -1.0 for i, row in enumerate(top)]


def principal_components(steps: PipelineModel):
    """Component rows (k x d) with canonical signs, as a numpy array."""
    model = pca_model(steps)
    return model.pc.toArray().T * [[s] for s in _signs(model)]


def transform_embeddings(df: DataFrame, steps: PipelineModel, output: str = "features") -> DataFrame:
    """Apply fitted steps; without any, the vector is handed through. Null stays null."""
    if not steps.stages:
        return df.withColumn(output, V.doubles(F.col("embedding")))
    done = steps.transform(df)
    model = pca_model(steps)
    if model is None:
        return done.withColumnRenamed("standardized", output)
    signs = V.literal_array(_signs(model))
    turned = F.transform(vector_to_array("_components"), lambda v, i: v * F.get(signs, i))
    return done.withColumn(output, F.when(F.col("standardized").isNotNull(), turned)).drop("standardized", "_vector", "_components")


def fit_transform_embeddings(
    df: DataFrame, standardize: bool = True, components: int | None = None, fit_on: str = "all"
) -> tuple[DataFrame, PipelineModel]:
    steps = fit_steps(df, "embedding", standardize, components, fit_on)
    return transform_embeddings(df, steps), steps


def explained_variance(steps: PipelineModel) -> float:
    """Share of the total variance kept by the components."""
    model = pca_model(steps)
    return float(sum(model.explainedVariance.toArray())) if model is not None else 1.0


def output_dimension(steps: PipelineModel, input_size: int) -> int:
    model = pca_model(steps)
    return model.getK() if model is not None else input_size


def combine_encoders(*vectors: Column) -> Column:
    """Vectors of several encoders side by side; the dimension is the sum of theirs."""
    return F.concat(*vectors)


def embedding_dim(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Distinct vector lengths with their rows; more than one line means mixed encoders."""
    return df.groupBy(F.size(vector).alias("dimension")).agg(F.count(F.lit(1)).alias("n"))


def noisy_features(vector: Column, key: Column, seed: int = 42, noise: float = 0.1, keep: float = 0.9) -> Column:
    """Training-time feature noise: Gaussian noise, then random zeroing. A cell's three draws come
    from one hash of seed, key and dimension, so a retried task repeats them."""

    def one(x: Column, i: Column) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), i.cast("string")).cast("binary"))

        def drawn(h: Column) -> Column:
            u = [(F.conv(F.substring(h, 1 + 10 * k, 10), 16, 10).cast("double") + 0.5) / float(1 << 40) for k in range(3)]
            normal = F.sqrt(-2 * F.log(u[0])) * F.cos(2 * F.pi() * u[1])
            return F.when(u[2] < keep, x + noise * normal).otherwise(F.lit(0.0))

        return V.let(digest, drawn)

    return F.transform(V.doubles(vector), one)
