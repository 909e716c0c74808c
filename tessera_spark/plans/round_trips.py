"""Registered round trips: tables of the stages are written by their sinks, read back by their
sources and then looked at, so that the query sees what a later stage would see."""

from __future__ import annotations

import os

import numpy as np
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera_spark import schemas
from tessera_spark.functions import paths as P
from tessera_spark.operators import embeddings, mlp, runs
from tessera_spark.operators import manifest as MF
from tessera_spark.operators import metrics as M
from tessera_spark.plans import tables as T
from tessera_spark.plans.evaluation import evaluate
from tessera_spark.session import materialise, scratch_path
from tessera_spark.sources import append_log, npy
from tessera_spark.sources import runs as run_tables
from tessera_spark.sources import tables as IO

PER_CLASS = 40
DIGITS = 6
COMPONENTS = 8


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    return MF.build_manifest(T.listing(spark, sf), T.RAW_ROOT, T.NORMALIZED_ROOT, PER_CLASS)


def manifest_table(spark, sf):
    path = scratch_path(spark, "manifest")
    IO.write_manifest(_manifest(spark, sf), path)
    return IO.read_manifest(spark, path)


def manifest_csv(spark, sf):
    path = scratch_path(spark, "manifest-csv")
    IO.write_manifest(_manifest(spark, sf), path, "csv")
    return IO.read_manifest(spark, path, "csv")


def train_test_rows(spark, sf):
    """Train and test rows of the stored manifest, counted by label."""
    rows = manifest_table(spark, sf)
    parts = (("train", MF.train_rows(rows)), ("test", MF.test_rows(rows)))
    counts = [r.groupBy("label_name").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(name)) for name, r in parts]
    return counts[0].unionByName(counts[1])


def embeddings_table(spark, sf):
    path = scratch_path(spark, "embeddings")
    IO.write_embeddings(T.vectors(spark, sf), path)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double"))
    return IO.read_embeddings(spark, path).select("embedding_index", "image_path", F.size("embedding").alias("dimension"), F.round(total, 3).alias("total"))


def npy_round_trip(spark, sf):
    """All vectors through one ``.npy`` matrix."""
    path = f"{scratch_path(spark, 'matrix')}.npy"
    plain = path.removeprefix("file://").removeprefix("file:")
    os.makedirs(os.path.dirname(plain), exist_ok=True)
    npy.write_npy(T.read(spark, sf, "embeddings").select(F.col("vec_id").alias("embedding_index"), "embedding"), path)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double"))
    return npy.read_npy(spark, path, partition_bytes=1 << 16).select("embedding_index", F.size("embedding").alias("dimension"), F.round(total, 3).alias("total"))


def model_config_json(spark, sf):
    """The configuration that belongs to the vectors and their classes."""
    size = T.read(spark, sf, "embeddings").agg(F.max(F.size("embedding"))).first()[0]
    path = scratch_path(spark, "config")
    gathered = T.classes(spark, sf).agg(F.transform(F.sort_array(F.collect_list(F.struct("label_id", "label_name"))), lambda s: s["label_name"]).alias("class_labels"))
    config = gathered.select(
        F.lit(size).cast("int").alias("input_size"),
        F.size("class_labels").alias("num_classes"),
        F.array(F.lit(16).cast("int"), F.lit(8).cast("int")).alias("hidden_units"),
        F.array(F.struct(F.lit("hub").alias("hub"), F.lit("name").alias("name"))).alias("clip_models"),
        "class_labels",
    )
    IO.write_config(config, path)
    found = IO.read_config(spark, path)
    return found.select("input_size", "num_classes", F.array_join("hidden_units", "-").alias("hidden"), F.array_join("class_labels", ",").alias("classes"))


def layers_table(spark, sf):
    """Class means of all labelled vectors as a stored network."""
    network = mlp.centroid_network(T.vectors(spark, sf).filter(F.col("label_id") >= 0))
    path = scratch_path(spark, "layers")
    IO.save_layers(spark, network, path)
    weight = mlp.layers_frame(spark, IO.load_layers(spark, path)).filter("kind = 'weight'")
    cells = weight.select("cols", F.posexplode("values").alias("at", "v"))
    return cells.select(
        F.expr("cast(at div cols as int)").alias("label_id"), F.expr("cast(at % cols as int)").alias("dim"), F.round("v", DIGITS).alias("mean")
    )


def processors_table(spark, sf):
    path = scratch_path(spark, "processors")
    rows = T.read(spark, sf, "embeddings")
    IO.save_processors(embeddings.fit_steps(rows), path)
    done = embeddings.transform_embeddings(rows, IO.load_processors(path))
    return done.select("vec_id", F.posexplode("features").alias("dim", "z")).withColumn("z", F.round("z", DIGITS))


def standardize_with_nulls(spark, sf):
    """One vector in ten is null, as after a failed image: fits leave it out, results keep it."""
    rows = T.read(spark, sf, "embeddings").select("vec_id", F.when(F.col("vec_id") % 10 != 0, F.col("embedding")).alias("embedding"))
    done, _ = embeddings.fit_transform_embeddings(rows)
    total = F.aggregate("features", F.lit(0.0), lambda a, v: a + v * v)
    return done.select("vec_id", F.round(total, 4).alias("squares"))


def pca_check(spark, sf, method="covariance"):
    """Each component against the correlation matrix: what is left of its eigen equation, its
    length, and the total variance of the standardised vectors."""
    rows = T.read(spark, sf, "embeddings")
    steps = embeddings.fit_steps(rows, components=COMPONENTS, method=method)
    parts = embeddings.principal_components(steps)
    vectors = embeddings.ArrayToVector(inputCol="embedding", outputCol="v", size=parts.shape[1]).transform(rows)
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    found = []
    for k, c in enumerate(parts):
        value = float(c @ matrix @ c)
        rest = float(np.abs(matrix @ c - value * c).max())
        other = float(max([abs(c @ d) for d in np.delete(parts, k, axis=0)], default=0.0))
        found.append((k, abs(round(rest, DIGITS)), abs(round(other, DIGITS)), round(float(c @ c), DIGITS), round(float(np.trace(matrix)), DIGITS)))
    return spark.createDataFrame(found, "component int, residual double, overlap double, length double, total double")


def pca_check_randomized(spark, sf):
    """The same of components found by a random range."""
    return pca_check(spark, sf, "randomized")


def confusion_csv(spark, sf):
    known = T.classes(spark, sf)
    names = [r["label_name"] for r in known.orderBy("label_id").collect()]
    wide = M.confusion_wide(M.confusion(T.scored(spark, sf)[0]), known, names)
    path = scratch_path(spark, "confusion-csv")
    IO.export_confusion(wide, path)
    schema = ", ".join(["true_label string", *(f"{n} long" for n in names)])
    return spark.read.schema(schema).option("header", True).csv(path)


def _results(spark, sf, form):
    rows = T.scored(spark, sf, "all")[0].withColumns(
        {"original_path": F.col("image_path"), "label_prediction": F.lit(None), "aug_version": F.lit(0)}
    )
    path = scratch_path(spark, "results")
    IO.export_results(mlp.as_scored(rows), path, form)
    report = M.class_report(M.confusion(IO.read_results(spark, path, form)), T.classes(spark, sf))
    return report.withColumns({n: F.round(n, DIGITS) for n in ("precision", "recall", "f1")})


def results_table(spark, sf):
    return _results(spark, sf, "parquet")


def results_csv(spark, sf):
    return _results(spark, sf, "csv")


def evaluation_report(spark, sf):
    parts = T.labelled_split(spark, sf)
    network = mlp.centroid_network(parts.filter(F.col("split") == "train"))
    report = evaluate(mlp.predict(parts, network), T.classes(spark, sf)).report
    return report.withColumns({n: F.round(n, DIGITS) for n in ("precision", "recall", "f1")})


def epoch_metrics_table(spark, sf):
    """Metrics appended in two goes, each repeated as by a retried job, with a compaction between;
    read back as one series."""
    rows = T.runs(spark, sf).select(
        F.col("run_id").cast("string").alias("run_id"), F.col("epoch").cast("int").alias("epoch"), F.lit("val").alias("phase"), F.lit("recall").alias("name"), "value"
    )
    path = scratch_path(spark, "metrics")
    for turn in (0, 1):
        for _ in range(2):
            run_tables.log_epoch_metrics(rows.filter(F.col("epoch") % 2 == turn), path, "trainer", turn)
            append_log.compact(spark, path, schemas.EPOCH_METRICS)
    best = runs.best_epoch(runs.series(run_tables.read_epoch_metrics(spark, path)))
    return best.select(F.col("run_id").cast("long").alias("run_id"), *(F.col(c).cast("long").alias(c) for c in ("best_epoch", "last_epoch")), "best_value")


def run_lines_table(spark, sf):
    rows = T.runs(spark, sf)
    line = runs.event_line(T.lookup("event_type", T.KIND_OF_EVENT), epoch=F.col("epoch"), time=F.col("ts"), count=F.col("event_id"))
    lines = rows.select(F.col("run_id").cast("string").alias("run_id"), "epoch", line.alias("line"))
    path = scratch_path(spark, "run-lines")
    for turn in (0, 1):
        for _ in range(2):
            run_tables.append_run_events(lines.filter(F.col("epoch") % 2 == turn), path, "trainer", turn)
    parsed = runs.parse_run_events(run_tables.read_run_lines(spark, path))
    return parsed.select(
        F.col("run_id").cast("long").alias("run_id"),
        "kind",
        "epoch",
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.col("fields")["count"].cast("long").alias("event_id"),
    )


def embedding_index_of_images(spark, sf):
    """Images under their raw paths and variants find their names and row numbers."""
    rows = materialise(_manifest(spark, sf))
    augmented = MF.augment_fanout(rows, 2)
    raw = rows.select(F.col("original_path").alias("image_path"), F.explode(F.array(*map(F.lit, range(3)))).alias("aug_version"))
    named = MF.with_normalized_paths(raw, rows)
    found = MF.with_embedding_index(named, augmented)
    return found.select("embedding_index", "aug_version", P.base_name(F.col("image_path")).alias("image_name"))


QUERIES = (
    manifest_table, manifest_csv, train_test_rows, embeddings_table, npy_round_trip, model_config_json, layers_table, processors_table,
    standardize_with_nulls, pca_check, pca_check_randomized, confusion_csv, results_table, results_csv, evaluation_report, epoch_metrics_table,
    run_lines_table, embedding_index_of_images,
)
