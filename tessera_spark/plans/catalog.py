"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera_spark.functions import paths as P
from tessera_spark.functions import schedules, text
from tessera_spark.functions import vectors as V
from tessera_spark.operators import checks, embeddings, encode, images, inventory, labels, logs
from tessera_spark.operators import manifest as MF
from tessera_spark.operators import metrics as M
from tessera_spark.operators import mlp, numbering, runs, split, synchronous, training
from tessera_spark.plans import round_trips
from tessera_spark.plans import tables as T
from tessera_spark.session import materialise, scratch_path, ship_package
from tessera_spark.sources import bucketed
from tessera_spark.streaming import early_stop as early
from tessera_spark.streaming import logs as log_stream
from tessera_spark.streaming.common import run_by_batch, run_to_table
from tessera_spark.streaming.scoring import score_stream

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
PER_CLASS = 40
PATIENCE = 10
COMPONENTS = 8
HIDDEN = 16
STEP_HIDDEN = 4
ENCODED = 16
PROJECTED = 6
# The encoder of the registered query refuses images above this mean level.
BRIGHTEST = 128.5
TOTAL_EPOCHS = 100


def _r(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), DIGITS)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: _r(n) for n in names})


# Evaluation -------------------------------------------------------------------------------


def _confusion(spark: SparkSession, sf: str, part: str = "val") -> DataFrame:
    return M.confusion(T.scored(spark, sf, part)[0])


def class_report(spark, sf):
    report = M.class_report(_confusion(spark, sf), T.classes(spark, sf))
    return _rounded(report, "precision", "recall", "f1")


def class_report_all(spark, sf):
    report = M.class_report(_confusion(spark, sf, "all"), T.classes(spark, sf))
    return _rounded(report, "precision", "recall", "f1")


def confusion_long(spark, sf):
    return M.confusion_dense(_confusion(spark, sf), T.classes(spark, sf))


def confusion_wide(spark, sf):
    known = T.classes(spark, sf)
    names = [r["label_name"] for r in known.orderBy("label_id").collect()]
    return M.confusion_wide(_confusion(spark, sf), known, names)


def confusion_normalized(spark, sf):
    return _rounded(M.confusion_normalized(_confusion(spark, sf), T.classes(spark, sf)), "share")


def recall_ranking(spark, sf):
    return _rounded(M.recall_ranking(_confusion(spark, sf), T.classes(spark, sf)), "recall")


def confusion_summary(spark, sf):
    summary = M.confusion_summary(_confusion(spark, sf), T.classes(spark, sf))
    return _rounded(summary, "accuracy", "best_recall", "worst_recall")


def accuracy_macro_micro(spark, sf):
    measures = M.macro_metrics(_confusion(spark, sf))
    return _rounded(measures, *measures.columns)


def overall_accuracy(spark, sf):
    return _rounded(M.accuracy(_confusion(spark, sf)), "accuracy")


def cross_entropy_loss(spark, sf):
    parts = T.labelled_split(spark, sf)
    network = mlp.centroid_network(parts.filter(F.col("split") == "train"))
    rows = mlp.mlp_forward(parts.filter(F.col("split") == "val"), network)
    return _rounded(M.cross_entropy(rows), "loss")


def confidence_stats(spark, sf):
    stats = M.confidence_stats(T.scored(spark, sf, "all")[0])
    return _rounded(stats, "mean_confidence", "min_confidence", "max_confidence", "std_confidence")


def prediction_distribution(spark, sf):
    shares = M.prediction_distribution(T.scored(spark, sf, "unlabelled")[0], T.classes(spark, sf))
    return _rounded(shares, "percentage")


def sample_predictions(spark, sf):
    sample = M.sample_predictions(T.scored(spark, sf, "unlabelled")[0], T.classes(spark, sf))
    return _rounded(sample, "confidence_score")


def validation_samples(spark, sf):
    parts = T.labelled_split(spark, sf)
    network = mlp.centroid_network(parts.filter(F.col("split") == "train"))
    sample = mlp.predict(split.sample_validation(parts, "embedding_index"), network)
    return _rounded(M.validation_sample_table(sample, T.classes(spark, sf)), "confidence")


def decode_unknown(spark, sf):
    """Vector labels decoded by the classes of another table, which knows only some of them."""
    quality = T.read(spark, sf, "labels").select(
        F.col("quality").alias("label_id"),
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("label_name"),
    ).distinct()
    counts = T.read(spark, sf, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return labels.decode_labels(counts, quality, "label")


def label_quality_report(spark, sf):
    rows = T.read(spark, sf, "labels").select(
        F.col("quality").alias("label_id"), (1 - F.col("toxic")).alias("predicted_class")
    )
    known = rows.select(
        "label_id", F.concat(F.lit("quality_"), F.col("label_id").cast("string")).alias("label_name")
    ).distinct()
    return _rounded(M.class_report(M.confusion(rows), known), "precision", "recall", "f1")


# Splits -----------------------------------------------------------------------------------


def stratified_split(spark, sf):
    return T.labelled_split(spark, sf).select("embedding_index", "label_id", "split", "stratified")


def random_split(spark, sf):
    docs = T.read(spark, sf, "documents").select("doc_id", "lang")
    return split.random_split(docs, "doc_id")


def stratified_documents(spark, sf):
    """Languages as classes: one of them holds most of the rows."""
    docs = T.read(spark, sf, "documents").select("doc_id", "lang")
    return split.stratified_split(docs, "doc_id", "lang")


def stratified_rank(spark, sf):
    docs = T.read(spark, sf, "documents").select("doc_id", "lang")
    return split.stratified_rank(docs, "doc_id", "lang")


def split_counts(spark, sf):
    return split.split_counts(T.vectors(spark, sf))


def class_counts(spark, sf):
    counts = split.class_counts(T.vectors(spark, sf), T.classes(spark, sf))
    return counts


def class_coverage(spark, sf):
    return checks.class_coverage(T.labelled_split(spark, sf), T.classes(spark, sf))


def class_count_check(spark, sf):
    return checks.class_count_check(T.labelled_split(spark, sf))


def value_range(spark, sf):
    return _rounded(embeddings.value_range(T.vectors(spark, sf)), "min_value", "max_value")


def batches(spark, sf):
    rows = T.read(spark, sf, "embeddings").select(F.col("vec_id").alias("embedding_index"))
    return numbering.assign_batches(rows, "embedding_index", epoch=3)


def batches_permuted(spark, sf):
    rows = T.read(spark, sf, "embeddings").select(F.col("vec_id").alias("embedding_index"))
    return numbering.permuted_batches(rows, "embedding_index", rows.count(), epoch=3)


def batches_sequential(spark, sf):
    rows = T.read(spark, sf, "documents").select("doc_id")
    return numbering.assign_batches(rows, "doc_id", shuffle=False)


def sample_info(spark, sf):
    parts = T.labelled_split(spark, sf)
    sample = split.sample_validation(parts, "embedding_index")
    return split.sample_info(T.vectors(spark, sf), sample).select(
        "embedding_index", *MF.info_columns(T.vectors(spark, sf)).columns
    )


# Vectors ----------------------------------------------------------------------------------


def scaler_stats(spark, sf):
    return _rounded(embeddings.dimension_moments(T.read(spark, sf, "embeddings")), "mean", "scale")


def standardize(spark, sf):
    rows = T.read(spark, sf, "embeddings")
    done, _ = embeddings.fit_transform_embeddings(rows)
    return done.select("vec_id", F.posexplode("features").alias("dim", "z")).withColumn("z", _r("z"))


def dim_check(spark, sf):
    return embeddings.embedding_dim(T.read(spark, sf, "embeddings"))


def wrong_dimension(spark, sf):
    """One vector in four has both encoders side by side, one in ten is missing."""
    both = embeddings.combine_encoders(F.col("embedding"), F.col("embedding"))
    vector = F.when(F.col("vec_id") % 10 == 9, F.lit(None)).when(F.col("vec_id") % 4 == 0, both).otherwise(F.col("embedding"))
    rows = T.read(spark, sf, "embeddings").select(F.col("vec_id").alias("embedding_index"), vector.alias("embedding"))
    return checks.wrong_dimension(rows, 64)


def positional_check(spark, sf):
    indexed = MF.augment_fanout(_manifest_table(spark, sf))
    vectors = T.read(spark, sf, "embeddings").select(F.col("vec_id").alias("embedding_index"))
    return checks.positional_check(indexed, vectors)


def attach_embeddings(spark, sf):
    indexed = MF.augment_fanout(_manifest_table(spark, sf))
    vectors = T.read(spark, sf, "embeddings").select(
        F.col("vec_id").alias("embedding_index"), "embedding"
    )
    joined = MF.attach_embeddings(indexed, vectors)
    return joined.select("embedding_index", "image_name", "label_id", F.size("embedding").alias("dimension"))


def attach_embeddings_bucketed(spark, sf):
    """The same join from stored buckets, which moves neither side."""
    indexed = MF.augment_fanout(_manifest_table(spark, sf))
    vectors = T.read(spark, sf, "embeddings").select(F.col("vec_id").alias("embedding_index"), "embedding")
    buckets = max(4, bucketed.buckets_for(vectors.count()))
    opened = []
    for frame, name in ((indexed, "bucketed-names"), (vectors, "bucketed-vectors")):
        path = scratch_path(spark, name)
        bucketed.write_bucketed(frame, path, buckets)
        opened.append(bucketed.read_bucketed(spark, path))
    return bucketed.attach_bucketed(*opened).select("embedding_index", "image_name", "label_id", F.size("embedding").alias("dimension"))


def pca_variance(spark, sf):
    steps = embeddings.fit_steps(T.read(spark, sf, "embeddings"), components=COMPONENTS)
    ratios = embeddings.pca_model(steps).explainedVariance.toArray().tolist()
    rows = [(i, float(v)) for i, v in enumerate(ratios)]
    return spark.createDataFrame(rows, "component int, ratio double").withColumn("ratio", _r("ratio"))


def pca_transform(spark, sf):
    done, _ = embeddings.fit_transform_embeddings(
        T.read(spark, sf, "embeddings"), components=COMPONENTS
    )
    return done.select("vec_id", "label", F.transform("features", lambda v: F.round(v, DIGITS)).alias("features"))


def feature_noise(spark, sf):
    noisy = embeddings.noisy_features(F.col("embedding"), F.col("vec_id"))
    cells = T.read(spark, sf, "embeddings").select("vec_id", F.posexplode(noisy).alias("dim", "v"))
    return cells.select("vec_id", "dim", _r("v").alias("value"))


def project_rows(spark, sf):
    """Vectors centred and projected onto rows of a closed formula."""
    rows = T.read(spark, sf, "embeddings")
    size = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    start = T.formula_network(size, PROJECTED, 1)[0]
    centre = np.cos(np.arange(size)).tolist()
    projected = V.project(F.col("embedding"), centre, start.weight.tolist())
    return rows.select("vec_id", F.posexplode(projected).alias("component", "v")).select("vec_id", "component", _r("v").alias("value"))


def number_texts(spark, sf):
    """Counts and shares of event types as the text of a report."""
    counts = T.read(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    return counts.select(
        "event_type", text.thousands_text(F.col("n") * 1000).alias("thousands"), text.percent_text(share, 3).alias("share"), text.fixed_text(F.col("total"), 3).alias("total")
    )


def config_text(spark, sf):
    """Suppliers as JSON text, and what is read back from it."""
    fields = T.read(spark, sf, "supplier").select("s_suppkey", F.struct("s_name", F.col("s_nationkey").alias("nation"), F.array("s_suppkey", "s_nationkey").alias("keys")).alias("c"))
    written = fields.withColumn("json", text.to_json_text(F.col("c")))
    back = text.from_json_text(F.col("json"), fields.schema["c"].dataType)
    return written.withColumn("back", back).select("s_suppkey", "json", "back.s_name", F.element_at("back.keys", 2).cast("long").alias("second"))


def softmax_rows(spark, sf):
    """The vectors taken as logits: top class, its probability and that of the true class."""
    x = V.doubles(F.col("embedding"))
    return T.read(spark, sf, "embeddings").select(
        "vec_id",
        V.argmax(x).alias("top"),
        _r(V.confidence(x)).alias("confidence"),
        _r(V.probability_of(x, F.col("label"))).alias("label_probability"),
        _r(V.vector_sum(V.leaky_relu(x))).alias("rectified_sum"),
    )


def mlp_forward(spark, sf):
    rows = T.read(spark, sf, "embeddings")
    size = rows.agg(F.max(F.size("embedding")), F.max("label")).first()
    network = T.formula_network(size[0], HIDDEN, size[1] + 1)
    done = mlp.mlp_forward(rows, network)
    return done.select("vec_id", F.posexplode("logits").alias("class_id", "logit")).withColumn("logit", _r("logit"))


def mlp_fit(spark, sf):
    parts = T.labelled_split(spark, sf)
    fitted = training.fit_mlp(
        parts.filter(F.col("split") == "train"), parts.filter(F.col("split") == "val"), hidden=(64, 32), epochs=20, batch_rows=64
    )
    return fitted.epoch_metrics(spark)


def _labelled_vectors(spark, sf):
    return T.read(spark, sf, "embeddings").select(
        F.col("vec_id").alias("embedding_index"), "embedding", F.col("label").cast("int").alias("label_id")
    )


#: Parts the rows of a synchronous update are dealt to.
STEP_WORKERS = 16


def _cells(spark, network, *kinds):
    """(layer, kind, row, col, value) of a network."""
    table = mlp.layers_frame(spark, network).filter(F.col("kind").isin(*kinds))
    cells = table.select("layer", "kind", "cols", F.posexplode("values").alias("at", "v"))
    place = [F.expr(f"cast(at {op} cols as int)") for op in ("div", "%")]
    return cells.select("layer", "kind", place[0].alias("row"), place[1].alias("col"), _r("v").alias("value"))


def mlp_step(spark, sf):
    """One update over all vectors from weights of a closed formula, without hidden layer."""
    rows = _labelled_vectors(spark, sf)
    size = rows.agg(F.max(F.size("embedding")), F.max("label_id"), F.count(F.lit(1))).first()
    start = T.linear_formula(size[0], size[1] + 1)
    fitted = synchronous.fit_mlp(rows, hidden=(), workers=STEP_WORKERS, epochs=1, batch_rows=size[2], lr=0.01, dropout=False, start=start)
    cells = _cells(spark, fitted.last, "weight")
    return cells.select(F.col("row").alias("class_id"), F.col("col").alias("dim"), F.col("value").alias("weight"))


def mlp_three_steps(spark, sf):
    """Three updates over all vectors with a hidden layer normalised over the whole mini-batch. The
    hidden bias is left out: normalisation takes it away, so its gradient is nothing but rounding."""
    rows = _labelled_vectors(spark, sf)
    size = rows.agg(F.max(F.size("embedding")), F.max("label_id"), F.count(F.lit(1))).first()
    start = T.formula_network(size[0], STEP_HIDDEN, size[1] + 1)
    fitted = synchronous.fit_mlp(
        rows, hidden=(STEP_HIDDEN,), workers=STEP_WORKERS, epochs=3, batch_rows=size[2], lr=0.01, lr_end=0.01, dropout=False, start=start
    )
    cells = _cells(spark, fitted.last, "weight", "bias", "bn_gamma", "bn_beta")
    return cells.filter("layer = 1 or kind <> 'bias'")


def mlp_builtin(spark, sf):
    parts = T.labelled_split(spark, sf)
    model = training.fit_builtin_mlp(parts.filter(F.col("split") == "train"), (16,), max_iter=20)
    scored = training.predict_builtin(parts.filter(F.col("split") == "val"), model)
    return M.class_report(M.confusion(scored), T.classes(spark, sf))


# Manifest ---------------------------------------------------------------------------------


def _manifest(spark, sf):
    return MF.build_manifest(T.listing(spark, sf), T.RAW_ROOT, T.NORMALIZED_ROOT, PER_CLASS)


def _manifest_table(spark, sf):
    """The manifest as the stored table that later stages read."""
    return materialise(_manifest(spark, sf))


def _named(spark, sf):
    numbered = MF.number_files(T.listing(spark, sf), T.RAW_ROOT)
    return MF.name_files(numbered, T.NORMALIZED_ROOT, PER_CLASS)


def manifest(spark, sf):
    return _manifest(spark, sf).drop("position")


def normalized_names(spark, sf):
    return _named(spark, sf).select("original_path", "image_name", "index", "is_overflow")


def manifest_summary(spark, sf):
    return MF.manifest_summary(_manifest(spark, sf))


def moved_to_test(spark, sf):
    return MF.moved_to_test(_named(spark, sf))


def label_ids(spark, sf):
    """Brands as labels, in order of their first part."""
    parts = T.read(spark, sf, "part").select("p_partkey", "p_brand")
    known = labels.first_appearance_ids(parts, "p_brand", "p_partkey")
    coded = labels.encode_labels(parts, known, "p_brand")
    return coded.groupBy("p_brand", "label_id").agg(F.count(F.lit(1)).alias("n"))


def class_names(spark, sf):
    parts = T.read(spark, sf, "part").select(
        F.col("p_size").alias("label_id"), F.col("p_type").alias("label_name"), "p_partkey"
    )
    return labels.class_names(parts, "p_partkey")


def augment_fanout(spark, sf):
    return MF.augment_fanout(_manifest_table(spark, sf), 2).select(
        "embedding_index", "aug_version", "image_name"
    )


def missing_files(spark, sf):
    """Manifest rows whose document has no row in ``labels``; those that have one are on disk."""
    present = (
        T.listing(spark, sf).join(T.read(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    )
    missing = MF.missing_files(_manifest(spark, sf), present, "original_path")
    return missing.select("original_path", "label_name")


def existing_files(spark, sf):
    present = (
        T.listing(spark, sf).join(T.read(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    )
    return MF.existing_files(_manifest(spark, sf), present, "original_path").select(
        "original_path", "label_name"
    )


def failed_images(spark, sf):
    """Manifest without the images of documents marked toxic, which stand for broken files."""
    broken = (
        T.listing(spark, sf)
        .join(T.read(spark, sf, "labels").filter(F.col("toxic") == 1).select("doc_id"), "doc_id", "left_semi")
        .select(F.col("path").alias("original_path"))
    )
    kept = MF.build_manifest(
        T.listing(spark, sf), T.RAW_ROOT, T.NORMALIZED_ROOT, PER_CLASS, failed=broken
    )
    return kept.select("original_path", "image_name", "label_id")


def sentinel_check(spark, sf):
    """Part types as labels, one of them read as the unlabelled name but not flagged."""
    rows = T.read(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_type") == "ECONOMY", P.TEST_LABEL).otherwise(F.col("p_type")).alias("label_name"),
        (F.col("p_type") == "STANDARD").alias("is_test"),
    )
    known = labels.first_appearance_ids(rows, position="p_partkey")
    return checks.sentinel_violations(labels.encode_labels(rows, known)).select(
        "p_partkey", "label_name", "is_test", "label_id"
    )


def path_functions(spark, sf):
    url = F.col("url")
    tail = F.regexp_replace(P.strip_scheme(url), r"[?#].*$", "")
    detour = F.concat(F.lit("/a//./b/.."), tail, F.lit("/../"))
    return T.read(spark, sf, "pages").select(
        "page_id",
        tail.alias("plain"),
        P.base_name(tail).alias("name"),
        P.normalise_path(detour).alias("normalised"),
        P.absolute_path(F.substr(tail, F.lit(2)), "/work").alias("absolute"),
        P.is_image(url).alias("is_image"),
        text.truncate(url, 30, 27).alias("short"),
    )


def output_folders(spark, sf):
    """Each source as a dataset folder, some already normalised, some with a folder of its own."""
    docs = T.read(spark, sf, "documents")
    sources = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    name = F.when(F.col("source") == T.ROOT_SOURCE, F.concat(F.lit("/in/normalized_"), "source")).otherwise(
        F.concat(F.lit("/in/"), "source")
    )
    explicit = F.when(F.col("source") == T.TEST_SOURCE, F.lit("/given/folder"))
    return sources.select("source", "n", P.output_folder(name, explicit, "/project").alias("folder"))


# Runs, logs, inventory --------------------------------------------------------------------


def best_epoch(spark, sf):
    return runs.best_epoch(T.runs(spark, sf).select("run_id", "epoch", "value"))


def early_stop(spark, sf):
    return runs.early_stop(T.runs(spark, sf).select("run_id", "epoch", "value"), PATIENCE)


def epoch_progress(spark, sf):
    timed = T.runs(spark, sf).select("run_id", "epoch", "ts")
    progress = runs.epoch_progress(timed, TOTAL_EPOCHS)
    return _rounded(progress, "percent", "elapsed", "epoch_seconds").withColumn("eta", F.round("eta", 3))


def val_cadence(spark, sf):
    return runs.validation_cadence(T.runs(spark, sf).select("run_id", "epoch"))


def lr_schedule(spark, sf):
    epoch = F.col("epoch")
    rates = T.runs(spark, sf).select(
        "run_id",
        "epoch",
        (schedules.cosine_lr(epoch, TOTAL_EPOCHS) * 1e6).alias("cosine_micro"),
        schedules.warmup_factor(epoch, 20, TOTAL_EPOCHS, 1e-6, 2e-4).alias("warmup_cosine"),
        schedules.warmup_factor(epoch, 20, None, 1e-4, 3e-3).alias("warmup_constant"),
    )
    return _rounded(rates, "cosine_micro", "warmup_cosine", "warmup_constant")


def progress_flags(spark, sf):
    rows = T.runs(spark, sf)
    phase = T.lookup("event_type", {k: v[0] for k, v in T.SERIES_OF_EVENT.items()})
    name = T.lookup("event_type", {k: v[1] for k, v in T.SERIES_OF_EVENT.items()})
    flags = runs.progress_flags(
        rows.select("run_id", "epoch", phase.alias("phase"), name.alias("name"), "value")
    )
    return _rounded(flags, *[c for c in flags.columns if c.startswith(("train_", "val_"))])


def run_events(spark, sf):
    """Events written as run lines and parsed back."""
    rows = T.runs(spark, sf)
    line = runs.event_line(
        T.lookup("event_type", T.KIND_OF_EVENT), epoch=F.col("epoch"), time=F.col("ts"), count=F.col("event_id")
    )
    parsed = runs.parse_run_events(rows.select("run_id", line.alias("line")))
    return parsed.select(
        "run_id",
        "kind",
        "epoch",
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.col("fields")["count"].cast("long").alias("event_id"),
    )


def run_registry(spark, sf):
    """A dataset per event type; purchases of a user count as the dataset location."""
    rows = T.read(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("dataset"),
        F.when(F.col("event_type") == "purchase", 0).otherwise(1).alias("priority"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("project"),
        F.concat_ws("-", "event_type", F.col("event_id").cast("string")).alias("name"),
        F.array("event_type").alias("tags"),
    )
    found = runs.run_registry(rows)
    return found.withColumn("tags", F.array_join("tags", "|"))


def _artefacts(spark, sf):
    """Events as artefacts of one dataset per user and day."""
    return T.read(spark, sf, "events").select(
        F.concat_ws("_", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("dataset"),
        T.lookup("event_type", T.ARTEFACT_OF_EVENT).alias("file_name"),
    )


def _inventory(spark, sf):
    files = _artefacts(spark, sf)
    return inventory.dataset_inventory(files, files, "/data/raw", "/data/normalized")


def dataset_inventory(spark, sf):
    return inventory.with_start_stage(_inventory(spark, sf))


def stage_ready(spark, sf):
    return checks.stage_ready(_inventory(spark, sf))


def dataset_lookup(spark, sf):
    return inventory.dataset_lookup(_inventory(spark, sf), "1_20240101")


def stage_summary(spark, sf):
    rows = T.read(spark, sf, "events").select(
        T.lookup("event_type", T.STAGE_OF_EVENT).alias("stage"),
        (F.col("event_type") != "signup").alias("completed"),
        F.col("ts").cast("timestamp").alias("time"),
        F.concat(F.lit("/data/normalized/some/long/folder/of/the/run/number/"), F.col("event_id").cast("string")).alias("output_path"),
        F.col("props").alias("results"),
    )
    return inventory.stage_summary(rows)


def log_filter(spark, sf):
    return logs.log_filter(T.log_lines(spark, sf), "source", ["turn", "line_no"])


def log_filter_documents(spark, sf):
    """Lines of all documents of a source as one log: few sources, each with very many lines."""
    docs = T.read(spark, sf, "documents").select("source", F.col("doc_id").alias("turn"), "text")
    kept = logs.log_filter(text.explode_lines(docs, "text"), "source", ["turn", "line_no"])
    return kept.select("source", "turn", "line_no", "line")


# Images -----------------------------------------------------------------------------------


def image_resize(spark, sf):
    """All images at the size the encoders take, 224 x 224; the pixels as one digest."""
    done = images.normalize_images(T.images(spark, sf))
    return done.select("image_path", "height", "width", "nChannels", F.md5(F.hex("data").cast("binary")).alias("pixels_md5"))


def wrong_size(spark, sf):
    """Two images in three have the size that is asked for."""
    odd = F.when(F.col("place") % 3 == 0, F.col("height")).otherwise(F.lit(images.HEIGHT))
    rows = T.images(spark, sf).withColumn("place", F.regexp_extract("image_path", r"(\d+)\.png", 1).cast("long"))
    return checks.wrong_size(rows.withColumn("height", odd).withColumn("width", F.lit(images.WIDTH)))


def _flipped(image, rng):
    return image[:, ::-1]


def _brighter(image, rng):
    return np.clip(image.astype(int) + 40, 0, 255).astype(np.uint8)


def image_augment(spark, sf):
    done = images.augment_images(T.images(spark, sf), 1, ((1.0, _flipped), (0.0, _flipped), (1.0, _brighter)))
    return done.select("image_path", "aug_version", "height", "width", F.hex("data").alias("pixels"))


def _projection_encoder():
    """Mean brightness of an 8 x 8 grid of cells, projected by a matrix of a closed formula."""
    weights = np.sin(np.arange(192)[:, None] * 7.0 + np.arange(ENCODED)[None, :])

    def encode_batch(batch):
        cells = []
        for image in batch:
            if image.mean() > BRIGHTEST:
                raise ValueError("too bright")
            h, w = (image.shape[0] // 8) * 8, (image.shape[1] // 8) * 8
            grid = image[:h, :w].reshape(8, h // 8, 8, w // 8, 3).mean(axis=(1, 3))
            cells.append(grid.ravel() / 255.0)
        return np.stack(cells) @ weights

    return encode_batch


def embed_images(spark, sf):
    done = encode.embed(T.images(spark, sf), _projection_encoder)
    return done.select("image_path", "error", F.posexplode_outer("embedding").alias("dim", "value")).withColumn(
        "value", _r("value")
    )


def model_sources(spark, sf):
    """Part names stand for model names; parts of the first sizes bear a hub model's."""
    name = F.col("p_name")
    for size, hub in enumerate(encode.HUB_MODELS, start=1):
        name = F.when(F.col("p_size") == size, hub).otherwise(name)
    names = T.read(spark, sf, "part").groupBy(name.alias("p_name")).agg(F.count(F.lit(1)).alias("n"))
    source = encode.model_source(F.col("p_name"))
    return names.select("p_name", "n", source["hub"].alias("hub"), source["name"].alias("name"))


# Streams ----------------------------------------------------------------------------------


def score_stream_query(spark, sf):
    parts = T.labelled_split(spark, sf)
    network = mlp.centroid_network(parts.filter(F.col("split") == "train"))
    stream = T.stream(spark, sf, "embeddings")
    path = run_to_table(score_stream(stream, network).drop("embedding"), "scores")
    return _rounded(spark.read.parquet(path), "confidence_score")


def score_stream_replayed(spark, sf):
    """The same scores when the job ends between writing a micro-batch and noting it, and starts again."""
    parts = T.labelled_split(spark, sf)
    network = mlp.centroid_network(parts.filter(F.col("split") == "train"))
    output = scratch_path(spark, "replayed-scores")

    def end_here(number):
        raise InterruptedError(f"ended after batch {number}")

    for after in (end_here, None):
        stream = T.stream(spark, sf, "embeddings")
        try:
            run_by_batch(score_stream(stream, network).drop("embedding"), "scores", output, after)
        except StreamingQueryException:
            if after is None:
                raise
    return _rounded(spark.read.parquet(output).drop("batch"), "confidence_score")


def early_stop_stream(spark, sf):
    stream = T.stream(spark, sf, "events", whole=True)
    values = stream.select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("epoch"), (F.col("value") / 1000).alias("value")
    )
    path = run_to_table(early.early_stop_stream(values, PATIENCE), "stops")
    return early.latest(spark.read.parquet(path))


def early_stop_batches(spark, sf):
    """The same with its state in tables, one run spread over tasks."""
    stream = T.stream(spark, sf, "events", whole=True)
    values = stream.select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("epoch"), (F.col("value") / 1000).alias("value")
    )
    path = early.early_stop_batches(values, scratch_path(spark, "stops"), PATIENCE)
    return early.latest(spark.read.parquet(path).drop("batch"))


def log_filter_stream(spark, sf):
    stream = T.stream(spark, sf, "conversations", whole=True)
    turns = stream.select(F.col("conv_id").alias("source"), "turn", "text")
    lines = text.explode_lines(turns, "text")
    path = run_to_table(log_stream.log_filter_stream(lines), "lines")
    return spark.read.parquet(path)


def log_filter_by_time(spark, sf):
    """The same by event time, the number of a turn, with a delay of two turns."""
    stream = T.stream(spark, sf, "conversations", whole=True)
    lines = text.explode_lines(stream.select(F.col("conv_id").alias("source"), F.col("turn").cast("long").alias("turn"), "text"), "text")
    return log_stream.log_filter_by_time(lines, scratch_path(spark, "lines"), 2).withColumn("turn", F.col("turn").cast(T.read(spark, sf, "conversations").schema["turn"].dataType))


_QUERIES: tuple[Query, ...] = (
    class_report, class_report_all, confusion_long, confusion_wide, confusion_normalized,
    recall_ranking, confusion_summary, accuracy_macro_micro, overall_accuracy,
    cross_entropy_loss, confidence_stats, prediction_distribution, sample_predictions,
    validation_samples, decode_unknown, label_quality_report,
    stratified_split, stratified_documents, random_split, stratified_rank, split_counts,
    class_counts, class_coverage, class_count_check, value_range, batches, batches_permuted, batches_sequential,
    sample_info,
    scaler_stats, standardize, dim_check, wrong_dimension, positional_check, attach_embeddings,
    attach_embeddings_bucketed, pca_variance, pca_transform, project_rows, feature_noise, number_texts, config_text, softmax_rows, mlp_forward, mlp_fit, mlp_step, mlp_three_steps, mlp_builtin,
    manifest, normalized_names, manifest_summary, moved_to_test, label_ids, class_names,
    augment_fanout, missing_files, existing_files, failed_images, sentinel_check,
    path_functions, output_folders,
    best_epoch, early_stop, epoch_progress, val_cadence, lr_schedule, progress_flags,
    run_events, run_registry, dataset_inventory, stage_ready, dataset_lookup, stage_summary,
    log_filter, log_filter_documents,
    image_resize, wrong_size, image_augment, embed_images, model_sources,
    score_stream_replayed, early_stop_stream, early_stop_batches, log_filter_stream, log_filter_by_time,
)


def all_queries() -> dict[str, Query]:
    named = {q.__name__: q for q in (*_QUERIES, *round_trips.QUERIES)}
    named["score_stream"] = score_stream_query

    def prepared(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return query(spark, sf_dir)

        return run

    return {name: prepared(query) for name, query in named.items()}
