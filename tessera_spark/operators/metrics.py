"""Evaluation tables. Rows are combined once into the (true, predicted) counts; everything
per class derives from that k x k table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera_spark.functions import bands
from tessera_spark.functions import vectors as V
from tessera_spark.functions.paths import base_name
from tessera_spark.functions.text import bar
from tessera_spark.operators.labels import decode_labels, dense_classes
from tessera_spark.operators.split import sample_rows


def ratio(part: Column, whole: Column) -> Column:
    """Share that is zero on zero division."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion(scored: DataFrame) -> DataFrame:
    """``(true_id, pred_id, n)`` over labelled rows; absent pairs are left out."""
    return (
        scored.filter(F.col("label_id") >= 0)
        .groupBy(F.col("label_id").alias("true_id"), F.col("predicted_class").alias("pred_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_dense(cm: DataFrame, classes: DataFrame) -> DataFrame:
    """All k x k cells, zeros included. The grid is generated from the class ids, which are
    0..k-1, so no class meets another one through a join."""
    k = classes.agg(F.coalesce(F.max("label_id"), F.lit(-1)).alias("k")).first()["k"]
    if k < 0:
        return cm.limit(0)
    grid = classes.select(
        F.col("label_id").alias("true_id"), F.explode(F.sequence(F.lit(0), F.lit(k))).alias("pred_id")
    )
    return grid.join(cm, ["true_id", "pred_id"], "left").na.fill(0, ["n"])


def confusion_wide(cm: DataFrame, classes: DataFrame, class_labels: Sequence[str]) -> DataFrame:
    """One row per true class, one count column per predicted class, in id order."""
    counts = cm.groupBy("true_id").pivot("pred_id", list(range(len(class_labels)))).agg(F.sum("n"))
    rows = classes.join(counts, F.col("label_id") == F.col("true_id"), "left")
    cells = [
        F.coalesce(F.col(f"`{i}`"), F.lit(0)).alias(name) for i, name in enumerate(class_labels)
    ]
    return rows.select("label_id", F.col("label_name").alias("true_label"), *cells)


def confusion_normalized(cm: DataFrame, classes: DataFrame) -> DataFrame:
    """Row shares; null for a class without rows."""
    total = F.sum("n").over(W.partitionBy("true_id"))
    share = F.try_divide(F.col("n").cast("double"), total.cast("double"))
    return confusion_dense(cm, classes).withColumn("share", share)


def class_totals(cm: DataFrame) -> DataFrame:
    """Support, predictions and hits per class from one pass over the k x k table: every cell
    is counted once for its row and once for its column."""
    hit = F.when(F.col("true_id") == F.col("pred_id"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("true_id").alias("id"), F.col("n").alias("s"), zero.alias("p"), hit.cast("long").alias("h")),
        F.struct(F.col("pred_id").alias("id"), zero.alias("s"), F.col("n").alias("p"), zero.alias("h")),
    )
    return (
        cm.select(F.explode(sides).alias("_c"))
        .groupBy(F.col("_c.id").alias("label_id"))
        .agg(
            F.sum("_c.s").alias("support"),
            F.sum("_c.p").alias("predicted"),
            F.sum("_c.h").alias("hits"),
        )
    )


def class_report(cm: DataFrame, classes: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class, zero on zero division."""
    totals = dense_classes(class_totals(cm), classes)
    measured = totals.select(
        "label_id",
        "label_name",
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
    )
    return measured.withColumn("performance", bands.f1_band(F.col("f1")))


def accuracy(cm: DataFrame) -> DataFrame:
    hits = F.sum(F.when(F.col("true_id") == F.col("pred_id"), F.col("n")).otherwise(0))
    return cm.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.try_divide(hits.cast("double"), F.sum("n").cast("double")).alias("accuracy"),
    )


def recall_ranking(cm: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes by recall, highest first; ties keep class order."""
    report = class_report(cm, classes).select("label_id", "label_name", "recall", "support")
    order = W.orderBy(F.col("recall").desc(), F.col("label_id"))
    return report.select(
        F.row_number().over(order).alias("place"),
        "label_id",
        "label_name",
        "recall",
        F.col("support").alias("samples"),
        bands.recall_band(F.col("recall")).alias("performance"),
    ).orderBy("place")


def confusion_summary(cm: DataFrame, classes: DataFrame) -> DataFrame:
    """Overall accuracy, total, number of classes, best and worst class by recall."""
    ranked = recall_ranking(cm, classes)
    hits = F.sum(F.col("recall") * F.col("samples"))
    return ranked.agg(
        F.try_divide(hits, F.sum("samples").cast("double")).alias("accuracy"),
        F.sum("samples").alias("total"),
        F.count(F.lit(1)).alias("num_classes"),
        F.min_by("label_name", "place").alias("best_class"),
        F.min_by("recall", "place").alias("best_recall"),
        F.max_by("label_name", "place").alias("worst_class"),
        F.max_by("recall", "place").alias("worst_recall"),
    )


def macro_metrics(cm: DataFrame) -> DataFrame:
    """Macro recall (which is macro accuracy), precision and F1 over classes that occur on
    either side, and micro accuracy."""
    totals = class_totals(cm)
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    recall = ratio(hits, support)
    return totals.agg(
        F.avg(recall).alias("macro_accuracy"),
        F.avg(ratio(2 * hits, support + predicted)).alias("macro_f1"),
        F.avg(ratio(hits, predicted)).alias("macro_precision"),
        F.avg(recall).alias("macro_recall"),
        F.try_divide(F.sum(hits).cast("double"), F.sum(support).cast("double")).alias("micro_accuracy"),
    )


def cross_entropy(rows: DataFrame, logits: str = "logits", label: str = "label_id") -> DataFrame:
    loss = V.row_cross_entropy(F.col(logits), F.col(label))
    return rows.agg(F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("n"))


def confidence_stats(scored: DataFrame) -> DataFrame:
    """Mean, min, max, population deviation and count of the confidence for labelled rows,
    unlabelled rows and all rows, in one pass."""
    part = F.when(F.col("label_id") >= 0, "labelled").otherwise("unlabelled")
    value = F.col("confidence_score")
    tagged = scored.select(part.alias("part"), value)
    sets = tagged.groupingSets([[F.col("part")], []], F.col("part")).agg(
        F.avg(value).alias("mean_confidence"),
        F.min(value).alias("min_confidence"),
        F.max(value).alias("max_confidence"),
        F.stddev_pop(value).alias("std_confidence"),
        F.count(value).alias("n"),
    )
    return sets.withColumn("part", F.coalesce("part", F.lit("all")))


def prediction_distribution(scored: DataFrame, classes: DataFrame, width: int = 15) -> DataFrame:
    """Predictions per class with share and bar, most frequent first; on equal counts the
    higher class id comes first. Window and sort run over one row per class."""
    counts = scored.groupBy(F.col("predicted_class").alias("label_id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    percent = F.col("n") / F.sum("n").over(W.partitionBy()) * 100
    place = F.row_number().over(W.orderBy(F.col("n").desc(), F.col("label_id").desc()))
    shares = counts.select(
        place.alias("place"), "label_id", "n", percent.alias("percentage")
    ).withColumn("bar", bar(F.col("percentage") / 100 * width, width))
    return decode_labels(shares, classes, "label_id").orderBy("place")


def sample_predictions(
    scored: DataFrame, classes: DataFrame, key: str = "embedding_index", n: int = 8, seed: int = 42
) -> DataFrame:
    """Sampled predictions with file name, class name, confidence and its band."""
    sample = sample_rows(scored, key, n, seed)
    named = decode_labels(sample, classes, "predicted_class", "predicted_label", checked=False)
    return named.select(
        key,
        base_name(F.col("image_path")).alias("file_name"),
        "predicted_label",
        "confidence_score",
        bands.confidence_band(F.col("confidence_score")).alias("confidence_level"),
    )


def validation_sample_table(sample: DataFrame, classes: DataFrame) -> DataFrame:
    """Sampled validation rows with names of both labels, probability of the predicted class
    and the verdict. ``sample`` is already scored."""
    both = decode_labels(sample, classes, "label_id", "true_label", checked=False)
    both = decode_labels(both, classes, "predicted_class", "pred_label", checked=False)
    return both.select(
        "image_name",
        "true_label",
        "pred_label",
        F.col("confidence_score").cast("double").alias("confidence"),
        bands.verdict(F.col("predicted_class"), F.col("label_id")).alias("correct"),
    )
