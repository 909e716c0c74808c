"""The evaluation report: one scored table, every table of the report derived from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tessera_spark.operators import metrics as M
from tessera_spark.operators.manifest import labelled_rows, unlabelled_rows
from tessera_spark.session import materialise, small_side


@dataclass
class Evaluation:
    """Tables of the report; all lazy, over one stored scored table."""

    scored: DataFrame
    confusion: DataFrame
    normalized: DataFrame
    report: DataFrame
    ranking: DataFrame
    summary: DataFrame
    macro: DataFrame
    confidence: DataFrame
    distribution: DataFrame
    samples: DataFrame


def evaluate(scored: DataFrame, classes: DataFrame, split: str = "val", key: str = "embedding_index") -> Evaluation:
    """Measures over labelled rows of one ``split`` ('all' takes train rows as well), and
    distribution and samples over the unlabelled rows."""
    # Vectors and logits are not part of the report and would only be copied along.
    columns = [key, "image_path", "label_id", "predicted_class", "confidence_score"]
    kept = materialise(scored.select(*columns, *(["split"] if split != "all" else [])))
    labelled = labelled_rows(kept)
    if split != "all":
        labelled = labelled.filter(labelled["split"] == split)
    known = small_side(classes)
    cm = materialise(M.confusion(labelled))
    unlabelled = unlabelled_rows(kept)
    return Evaluation(
        scored=kept,
        confusion=M.confusion_dense(cm, known),
        normalized=M.confusion_normalized(cm, known),
        report=M.class_report(cm, known),
        ranking=M.recall_ranking(cm, known),
        summary=M.confusion_summary(cm, known),
        macro=M.macro_metrics(cm),
        confidence=M.confidence_stats(kept),
        distribution=M.prediction_distribution(unlabelled, known),
        samples=M.sample_predictions(unlabelled, known, key),
    )
