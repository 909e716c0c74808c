"""Threshold bands and status words of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds of the bands, best first.
F1_BANDS = ((0.8, "Excellent"), (0.6, "Good"), (0.3, "Fair"))
RECALL_BANDS = ((0.9, "Excellent"), (0.7, "Good"), (0.5, "Fair"))
CONFIDENCE_BANDS = ((0.7, "High"), (0.4, "Medium"))

# Stage words and the stage a run starts from.
STAGE_START = {"needs_csv": "csv", "needs_embeddings": "embeddings", "ready_to_train": "train"}


def _band(value: Column, bands, lowest: str) -> Column:
    out = None
    for bound, name in bands:
        out = F.when(value >= bound, name) if out is None else out.when(value >= bound, name)
    return out.otherwise(lowest)


def f1_band(f1: Column) -> Column:
    return _band(f1, F1_BANDS, "Poor")


def recall_band(recall: Column) -> Column:
    return _band(recall, RECALL_BANDS, "Poor")


def confidence_band(confidence: Column) -> Column:
    return _band(confidence, CONFIDENCE_BANDS, "Low")


def verdict(predicted: Column, actual: Column) -> Column:
    return F.when(predicted == actual, "CORRECT").otherwise("WRONG")


def stage_of(has_csv: Column, has_embeddings: Column, has_model: Column) -> Column:
    """First missing artefact decides."""
    return (
        F.when(~has_csv, "needs_csv")
        .when(~has_embeddings, "needs_embeddings")
        .when(~has_model, "ready_to_train")
        .otherwise("trained")
    )


def start_stage(stage: Column) -> Column:
    """Stage to start from; null for a trained dataset."""
    out = None
    for name, start in STAGE_START.items():
        out = F.when(stage == name, start) if out is None else out.when(stage == name, start)
    return out


def loss_flag(train_loss: Column, val_loss: Column) -> Column:
    return (
        F.when((val_loss > 0) & (train_loss > val_loss), "DOWN")
        .when(val_loss > 0, "UP")
        .otherwise("WAIT")
    )


def accuracy_flag(val_acc: Column) -> Column:
    return F.when(val_acc > 0.8, "GOOD").when(val_acc > 0.5, "OK").otherwise("TRAIN")


def f1_flag(val_f1: Column) -> Column:
    return F.when(val_f1 > 0.8, "GREAT").when(val_f1 > 0.5, "GOOD").otherwise("TRAIN")
