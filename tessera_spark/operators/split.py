"""Reproducible splits and samples.

Rows are ordered by the md5 of seed and key. The split needs one threshold per class, not the
rank of every row: bucket counts of the leading digits (combined before the shuffle) locate
the bucket that holds the quota-th row, only rows of that bucket are ranked, and the final
result is a comparison against a class-sized table. The rows themselves are never shuffled,
however large a class is.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera_spark.operators.labels import dense_classes
from tessera_spark.operators.numbering import hash_bucket, order_hash, rank_in_group
from tessera_spark.session import settle, small_side

VALIDATION_SHARE = 0.25
SEED = 42
# A boundary bucket above this size is cut again by its next digits before rows are ranked.
_DIGITS_PER_LEVEL = 3
_MAX_DIGITS = 24
EXACT_ROWS = 1_000_000


def class_quotas(counts: DataFrame, share: float = VALIDATION_SHARE) -> DataFrame:
    """Validation rows per class from ``(label_id, n)``: ceil(share * total) spread by largest
    remainder, ties to the lower class id. Works on one row per class; every row also carries
    the totals that decide whether a stratified split is possible."""
    everything = W.partitionBy()
    base = (
        counts.withColumn("_total", F.sum("n").over(everything))
        .withColumn("_val", F.ceil(F.lit(share) * F.col("_total")))
        # Exact integers: the product of two row counts may pass 64 bits.
        .withColumn("_exact", F.expr("cast(_val as decimal(19,0)) * cast(n as decimal(19,0))"))
        .withColumn("_whole", F.expr("_exact div cast(_total as decimal(19,0))"))
        .withColumn("_rest", F.expr("_exact % cast(_total as decimal(19,0))"))
        .withColumn("_left", F.col("_val") - F.sum("_whole").over(everything))
        .withColumn(
            "_place", F.row_number().over(W.orderBy(F.col("_rest").desc(), F.col("label_id")))
        )
    )
    extra = F.when(F.col("_place") <= F.col("_left"), 1).otherwise(0)
    return base.select(
        "label_id",
        (F.col("_whole") + extra).alias("quota"),
        F.col("_total").alias("total"),
        F.col("_val").alias("val"),
        F.count(F.lit(1)).over(everything).alias("k"),
        F.min("n").over(everything).alias("smallest"),
        F.max("n").over(everything).alias("largest"),
    )


def _thresholds(hashed: DataFrame, group: str, quotas: DataFrame, largest: int) -> DataFrame:
    """``(group, threshold)``: the quota-th smallest digest of each group, by radix
    selection. ``quotas`` holds one row per group with ``quota`` between 1 and its rows, of
    which the largest group has ``largest``."""
    wanted = quotas.select(group, F.lit("").alias("_prefix"), F.col("quota").alias("_want"))
    inside, digits = hashed.select(group, "_digest"), 0
    # At least one round of counting, so that no class is ever ranked as a whole.
    while digits == 0 or (largest > EXACT_ROWS and digits < _MAX_DIGITS):
        digits += _DIGITS_PER_LEVEL
        counts = inside.groupBy(group, F.left("_digest", F.lit(digits)).alias("_bucket")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        upto = F.sum("_n").over(W.partitionBy(group).orderBy("_bucket"))
        crossing, _ = settle(
            counts.withColumn("_upto", upto)
            .join(wanted.select(group, "_want"), group)
            .filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
            .select(
                group,
                F.col("_bucket").alias("_prefix"),
                (F.col("_want") - (F.col("_upto") - F.col("_n"))).alias("_want"),
                "_n",
            )
        )
        largest = crossing.agg(F.max("_n")).first()[0] or 0
        wanted = crossing.drop("_n")
        inside = (
            hashed.select(group, "_digest")
            .join(wanted.select(group, "_prefix"), group)
            .filter(F.col("_digest").startswith(F.col("_prefix")))
            .drop("_prefix")
        )
    place = F.row_number().over(W.partitionBy(group).orderBy("_digest"))
    return (
        inside.withColumn("_place", place)
        .join(wanted.select(group, "_want"), group)
        .filter(F.col("_place") == F.col("_want"))
        .select(group, F.col("_digest").alias("_threshold"))
    )


def _apply(hashed: DataFrame, group: str, quotas: DataFrame, largest: int) -> DataFrame:
    limits = small_side(_thresholds(hashed, group, quotas.filter(F.col("quota") > 0), largest))
    chosen = F.coalesce(F.col("_digest") <= F.col("_threshold"), F.lit(False))
    return (
        hashed.join(limits, group, "left")
        .withColumn("split", F.when(chosen, "val").otherwise("train"))
        .drop("_digest", "_threshold")
    )


def random_split(
    df: DataFrame, key: str, share: float = VALIDATION_SHARE, seed: int = SEED
) -> DataFrame:
    """Exact unstratified split: the ceil(share * n) rows first in md5 order validate. ``key``
    must be unique."""
    hashed = df.withColumn("_digest", order_hash(seed, F.col(key))).withColumn("_all", F.lit(0))
    total = hashed.count()
    quota = hashed.sparkSession.range(1).select(
        F.lit(0).alias("_all"), F.lit(math.ceil(share * total)).alias("quota")
    )
    return _apply(hashed, "_all", quota, total).drop("_all")


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = "label_id",
    share: float = VALIDATION_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Add ``split`` ('train' or 'val') with class shares kept, and ``stratified``. When a
    class has a single row, or one side has fewer rows than there are classes, the split is
    random and ``stratified`` is false. Rows without a label belong to no class and are left
    out. ``key`` must be unique."""
    df = df.filter(F.col(label).isNotNull())
    counts = df.groupBy(F.col(label).alias("label_id")).agg(F.count(F.lit(1)).alias("n"))
    quotas, _ = settle(class_quotas(settle(counts)[0], share))
    facts = quotas.first()
    if facts is None:
        return df.withColumn("split", F.lit("train")).withColumn("stratified", F.lit(True))
    possible = (
        facts["smallest"] >= 2
        and facts["val"] >= facts["k"]
        and facts["total"] - facts["val"] >= facts["k"]
    )
    if not possible:
        return random_split(df, key, share, seed).withColumn("stratified", F.lit(False))
    hashed = df.withColumn("_digest", order_hash(seed, F.col(key)))
    wanted = quotas.select(F.col("label_id").alias(label), "quota")
    split = _apply(hashed, label, wanted, facts["largest"])
    return split.withColumn("stratified", F.lit(True))


def stratified_rank(df: DataFrame, key: str, label: str = "label_id", seed: int = SEED) -> DataFrame:
    """0-based place of every row in the md5 order of its class."""
    hashed = df.withColumn("_digest", order_hash(seed, F.col(key)))
    digest = F.col("_digest")
    return rank_in_group(hashed, [label], [digest, F.col(key)], hash_bucket(digest), "rank").drop("_digest")


def sample_rows(df: DataFrame, key: str, n: int = 8, seed: int = SEED) -> DataFrame:
    """Up to ``n`` rows without replacement, first in md5 order: a top-k per partition, never
    a full sort."""
    return df.orderBy(order_hash(seed, F.col(key)), F.col(key)).limit(n)


def sample_validation(split: DataFrame, key: str, n: int = 10, seed: int = SEED) -> DataFrame:
    return sample_rows(split.filter(F.col("split") == "val"), key, n, seed)


def sample_info(rows: DataFrame, sample: DataFrame, key: str = "embedding_index") -> DataFrame:
    """Full rows of sampled keys."""
    return rows.join(small_side(sample.select(key)), key, "left_semi")


def class_counts(df: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows per class, zeros kept."""
    counts = df.groupBy("label_id").agg(F.count(F.lit(1)).alias("n"))
    return dense_classes(counts, classes)


def split_counts(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Labelled and unlabelled rows, classes and vector length."""
    labelled = F.col("label_id") >= 0
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(labelled).alias("labelled"),
        F.count_if(F.col("label_id") == -1).alias("unlabelled"),
        F.coalesce(F.max(F.when(labelled, F.col("label_id"))) + 1, F.lit(0)).alias("num_classes"),
        F.max(F.size(vector)).alias("input_size"),
    )
