"""Raw listing to manifest, and the augmented manifest with stable row keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.functions import paths as P
from tessera_spark.operators.labels import encode_labels, first_appearance_ids
from tessera_spark.operators.numbering import integer_bucket, number_by_range, rank_in_group
from tessera_spark.schemas import AUGMENTED_MANIFEST, MANIFEST

_ORDER = ["_source", "_folder", "path"]


def _with_branch(files: DataFrame, root: str) -> DataFrame:
    return files.withColumn("_folder", P.folder_of(F.col("path"), root)).withColumn(
        "_source", P.source_of(F.col("_folder"))
    )


def classify_files(files: DataFrame, root: str) -> DataFrame:
    """Tag each listed file with its branch and folder. One scan stands for the union of the
    three listings (label folders, root, test folder); deeper files are left out. The filter
    is one pattern on the path itself: a filter on the derived columns would be pushed below
    them and derive each again."""
    return _with_branch(files.filter(P.is_listed(F.col("path"), root)), root)


def union_sources(labelled: DataFrame, in_root: DataFrame, in_test: DataFrame) -> DataFrame:
    """Three separate listings as one, in branch order, when they do not share a root."""
    branches = ((labelled, P.FROM_LABEL), (in_root, P.FROM_ROOT), (in_test, P.FROM_TEST_FOLDER))
    tagged = [df.withColumn("_source", F.lit(ordinal)) for df, ordinal in branches]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def number_files(files: DataFrame, root: str) -> DataFrame:
    """Add ``index`` (position in its folder) and ``position`` (over all kept files).

    Label folders and the root count images only. The test folder counts every file, so a
    file that is no image leaves a gap in the numbering there.
    """
    counted = files.select("path").filter(P.is_counted(F.col("path"), root))
    numbered = number_by_range(
        _with_branch(counted, root), _ORDER, ["_source", "_folder"], "position", "index"
    )
    return numbered.filter(P.is_image(F.col("path")))


def name_files(numbered: DataFrame, output_root: str, images_per_class: int | None = None) -> DataFrame:
    """Normalised names and labels. With a limit, images of a label at or past it move to the
    unlabelled set; None and 0 mean no limit."""
    if images_per_class:
        overflow = (F.col("_source") == P.FROM_LABEL) & (F.col("index") >= images_per_class)
    else:
        overflow = F.lit(False)
    named = numbered.withColumn("is_overflow", overflow).withColumn(
        "image_name",
        P.normalized_name(F.col("_source"), F.col("_folder"), F.col("index"), F.col("is_overflow")),
    )
    labelled = (F.col("_source") == P.FROM_LABEL) & ~F.col("is_overflow")
    folder = F.when(labelled, F.col("_folder")).otherwise(P.TEST_FOLDER)
    return named.select(
        F.concat_ws("/", F.lit(output_root.rstrip("/")), folder, F.col("image_name")).alias("image_path"),
        "image_name",
        F.when(labelled, F.col("_folder")).otherwise(P.TEST_LABEL).alias("label_name"),
        (~labelled).alias("is_test"),
        F.col("path").alias("original_path"),
        F.when(F.col("_source") == P.FROM_LABEL, F.col("_folder")).alias("raw_label"),
        "is_overflow",
        "index",
        "position",
    )


def drop_failed(df: DataFrame, failed: DataFrame, key: str = "original_path") -> DataFrame:
    """Leave out rows whose image could not be processed; names keep their gaps."""
    return df.join(failed.select(key), key, "left_anti")


def build_manifest(
    files: DataFrame,
    root: str,
    output_root: str,
    images_per_class: int | None = None,
    failed: DataFrame | None = None,
) -> DataFrame:
    """Listing to manifest, with the columns of ``schemas.MANIFEST`` plus ``position``, the
    row order of the manifest."""
    named = name_files(number_files(files, root), output_root, images_per_class)
    if failed is not None:
        named = drop_failed(named, failed)
    encoded = encode_labels(named, first_appearance_ids(named))
    return encoded.withColumn("label_prediction", F.lit(None).cast("int")).select(
        *MANIFEST.fieldNames(), "position"
    )


def moved_to_test(named: DataFrame) -> DataFrame:
    """Images per label that the limit moved away, labels without any left out."""
    return (
        named.filter(F.col("raw_label").isNotNull())
        .groupBy("raw_label")
        .agg(F.count_if("is_overflow").alias("moved"))
        .filter(F.col("moved") > 0)
    )


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Rows, train rows, test rows and number of labels, in one pass: rows are first combined
    per (label, flag), so the distinct count never expands the input."""
    per_label = manifest.groupBy("label_name", "is_test").agg(F.count(F.lit(1)).alias("n"))
    label = F.when(F.col("label_name") != P.TEST_LABEL, F.col("label_name"))
    return per_label.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(~F.col("is_test"), F.col("n"))), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum(F.when(F.col("is_test"), F.col("n"))), F.lit(0)).alias("test_rows"),
        F.count_distinct(label).alias("labels"),
    )


def train_rows(manifest: DataFrame) -> DataFrame:
    return manifest.filter(~F.col("is_test"))


def test_rows(manifest: DataFrame) -> DataFrame:
    return manifest.filter("is_test")


def labelled_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label_id") >= 0)


def unlabelled_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label_id") == P.TEST_LABEL_ID)


def info_columns(df: DataFrame) -> DataFrame:
    return df.select("image_path", "image_name", "label_name", "label_id")


def augment_fanout(manifest: DataFrame, copies: int = 0, position: str = "position") -> DataFrame:
    """Originals and ``copies`` variants of every row, with ``aug_version`` and
    ``embedding_index``: originals take 0..n-1 in manifest order, the variants of row i follow
    as n + i * copies + (version - 1). One generator, no union and no second numbering."""
    key = F.col(position)
    dense = rank_in_group(manifest, [], [key], integer_bucket(key), "_original")
    total = manifest.count() if copies else 0
    version = F.col("aug_version")
    index = F.when(version == 0, F.col("_original")).otherwise(
        F.lit(total) + F.col("_original") * copies + version - 1
    )
    return (
        dense.withColumn("aug_version", F.explode(F.sequence(F.lit(0), F.lit(copies))))
        .withColumn("embedding_index", index.cast("long"))
        .withColumn("image_path", P.normalise_path(F.col("image_path")))
        .select(*AUGMENTED_MANIFEST.fieldNames())
    )


def attach_embeddings(manifest: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Vector of each manifest row by key; rows without a partner show in
    ``checks.positional_check``."""
    return manifest.join(embeddings.select("embedding_index", "embedding"), "embedding_index")


def missing_files(manifest: DataFrame, files: DataFrame, key: str = "image_path") -> DataFrame:
    """Manifest rows whose file is not listed."""
    return manifest.join(files.select(F.col("path").alias(key)), key, "left_anti")


def existing_files(manifest: DataFrame, files: DataFrame, key: str = "image_path") -> DataFrame:
    return manifest.join(files.select(F.col("path").alias(key)), key, "left_semi")


def with_normalized_paths(images: DataFrame, manifest: DataFrame) -> DataFrame:
    """Images under the names of the manifest instead of their raw paths; images that it does not
    list, such as broken ones, are left out."""
    names = manifest.select(P.strip_scheme(F.col("original_path")).alias("_plain"), F.col("image_path").alias("_name"))
    found = images.withColumn("_plain", P.strip_scheme(F.col("image_path"))).join(names, "_plain")
    return found.withColumn("image_path", F.col("_name")).drop("_plain", "_name")


def with_embedding_index(images: DataFrame, augmented: DataFrame) -> DataFrame:
    """``embedding_index`` for rows keyed by normalised ``image_path`` and, where they have it,
    ``aug_version``; without it they are originals."""
    version = F.col("aug_version") if "aug_version" in images.columns else F.lit(0)
    keyed = images.withColumn("_path", P.normalise_path(F.col("image_path"))).withColumn("_version", version)
    index = augmented.select(F.col("image_path").alias("_path"), F.col("aug_version").alias("_version"), "embedding_index")
    return keyed.join(index, ["_path", "_version"]).drop("_path", "_version")
