"""A corpus from raw documents to shards: five stages, each one operator of tessera_spark.llm.

Each stage takes all rows its predecessor kept and returns the columns of ``documents`` (the last one
adds shard and slot); ``run`` writes every stage's rows as Parquet into the shared folder and reads
them again. A stage with no rows hands none on. Columns that documents have besides are carried
through unread, whatever their names; only ``shard`` and ``slot`` are replaced by the last stage's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera_spark.llm import common, decontaminate, jaccard_join, mixing, quality, sharding


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.quality_rules(docs, common.table(spark, sf_dir, "labels"), carry=True)
    return judged.filter("kept").select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return jaccard_join.one_of_each_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    taken = mixing.mix(docs, carry=True).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their place in it, in place of columns that have these names."""
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("shard", "slot")]
    return sharding.shard(docs, carry=True).select(*own, "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

#: The first stage fits a model, which SQL cannot express; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    common.prepared(spark)
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
