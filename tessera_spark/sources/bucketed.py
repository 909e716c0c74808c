"""Tables kept in buckets of their key, so that joins on it do not move rows.

Manifest and vectors are written once, each dealt to the same number of buckets by a hash of
``embedding_index``, one sorted file per bucket. A join of two such tables reads bucket against
bucket: Spark plans no exchange above either scan. Number of buckets and columns are written beside
the rows, so another session can open the folder; the name in its catalog is its own.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

KEY = "embedding_index"
# Rows of one bucket; a vector has some kilobytes.
BUCKET_ROWS = 1 << 16
_LAYOUT = "_layout"


def buckets_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return max(1, -(-rows // bucket_rows))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_bucketed(df: DataFrame, path: str, buckets: int, key: str = KEY) -> None:
    """Write a new folder. The rows are shuffled here, and in no later join on the key."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the folder stays: it belongs to the caller
    layout = [(key, buckets, df.schema.json())]
    spark.createDataFrame(layout, "key string, buckets int, columns string").coalesce(1).write.json(f"{path}/{_LAYOUT}")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """Open a folder that ``write_bucketed`` wrote, in this or another session."""
    layout = spark.read.schema("key string, buckets int, columns string").json(f"{path}/{_LAYOUT}").first()
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = StructType.fromJson(json.loads(layout["columns"]))
    listed = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in columns.fields)
    key, place = _quoted(layout["key"]), path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({listed}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {layout['buckets']} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def attach_bucketed(manifest: DataFrame, embeddings: DataFrame, key: str = KEY) -> DataFrame:
    """``manifest.attach_embeddings`` for two tables in the same buckets: bucket against bucket, and
    never by sending one of them to all."""
    return manifest.join(embeddings.select(key, "embedding").hint("merge"), key)
