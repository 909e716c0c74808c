"""Connected components of a table of links, by joins only.

Each round hooks every node to its smallest neighbour, follows the hooks to their roots by repeated
doubling and joins the roots' links. All tables of a round are written to the shared folder, so a
lost executor costs one step. A node with very many links is only ever grouped (combined before the
shuffle) or joined on a side that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.llm.common import stored


def _roots(hooks: DataFrame) -> DataFrame:
    """Follow node -> parent to the end; parents are never above their node."""
    while True:
        up = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        jumped = stored(hooks.join(up, "parent").select("node", F.col("next").alias("parent"), (F.col("next") != F.col("parent")).alias("moved")), "roots")
        if jumped.filter("moved").isEmpty():
            return jumped.drop("moved")
        hooks = jumped.drop("moved")


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of links(a, b); the root is a node of its component. Links may
    repeat, in either direction; a link of a node with itself only names the node."""
    links = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    known: DataFrame | None = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        hooks = stored(hooks.select("node", F.least("node", "parent").alias("parent")), "hooks")
        roots = _roots(hooks)
        if known is None:
            known = roots.withColumnRenamed("parent", "root")
        else:
            later = roots.select(F.col("node").alias("root"), "parent")
            known = stored(known.join(later, "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "known")
        at_a = roots.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        at_b = roots.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        merged = links.join(at_a, "a").join(at_b, "b").filter("ra <> rb")
        links = stored(merged.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if links.isEmpty():
            return known
