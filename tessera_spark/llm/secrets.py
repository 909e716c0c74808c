"""Secret scan with corpus-wide ownership frequency.

Every text is searched once for candidates. The SHA-256 of each candidate's value is then counted
over the whole corpus by distinct owners and distinct repositories: a value that many owners carry
is a copied example, a value of one owner that looks random is taken for a live credential.

Defined results: a null text is empty; a null owner or repository counts as one of its own name
(the empty string); repeated rows are scanned and returned each on its own; values equal in kind
and text are one value; an empty table gives an empty result. Only the named columns are read, so
extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera_spark.llm import common

# The kinds of the contract, in its order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is found whole, shorter ones never
#: The kind that this method adds: long mixed runs outside the other spans.
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{32,}")
KINDS = ("assign", "access", "hex", "opaque")

CANDIDATE = "struct<kind:int,start:int,stop:int,value:string,random:boolean>"
SCANNED = f"row_id long, doc_id long, owner string, repository string, found array<{CANDIDATE}>"


def looks_random(value: str) -> bool:
    """At least three bits a character, and both letters and digits."""
    if not (re.search(r"[0-9]", value) and re.search(r"[A-Za-z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= 3.0


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, stop, value) of one text, by start and kind; offsets are code points."""
    found = [
        (0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8
    ]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    base = sorted((start, stop) for _, start, stop, _ in found)
    for m in OPAQUE.finditer(text):
        taken = any(start < m.end() and m.start() < stop for start, stop in base)
        if not taken and looks_random(m[0]):
            found.append((3, m.start(), m.end(), m[0]))
    return sorted(found, key=lambda x: (x[1], x[0]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct(
            [("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string()), ("random", pa.bool_())]
        )
    )
    for batch in batches:
        rows = [
            [
                {"kind": k, "start": a, "stop": b, "value": hashlib.sha256(v.encode()).hexdigest(), "random": looks_random(v)}
                for k, a, b, v in candidates(text or "")
            ]
            for text in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("row_id", "doc_id", "owner", "repository")), pa.array(rows, kind)],
            ["row_id", "doc_id", "owner", "repository", "found"],
        )


def ownership(scanned: DataFrame) -> DataFrame:
    """value, owners, repositories: over all candidates of the corpus. Combined before each
    shuffle, so a value that a third of all rows carries arrives as one row per task."""
    each = scanned.select("owner", "repository", F.explode("found.value").alias("value"))
    pairs = each.groupBy("value", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = pairs.groupBy("value", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return by_owner.groupBy("value").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("uses")
    )


def scan_secrets(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: Column | None = None,
    example_owners: int = 2,
) -> DataFrame:
    """One row per input row: doc_id and ``found``, its candidates with the number of owners and
    repositories of each value and a ``verdict``: ``example`` from ``example_owners`` owners on,
    ``live`` for a random-looking value of fewer, else ``weak``. Opaque runs are kept only when
    live."""
    common.prepared(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce((repository if repository is not None else F.col(owner)).cast("string"), F.lit("")).alias("repository"),
        F.col(text).alias("text"),
    )
    scanned = common.stored(rows.mapInArrow(_scan, SCANNED), "secrets")
    counts = ownership(scanned)
    each = scanned.filter(F.size("found") > 0).select("row_id", F.explode("found").alias("c"))
    judged = each.join(counts, F.col("c.value") == counts.value).select(
        "row_id",
        F.struct(
            F.col("c.start").alias("start"),
            F.col("c.kind").alias("kind"),
            F.col("c.stop").alias("stop"),
            F.col("c.value").alias("value"),
            "owners",
            "repositories",
            "uses",
            F.when(F.col("owners") >= example_owners, "example").when(F.col("c.random"), "live").otherwise("weak").alias("verdict"),
        ).alias("c"),
    )
    judged = judged.filter((F.col("c.kind") < 3) | (F.col("c.verdict") == "live"))
    by_row = judged.groupBy("row_id").agg(F.array_sort(F.collect_list("c")).alias("found"))
    with_some = scanned.filter(F.size("found") > 0).select("row_id", "doc_id").join(by_row, "row_id", "left")
    none = scanned.filter(F.size("found") == 0).select("row_id", "doc_id", F.lit(None).cast(by_row.schema["found"].dataType).alias("found"))
    every = with_some.unionByName(none)
    return every.select("doc_id", F.coalesce("found", F.filter("found", lambda c: F.lit(False)), F.array().cast(by_row.schema["found"].dataType)).alias("found"))


def spans_text(found: Column) -> Column:
    """kind:start:stop of candidates, comma-joined in their order."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            found,
            lambda c: F.concat_ws(":", F.element_at(names, c["kind"] + 1), c["start"].cast("string"), c["stop"].cast("string")),
        ),
        ",",
    )


def digest(secrets: DataFrame) -> DataFrame:
    """The contract's columns from the result of ``scan_secrets``."""
    def count(test) -> Column:
        return F.size(F.filter("found", test)).cast("long")

    base = F.filter("found", lambda c: c["kind"] < 3)
    return secrets.select(
        "doc_id",
        count(lambda c: c["kind"] == 0).alias("n_assign"),
        count(lambda c: c["kind"] == 1).alias("n_access"),
        count(lambda c: c["kind"] == 2).alias("n_hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
        count(lambda c: c["verdict"] == "live").alias("n_live"),
        count(lambda c: c["verdict"] == "example").alias("n_example"),
    )
