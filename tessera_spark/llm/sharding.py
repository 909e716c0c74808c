"""Sharding by sampled splitters. DataFrame functions only; the law is ``bytes``.

Rows are ordered by (CRC-32 of the text, doc_id), so equal texts lie side by side. A sample of keys,
drawn with a chance in proportion to size, gives quantile boundaries; rows are dealt into the ranges
between them, and a range that holds more than twice its share is cut again by keys sampled inside
it, until only rows of one key are left in a range of that kind. Exact sums per range then place
each range on the line of all bytes, and running sums inside a range place each row on it. The line
is cut into equal parts, so shards differ by at most one row's size, and a group of copies of any
size is split where a boundary falls.

The driver holds the splitters: at most ``SAMPLE`` expected keys per round. The number of rounds
follows the ranges that are still too full, not the rows.

Defined results: a null text has size 1 and the CRC of the empty text; a null id comes first in its
group; rows that repeat an id and a text are neighbours and get slots of their own; an empty table
gives an empty result. Only the named columns are read; the caller's columns travel below one
struct.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera_spark.llm import common

SHARDS = 16
RANGES = 1024
SAMPLE = 16 * RANGES
KEY = ("text_crc32", "doc_id")
#: Where a null id stands among the splitters.
LEAST = 1 - (1 << 63)


def _chance(seed: int) -> Column:
    """A number in [0, 1) per row, the same in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), *KEY, "size"), F.lit(1 << 40)) / float(1 << 40)


def _boundaries(rows, total: int, ranges: int) -> list[tuple]:
    """Quantile boundaries of sampled (key, size) rows. A row that is larger than the sampling step
    was drawn for certain and weighs its size; any other stands for one step."""
    step = max(total / SAMPLE, 1.0)
    keys, weight, cut = [], 0.0, 1
    whole = sum(max(r["size"], step) for r in rows)
    for r in rows:
        weight += max(r["size"], step)
        if weight * ranges >= cut * whole:
            keys.append((r["text_crc32"], r["doc_id"]))
            cut = math.floor(weight * ranges / whole) + 1
    return sorted(set(keys), key=_order)


def _order(key: tuple) -> tuple:
    return key[0], key[1] is not None, key[1] or 0


def _sampled(sized: DataFrame, total: int, seed: int) -> list:
    drawn = sized.filter(_chance(seed) < F.col("size") * SAMPLE / F.lit(float(total)))
    return sorted(drawn.select(*KEY, "size").collect(), key=lambda r: _order((r["text_crc32"], r["doc_id"])))


def _constant(values) -> str:
    """SQL text of a constant array of whole numbers."""
    return "array(" + ",".join(f"{v}L" for v in values) + ")"


def _range_of(splitters: list[tuple]) -> Column:
    """Number of splitters below the row's key, by halving two constant arrays."""
    n = len(splitters)
    if not n:
        return F.lit(0)
    crc, own = (f"get({_constant(values)}, at + step - 1)" for values in zip(*((c, LEAST if i is None else i) for c, i in splitters), strict=True))
    below = f"{crc} < text_crc32 or ({crc} = text_crc32 and {own} < coalesce(doc_id, {LEAST}L))"
    steps = ",".join(str(1 << k) for k in reversed(range(n.bit_length())))
    return F.expr(f"aggregate(array({steps}), 0, (at, step) -> if(at + step <= {n} and ({below}), at + step, at))")


def range_splitters(sized: DataFrame, ranges: int = RANGES, seed: int = 5) -> tuple[list[tuple], list]:
    """Splitters, and (range, rows, bytes, keys) of each range, after cutting overfull ranges."""
    total = sized.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [], []
    splitters = _boundaries(_sampled(sized, total, seed), total, ranges)
    share = 2 * total / ranges
    while True:
        inside = sized.withColumn("range", _range_of(splitters))
        sums = inside.groupBy("range").agg(
            F.count("*").alias("rows"),
            F.sum("size").alias("bytes"),
            F.min(F.struct(*KEY)).alias("low"),
            F.max(F.struct(*KEY)).alias("high"),
        ).collect()
        full = [r for r in sums if r["bytes"] > share and r["low"] != r["high"]]
        if not full:
            return splitters, sorted(sums, key=lambda r: r["range"])
        seed += 1
        for_range = F.col("range").isin([r["range"] for r in full])
        left = sum(r["bytes"] for r in full)
        drawn = _sampled(inside.filter(for_range), left, seed)
        more = _boundaries(drawn, left, max(2, math.ceil(2 * left / share)))
        # The smallest key of a range always cuts off something, so that every round gets further.
        more += [tuple(r["low"]) for r in full]
        splitters = sorted(set(splitters) | set(more), key=_order)


def shard(
    docs: DataFrame,
    *,
    shards: int = SHARDS,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: bool = False,
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, one row per input row; with ``carry`` the input row
    besides, as the struct ``row``."""
    common.prepared(docs.sparkSession)
    content = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        *([F.struct("*").alias("row")] if carry else []),
    )
    narrow = common.stored(sized.drop("row"), "shard-keys")
    splitters, sums = range_splitters(narrow)
    total = sum(r["bytes"] for r in sums)
    bytes_before, offsets = 0, {}
    for r in sums:
        offsets[r["range"]] = bytes_before
        bytes_before += r["bytes"]
    ranges = len(splitters) + 1
    before = F.expr(_constant(offsets.get(k, 0) for k in range(ranges)))

    rows = (sized if carry else narrow).withColumn("range", _range_of(splitters))
    order = Window.partitionBy("range").orderBy(*KEY, "size")
    ahead = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("start", F.get(before, F.col("range")) + ahead)
    # A row belongs to the part of the line that holds its middle; whole numbers only.
    rows = rows.withColumn("shard", F.expr(f"cast((2 * start + size) * {shards} div {max(2 * total, 1)} as int)"))
    rows = common.stored(rows, "shard-rows")
    # Slots: rows of the shard in earlier ranges, then the place in the own range.
    counts = sorted(rows.groupBy("range", "shard").count().collect(), key=lambda r: (r["shard"], r["range"]))
    first, seen = {}, {}
    for r in counts:
        first[(r["range"], r["shard"])] = seen.get(r["shard"], 0)
        seen[r["shard"]] = seen.get(r["shard"], 0) + r["count"]
    # A range lies in few shards; its shards are numbered from its lowest.
    low = {}
    for k, s in first:
        low[k] = min(s, low.get(k, s))
    width = max([s - low[k] + 1 for k, s in first], default=1)
    slots = F.expr(_constant(first.get((k, low.get(k, 0) + j), 0) for k in range(ranges) for j in range(width)))
    lows = F.expr(_constant(low.get(k, 0) for k in range(ranges)))
    inner = F.row_number().over(Window.partitionBy("range", "shard").orderBy("start"))
    at = F.get(slots, (F.col("range") * width + F.col("shard") - F.get(lows, F.col("range"))).cast("int"))
    rows = rows.withColumn("slot", at + inner - 1)
    return rows.select("doc_id", "size", "text_crc32", "shard", "slot", *(["row"] if carry else []))


def digest(sharded: DataFrame) -> DataFrame:
    """The contract's columns; a law by size says nothing of one more shard."""
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
