"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Every document of a source is expected ``target / size of the source`` times (or, with weights, in
proportion to its weight). The whole copies in that number are certain. What is left over is an
inclusion probability p; documents are ranked by random odds over inclusion odds,
``(u / (1 - u)) / (p / (1 - p))``, and the source takes them in this order until its words are
full. The random number u is a hash of the seed and the document's id, so reruns agree.

No source is sorted in one task: the rank is mapped into (0, 1) and cut into ``CELLS`` cells twice
over; sums per cell, combined before the shuffle, tell which cells are taken whole, and only the
rows of each source's boundary cell are ranked.

Defined results: a null text has size 0 and is taken in no words; a null source is a source of its
own, last in order; a null id draws as the empty string; of rows that repeat an id and a size
exactly as many are taken as fit; a very long text counts by its words; a source of size 0 has target 0; an empty table gives an empty
result. Only the named columns are read, and the caller's columns travel below one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera_spark.llm import common

CELLS = 1024
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_COPIES = 2
#: Random numbers are the leading 52 bits of an MD5, exact as doubles.
DRAW_BITS = 52


def random_unit(seed: int, key: Column) -> Column:
    """A number in (0, 1), a function of the seed and the key."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("double") + 0.5) / float(1 << DRAW_BITS)


def source_targets(
    sizes: DataFrame,
    *,
    weights: tuple[int, ...] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    most_copies: int = MOST_COPIES,
) -> DataFrame:
    """Adds ``target`` to a table with (source, source_size), one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn. A target is the weight times
    a common level, or the limit if that is lower; the level is the one at which the targets fill
    the share, which is where sharing out the excess again and again ends. The table has one row
    per source; these windows over it are the only step without a partition.
    """
    binary = F.encode(F.col("source"), "UTF-8")
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), binary))
    turn = (place - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    each = sizes.withColumn("weight", weight.cast("double")).withColumn("most", (F.col("source_size") * most_copies).cast("double"))
    limit = F.col("most") / F.col("weight")  # weights are constants above 0
    by_level = Window.orderBy(limit, F.col("source").isNull(), binary)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * share_percent / F.lit(100.0)
    # The level if this source and all of a higher limit were the ones below their limits.
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (budget - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / open_weight
    tried = each.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= F.col("most"))
    # The first source in order of its limit that stays below it fixes the level for all after it.
    first = F.min(F.when(F.col("free"), F.struct(limit.alias("limit"), F.col("source").isNull().alias("none"), binary.alias("name"), "level")))
    final = first.over(everything)["level"]
    return tried.withColumn("target", F.least("most", F.coalesce(final * F.col("weight"), F.col("most")))).drop("weight", "most", "level", "free")


def _first_not_whole(rows: DataFrame, cell: str) -> DataFrame:
    """Per source the first cell that does not fit whole, and the room left for it. Sums are
    combined before the shuffle, and a source has at most CELLS of them."""
    sums = rows.groupBy("source", "room", cell).agg(F.sum("size").alias("cell_size"))
    order = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("cell_size").over(order), F.lit(0)))
    over = sums.filter(F.col("before") + F.col("cell_size") > F.col("room"))
    first = over.groupBy("source").agg(F.min(F.struct(cell, (F.col("room") - F.col("before")).alias("left"))).alias("m"))
    return first.select(F.col("source").alias("key"), F.col(f"m.{cell}").alias(f"edge_{cell}"), F.col("m.left").alias("left"))


def _with_source(rows: DataFrame, per_source: DataFrame, how: str = "left") -> DataFrame:
    return rows.join(common.small_or_plain(per_source), F.col("source").eqNullSafe(F.col("key")), how).drop("key")


def _place(rows: DataFrame, seed: int, most_copies: int) -> DataFrame:
    """Certain copies and the place of each row in its source's order. q / (1 + q) keeps the order
    of the odds and lies in (0, 1)."""
    expected = F.when(F.col("mass") > 0, F.least(F.lit(float(most_copies)), F.col("target") * F.col("w") / F.col("mass"))).otherwise(0.0)
    u = random_unit(seed, F.col("doc_id"))
    rows = rows.withColumn("expected", expected).withColumn("certain", F.floor("expected")).withColumn("p", F.col("expected") - F.col("certain"))
    rows = rows.withColumn("q", (u / (1 - u)) * F.try_divide(1 - F.col("p"), F.col("p")))
    rows = rows.withColumn("rank", F.when(F.col("p") > 0, F.col("q") / (1 + F.col("q"))).otherwise(1.0))
    scaled = F.col("rank") * CELLS
    rows = rows.withColumn("cell", F.least(F.floor(scaled), F.lit(CELLS - 1)))
    return rows.withColumn("fine", F.least(F.floor((scaled - F.col("cell")) * CELLS), F.lit(CELLS - 1)))


PLACE = ("cell", "fine", "rank", "doc_id", "size")


def _bounds(last: DataFrame) -> DataFrame:
    """Per source the last place of which rows fit, how many rows have this place and how many of
    them fit. Rows of one place are counted first, combined before the shuffle."""
    places = last.groupBy("source", "left", *PLACE).agg(F.count("*").alias("n"))
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("left") - F.coalesce(F.sum(F.col("n") * F.col("size")).over(order), F.lit(0))
    fit = F.floor((room - F.col("size") / 2) / F.when(F.col("size") > 0, F.col("size"))) + 1
    fit = F.coalesce(fit, F.when(room >= 0, F.col("n")).otherwise(0))
    places = places.withColumn("fit", F.greatest(F.least(fit, F.col("n")), F.lit(0)).cast("long"))
    none = F.struct("cell", "fine", F.lit(-1.0).alias("rank"), F.col("doc_id"), "size", F.lit(0).cast("long").alias("fit"), "n")
    found = places.groupBy("source").agg(F.max(F.when(F.col("fit") > 0, F.struct(*PLACE, "fit", "n")).otherwise(none)).alias("b"))
    return found.select("source", F.struct(*[F.col(f"b.{c}").alias(c) for c in PLACE]).alias("bound"), "b.fit", "b.n")


def _first_of_equals(rows: DataFrame) -> DataFrame:
    """``chosen`` for rows of one place of which only ``fit`` fit: they are numbered inside the part
    of the stored table they lie in, and counts of the parts tell where each part begins."""
    rows = rows.withColumn("part", F.shiftright("own", 33))
    counts = rows.groupBy("source", "part").agg(F.count("*").alias("in_part"))
    order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("source").alias("key"), F.col("part").alias("key_part"), F.coalesce(F.sum("in_part").over(order), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("source", "part").orderBy("own"))
    numbered = rows.withColumn("inside", inside).join(before, F.col("source").eqNullSafe(F.col("key")) & (F.col("part") == F.col("key_part")))
    chosen = F.col("before") + F.col("inside") <= F.col("fit")
    return numbered.withColumn("chosen", chosen).drop("own", "part", "key", "key_part", "before", "inside")


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: str | None = None,
    seed: int = 17,
    share_percent: int = SHARE_PERCENT,
    weights: tuple[int, ...] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    carry: bool = False,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (copies x size), one row per input
    row; with ``carry`` the input row besides, as the struct ``row``.

    ``weight`` names a column of relative weights inside a source (null, zero or less count as 1);
    the expected copies of a document are then proportional to it, up to ``most_copies``.
    """
    common.prepared(docs.sparkSession)
    w = F.lit(1.0) if weight is None else F.when(F.col(weight) > 0, F.col(weight).cast("double")).otherwise(1.0)
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        common.word_count(F.col(text)).alias("size"),
        w.alias("w"),
        *([F.struct("*").alias("row")] if carry else []),
    )
    narrow = common.stored(sized.drop("row"), "mix-sizes")
    sums = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("w")).alias("mass"))
    targets = source_targets(sums, weights=weights, share_percent=share_percent, most_copies=most_copies)
    targets = common.stored(targets.withColumnRenamed("source", "key"), "mix-targets")

    placed = _place(_with_source(narrow, targets), seed, most_copies)
    sure = placed.groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("certain") * F.col("size")).alias("sure"))
    room = common.stored(sure.select(F.col("source").alias("key"), (F.col("t") - F.col("sure")).alias("room")), "mix-room")
    roomy = _with_source(placed, room)
    edge = common.stored(_first_not_whole(roomy, "cell"), "mix-cells")
    inside = _with_source(roomy, edge, "inner").filter(F.col("cell") == F.col("edge_cell")).withColumn("room", F.col("left")).drop("left")
    inside = common.stored(inside.select(*PLACE, "source", "room"), "mix-edge")
    fine = common.stored(_first_not_whole(inside, "fine"), "mix-fine")
    last = _with_source(inside, fine, "inner").filter(F.col("fine") == F.col("edge_fine"))
    bound = common.stored(_bounds(last).withColumnRenamed("source", "key"), "mix-bounds")

    rows = _place(_with_source(sized, targets), seed, most_copies) if carry else placed
    rows = _with_source(rows, bound)
    # A source without a bound fits whole.
    below = F.col("bound").isNull() | (F.struct(*PLACE) < F.col("bound"))
    level = F.coalesce(F.struct(*PLACE) == F.col("bound"), F.lit(False))
    chosen = (F.col("p") > 0) & (below | (level & (F.col("fit") == F.col("n"))))
    parted = (F.col("p") > 0) & level & (F.col("fit") > 0) & (F.col("fit") < F.col("n"))
    if bound.filter((F.col("fit") > 0) & (F.col("fit") < F.col("n"))).isEmpty():
        rows = rows.withColumn("chosen", chosen)
    else:
        some = _first_of_equals(common.stored(rows.filter(parted).withColumn("own", F.monotonically_increasing_id()), "mix-equals"))
        rows = rows.filter(~F.coalesce(parted, F.lit(False))).withColumn("chosen", chosen).unionByName(some)
    rows = rows.withColumn("copies", F.col("certain") + F.when(F.col("chosen"), 1).otherwise(0))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["row"] if carry else [])
    )
