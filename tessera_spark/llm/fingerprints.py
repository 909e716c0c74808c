"""Document fingerprints by a threshold-scaled sketch. DataFrame functions only.

A text's sketch holds every shingle whose hash lies below a fixed fraction of all hashes. The
threshold is the same for all texts, so a sketch grows with its text, the sketch of a union is the
union of the sketches, and the part of a small text that lies in a large one can be read off two
sketches of very different lengths. A shingle is five words; fewer words are one shingle, none are
none. A hash is the leading 64 bits of an MD5, as hexadecimal text.

``neighbours`` hands every document the text of the one before it in a circle by id, with one
shuffle of the texts: ids are cut at percentiles, wide ranges once more in equal parts, and the
last row of each bucket is copied to the head of the next one that has rows. What the driver holds
is at most RANGES numbers; the table of buckets is stored.

Defined results: a null text is the empty text; of an empty or blank text no shingle is kept;
a very long text is hashed inside its row, so memory follows the longest text; two texts of which
no shingle is kept are alike (1) if they are equal and else not (0). Null ids come last in
descending order, rows that repeat an id follow by the hash of their text, rows that repeat
both are alike in either order; a single row is its own neighbour; an empty table gives an empty
result. Only the named columns are read, whatever else there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera_spark.llm import common

WIDTH = 5
#: The share of shingle hashes that is kept.
FRACTION = 0.25
HASH_DIGITS = 16
#: Rows that one bucket of neighbours is meant to hold, and the most percentiles that cut ids.
BUCKET_ROWS = 1024
RANGES = 1024
LEAST = -(1 << 63)


def sketch(text: Column, fraction: float = FRACTION, width: int = WIDTH) -> Column:
    """Sorted hashes of the text's shingles below ``fraction`` of all hashes, in steps of 1/65536."""
    bound = F.lit(f"{min(round(fraction * 65536), 65535):04x}")
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(common.WORD), F.lit(0))

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(1)))
        return F.transform(starts, lambda k: F.left(F.md5(F.array_join(F.slice(w, k, F.lit(width)), " ").cast("binary")), F.lit(HASH_DIGITS)))

    # The words are bound once: as a plain expression every shingle would find them again.
    kept = F.transform(
        F.array(words), lambda w: F.filter(F.when(F.size(w) > 0, hashes(w)).otherwise(F.array().cast("array<string>")), lambda h: h < bound)
    )
    return F.array_sort(F.array_distinct(F.element_at(kept, 1)))


def fingerprint(text: Column, sketched: Column) -> Column:
    """The MD5 of the whole text, a colon, and the hashes of its sketch."""
    whole = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.concat(whole, F.lit(":"), F.array_join(sketched, ","))


def merged(one: Column, other: Column) -> Column:
    """The sketch of two texts together."""
    return F.array_sort(F.array_union(one, other))


def merged_sketches(rows: DataFrame, by: str, sketched: str = "sketch") -> DataFrame:
    """The sketches of groups of rows as (by, hash), one row per kept shingle. Hashes are combined
    before the shuffle and spread by their own value, so a group of any size is."""
    return rows.select(by, F.explode(sketched).alias("hash")).distinct()


def containment(small: Column, large: Column) -> Column:
    """The estimated part of the first text's shingles that the second has; null without any."""
    return F.try_divide(F.size(F.array_intersect(small, large)).cast("double"), F.size(small).cast("double"))


def likeness(one: Column, other: Column, equal: Column) -> Column:
    """The estimated Jaccard similarity of two texts' shingles; ``equal`` decides without any."""
    both = F.size(F.array_intersect(one, other))
    all_ = F.size(one) + F.size(other) - both
    return F.coalesce(F.try_divide(both.cast("double"), all_.cast("double")), equal.cast("double"))


def _range_of(splits: list[int]) -> Column:
    """How many splits lie at or below the id, by halving; -1 for a null id."""
    if not splits:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    steps = ",".join(str(1 << k) for k in reversed(range(len(splits).bit_length())))
    values = ",".join(f"{v}L" if v > LEAST else f"(-{(1 << 63) - 1}L - 1L)" for v in splits)
    return F.expr(
        f"if(doc_id is null, -1, aggregate(array({steps}), 0, (at, step) -> "
        f"if(at + step <= {len(splits)} and get(array({values}), at + step - 1) <= doc_id, at + step, at)))"
    )


def _with_bucket(rows: DataFrame, splits: list[int], ranges: DataFrame) -> DataFrame:
    """Adds ``range`` and ``part``, which together follow the order of (doc_id, tie). A range of
    more than BUCKET_ROWS rows has parts: by id, or by the tie if all its ids are one."""
    by_tie = (F.col("tie").cast("double") - float(LEAST)) / float(1 << 64)
    by_id = (F.col("doc_id").cast("double") - F.col("low").cast("double")) / (F.col("high").cast("double") - F.col("low").cast("double") + 1)
    share = F.when(F.col("low") < F.col("high"), by_id).otherwise(by_tie)
    part = F.least(F.floor(share * F.col("parts")), F.col("parts") - 1)
    placed = rows.withColumn("range", _range_of(splits)).join(F.broadcast(ranges), "range")
    return placed.withColumn("part", part).drop("low", "high", "parts")


def neighbours(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, next_text, range, part, tie, copied: the next document in descending order of
    ids, after the last the first. Rows with ``copied`` only stand for a predecessor's."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), content.alias("text"), F.xxhash64(content).alias("tie"))
    keys = common.stored(rows.select("doc_id", "tie"), "fingerprint-keys")
    wanted = min(RANGES, -(-keys.count() // BUCKET_ROWS))
    points = [k / wanted for k in range(1, wanted)]
    found = keys.agg(F.percentile_approx("doc_id", points, 20 * RANGES).alias("at")).first()["at"] if points else None
    splits = sorted(set(found or []))
    sizes = keys.withColumn("range", _range_of(splits)).groupBy("range")
    ranges = sizes.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.ceil(F.count("*") / BUCKET_ROWS).alias("parts"))
    ranges = common.stored(ranges, "fingerprint-ranges")  # at most RANGES + 1 rows

    # The last row of each bucket, and the next bucket that has rows: the next of the range, or else
    # the first one of the next range, or of all.
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    tails = _with_bucket(keys, splits, ranges).groupBy("range", "part").agg(F.max(order).alias("tail"))
    heads = tails.groupBy("range").agg(F.min("part").alias("first"))
    everything, rising = Window.partitionBy(), Window.partitionBy().orderBy("range")
    head = F.struct("range", F.col("first").alias("part"))
    after = heads.select("range", F.coalesce(F.lead(head).over(rising), F.min(head).over(everything)).alias("after"))
    inside = F.lead(F.struct("range", "part")).over(Window.partitionBy("range").orderBy("part"))
    tails = tails.withColumn("inside", inside).join(F.broadcast(after), "range")
    tails = common.stored(tails.select("range", "part", "tail", F.coalesce("inside", "after").alias("heir")), "fingerprint-tails")

    placed = _with_bucket(rows, splits, ranges).join(common.small_or_plain(tails), ["range", "part"])
    own = F.struct("range", "part", F.lit(False).alias("copied"))
    copy = F.struct(F.col("heir.range").alias("range"), F.col("heir.part").alias("part"), F.lit(True).alias("copied"))
    places = F.when(F.col("tail") == order, F.array(own, copy)).otherwise(F.array(own))
    dealt = placed.select("doc_id", "text", "tie", F.explode(places).alias("at")).select("doc_id", "text", "tie", "at.*")
    return dealt.withColumn("next_text", F.lag("text").over(_circle()))


def _circle() -> Window:
    return Window.partitionBy("range", "part").orderBy(F.desc("copied"), F.col("doc_id").asc_nulls_first(), "tie")


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last third of code points replaced by as many first ones of another."""
    third = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.left(text, F.char_length(text) - third), F.left(next_text, third))


def fingerprint_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", fraction: float = FRACTION) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; one
    row per input row. ``near_`` is the likeness to the edited text and to the next document."""
    common.prepared(docs.sparkSession)
    rows = neighbours(docs, doc_id=doc_id, text=text)
    rows = rows.withColumn("edited", F.coalesce(edited(F.col("text"), F.col("next_text")), F.lit("")))
    rows = rows.withColumns({"own": sketch(F.col("text"), fraction), "other": sketch(F.col("edited"), fraction)})
    # The same order as before, so the rows are neither dealt nor sorted again.
    rows = rows.withColumn("next", F.lag("own").over(_circle())).filter(~F.col("copied"))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited"), F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), F.col("text") == F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next"), F.col("text") == F.col("next_text")).alias("near_next"),
    )
