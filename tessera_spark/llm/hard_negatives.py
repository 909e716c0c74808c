"""Hard negatives of anchors by a secondary-sort shuffle.

A score is the whole-number inner product of quantised vectors. An anchor ranks all other rows by
descending score, ties by smaller id. Its positives are the first rows of its own label; each opens
a window of scores, and the first rows of other labels inside it are its hard negatives.

Anchors pass over the table in blocks of a bounded size, broadcast to the tasks that read it. Of
what a task sees it keeps only what can still be among the first: per anchor the first rows of its
label, and, once the positives are known, per window its first negatives. So a task hands on a few
rows per anchor, however many rows one label or one vector has, and no row that counts is lost.
These rows are shuffled by anchor and sorted by (anchor, descending score, kind, id); one iterator
then reads each anchor as a stream, opens a window when a positive comes by, and emits negatives
until the window is full. It holds an anchor's few windows, never its rows.

Defined results: rows with a null label, a null vector or a null or non-finite component take no
part; a null id is no anchor, and comes last among equal scores; missing components of a shorter
vector count as 0, and so do all of an empty one; quantised components saturate where scores would
no longer fit 64 bits (with 64 components at +-379,625,062). Rows that repeat an id are rows of their own: each is an anchor
and each is another row to the others. A positive with a negative score opens an empty window, since
its lower bound is above its upper. An empty table, or one without anchors, gives an empty result.
Only the named columns are read, whatever else there is; no text is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera_spark.llm import common

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: The window of a positive: its score times these, over 100.
LOWEST, HIGHEST = 30, 90
#: Anchors of one pass, by rows and by bytes of their vectors.
BLOCK_ROWS = 1 << 16
BLOCK_BYTES = 32 << 20
#: Scores computed at a time.
CELLS = 1 << 20
NO_ID = (1 << 63) - 1  # stands for a null id, which comes last

FIRST = "anchor long, rival long, score long"
FOUND = "anchor long, score long, kind int, rival long, anchor_id long, copies long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(vectors: DataFrame, vec_id: str, label: str, vector: str) -> tuple[DataFrame, int]:
    """vec_id, label, parts (array of int) of the rows that take part, and the longest vector."""
    x = F.col(vector).cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.filter(F.col(label).isNotNull() & F.col(vector).isNotNull()).filter(sound)
    width = rows.agg(F.max(F.size(F.col(vector)))).first()[0] or 0
    most = F.lit(float(min((1 << 31) - 1, math.isqrt(((1 << 63) - 1) // max(width, 1)))))
    part = F.transform(x, lambda v: F.greatest(F.least(F.floor(v * SCALE).cast("double"), most), -most).cast("int"))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), part.alias("parts")), width


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones filled up with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    return out


def window_of(score: int) -> tuple[int, int]:
    """Lowest and highest whole scores of a positive's window; none if the first is larger."""
    return -(-LOWEST * score // 100), HIGHEST * score // 100


class Products:
    """Exact inner products: by floating point as long as every sum is below 2^53."""

    def __init__(self, anchors: np.ndarray):
        self._whole, self._float = anchors, anchors.astype(np.float64)
        self._most = int(np.abs(anchors).max(initial=0)) * anchors.shape[1]

    def of(self, at: slice, rows: np.ndarray) -> np.ndarray:
        if self._most * int(np.abs(rows).max(initial=0)) < 1 << 53:
            return (self._float[at] @ rows.astype(np.float64).T).astype(np.int64)
        return self._whole[at] @ rows.T


class First:
    """Per group the first ``most`` entries by descending score, then id; the rest is forgotten as
    it comes. ``least`` is the score below which a group's entries no longer count."""

    def __init__(self, groups: int, most: int):
        self._most = most
        self.least = np.full(groups, np.iinfo(np.int64).min)
        self.group, self.score, self.rival = (np.empty(0, np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, rival: np.ndarray) -> None:
        if not len(group):
            return
        group, score, rival = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.rival, rival)))
        order = np.lexsort((rival, -score, group))
        group, score, rival = group[order], score[order], rival[order]
        start = np.r_[0, np.flatnonzero(np.diff(group)) + 1]
        place = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
        self.least[group[place == self._most - 1]] = score[place == self._most - 1]
        kept = place < self._most
        self.group, self.score, self.rival = group[kept], score[kept], rival[kept]


def _scored(batches: Iterator[pa.RecordBatch], labels: np.ndarray, products: Products, width: int):
    """(slice of anchors, same label, scores, ids) in pieces of at most about CELLS scores."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = matrix(batch.column("parts"), width)
        ids = pc.fill_null(batch.column("vec_id"), NO_ID).to_numpy(zero_copy_only=False)
        own = batch.column("label").to_numpy(zero_copy_only=False)
        step = max(1, CELLS // len(ids))
        for low in range(0, len(labels), step):
            at = slice(low, min(low + step, len(labels)))
            yield at, labels[at, None] == own, products.of(at, rows), ids


def _first_of_label(block, most: int):
    """Per task and anchor the first ``most`` rows of the anchor's label, itself among them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, parts, number = block.value
        first = First(len(labels), most)
        for at, same, scores, ids in _scored(batches, labels, Products(parts), parts.shape[1]):
            a, r = np.nonzero(same & (scores >= first.least[at, None]))
            first.add(a + at.start, scores[a, r], ids[r])
        yield pa.record_batch([number[first.group], first.rival, first.score], ["anchor", "rival", "score"])
        common.trim()

    return scan


def _first_of_windows(block, windows, most: int):
    """Per task and window the first ``most`` rows of other labels inside it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, parts, number = block.value
        low, high = windows.value  # anchors x positives
        each = low.shape[1]
        first = First(low.size, most)
        for at, same, scores, ids in _scored(batches, labels, Products(parts), parts.shape[1]):
            for k in range(each):
                group = np.arange(at.start, at.stop) * each + k
                inside = ~same & (scores >= low[at, k, None]) & (scores <= high[at, k, None])
                a, r = np.nonzero(inside & (scores >= first.least[group, None]))
                first.add(group[a], scores[a, r], ids[r])
        # A row may be among the first of several windows: one entry per row and anchor, and as
        # many as the window that holds most of them, since rows can repeat an id.
        order = np.lexsort((first.group % each, first.rival, first.score, first.group // each))
        anchor, window, score, rival = first.group[order] // each, first.group[order] % each, first.score[order], first.rival[order]
        change = np.r_[True, (np.diff(anchor) != 0) | (np.diff(score) != 0) | (np.diff(rival) != 0)][: len(anchor)]
        turn = np.r_[True, change[1:] | (np.diff(window) != 0)][: len(anchor)]
        start = np.flatnonzero(turn)
        nth = np.arange(len(anchor)) - np.repeat(start, np.diff(np.r_[start, len(anchor)]))
        entries = np.unique(np.column_stack([anchor, score, rival, nth]), axis=0) if len(anchor) else np.empty((0, 4), np.int64)
        yield pa.record_batch([number[entries[:, 0]], entries[:, 2], entries[:, 1]], ["anchor", "rival", "score"])
        common.trim()

    return scan


def _streamed(negatives: int):
    """Reads sorted rows (anchor, descending score, positives first, id) and emits each window's
    negatives as they come by."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows = None, []
        for batch in batches:
            out = []
            for anchor, score, kind, rival, anchor_id, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if anchor != current:
                    current, windows = anchor, []
                if kind == 0:
                    windows.append([rival, score, *window_of(score), 0])
                    continue
                for window in windows:
                    positive, top, low, high, rank = window
                    if low <= score <= high and rank < negatives:
                        window[4] = rank + 1
                        out += [(anchor_id, positive, rank + 1, rival, top, score)] * copies
            columns = list(zip(*out, strict=True)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            values = [[None if k in (1, 3) and v == NO_ID else v for v in c] for k, c in enumerate(columns)]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(values, types, strict=True)], MINED.replace(" long", "").replace(" int", "").split(", "))

    return read


def _positives(first: DataFrame, anchors: dict, positives: int) -> dict[int, list[tuple[int, int]]]:
    """Of each anchor of a block the first (id, score) of its label without itself, in order: one
    row that equals the anchor in id and score is left out."""
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "rival"))
    rows = first.withColumn("place", place).filter(F.col("place") <= positives + 1).toArrow()
    ranked: dict[int, list] = {}
    for anchor, rival, score, _ in sorted(zip(*(c.to_pylist() for c in rows.columns), strict=True), key=lambda r: (r[0], r[3])):
        ranked.setdefault(anchor, []).append((rival, score))
    for anchor, found in ranked.items():
        if anchors[anchor] in found:
            found.remove(anchors[anchor])
        del found[positives:]
    return ranked


def _mine_block(rows: DataFrame, block: pa.Table, width: int, offset: int, positives: int, negatives: int) -> DataFrame:
    """The stored rows of the secondary sort for one block of anchors."""
    spark = rows.sparkSession
    labels, parts = block.column("label").to_numpy(), matrix(block.column("parts").combine_chunks(), width)
    number = np.arange(len(labels)) + offset
    ids, copies = block.column("vec_id").to_pylist(), block.column("copies").to_pylist()
    sent = spark.sparkContext.broadcast((labels, parts, number))
    first = common.stored(rows.mapInArrow(_first_of_label(sent, positives + 1), FIRST), "negatives-first")
    anchors = {k: (v, n) for k, v, n in zip(number.tolist(), ids, (parts * parts).sum(axis=1).tolist(), strict=True)}
    low, high = np.ones((len(labels), positives), np.int64), np.zeros((len(labels), positives), np.int64)
    opened = []
    for anchor, ranked in _positives(first, anchors, positives).items():
        for k, (rival, score) in enumerate(ranked):
            low[anchor - offset, k], high[anchor - offset, k] = window_of(score)
            opened.append((anchor, score, 0, rival))
    windows = spark.sparkContext.broadcast((low, high))
    found = rows.mapInArrow(_first_of_windows(sent, windows, negatives), FIRST)
    found = found.select("anchor", "score", F.lit(1).alias("kind"), "rival")
    heads = spark.createDataFrame(opened, "anchor long, score long, kind int, rival long")
    names = spark.createDataFrame(list(zip(number.tolist(), ids, copies, strict=True)), "anchor long, anchor_id long, copies long")
    out = common.stored(found.unionByName(heads).join(F.broadcast(names), "anchor").select("anchor", "score", "kind", "rival", "anchor_id", "copies"), "negatives-sorted")
    common.discard(first)
    sent.destroy()
    windows.destroy()
    return out


def mine(
    vectors: DataFrame,
    *,
    anchor: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``anchor`` tells
    from ``vec_id`` and ``label`` which rows are anchors."""
    spark = vectors.sparkSession
    common.prepared(spark)
    rows, width = quantised(vectors, vec_id, label, vector)
    rows = common.stored(rows, "negatives-rows")
    # Anchors alike in everything are mined once and counted.
    anchors = rows.filter(anchor & F.col("vec_id").isNotNull()).groupBy("vec_id", "label", "parts").agg(F.count("*").alias("copies"))
    anchors = common.stored(anchors, "negatives-anchors")
    many = anchors.count()
    if not many:
        return spark.createDataFrame([], MINED)
    # Dealt by hash a block is a little larger or smaller than planned.
    blocks = -(-many // max(1, min(block_rows, BLOCK_BYTES // (8 * max(width, 1)))))
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "parts"), F.lit(blocks)))
    offset, sorted_rows = 0, None
    for k in range(blocks):
        block = dealt.filter(F.col("block") == k).drop("block").toArrow()
        if block.num_rows:
            part = _mine_block(rows, block, width, offset, positives, negatives)
            sorted_rows = part if sorted_rows is None else sorted_rows.unionByName(part)
            offset += block.num_rows
    keyed = sorted_rows.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "kind", "rival")
    return keyed.mapInArrow(_streamed(negatives), MINED)


def noisy_label(vec_id: Column, label: Column) -> Column:
    """A label that is off by one, around ten, where the id is divisible by seven."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
