"""Training with one update per global mini-batch.

The rows of a mini-batch lie on many workers. Each task runs its rows through the shared network,
batch by batch as Arrow hands them over, and gives back sums only: of a layer's inputs, of the
back-propagated errors, of the gradient. Sums are added in blocks over as many levels as needed, as
in ``training``, then one update is made for all. Batch normalisation uses the statistics of the
whole mini-batch: a pass per normalised layer finds its moments, a pass per normalised layer on the
way back finds the means of its errors, and a last one adds up the gradient. So weights are those
of one machine that saw the whole mini-batch, however many workers there are.

Which mini-batch of an epoch a row belongs to follows from a keyed permutation of dense row numbers.
The numbered rows are dealt to the workers by their key and, once an epoch, sorted by mini-batch, so
that a pass reads the row groups of its own mini-batch and no vector moves between passes. No task
holds more than one Arrow batch of rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.functions.vectors import BATCH_NORM_EPS, LEAKY_SLOPE
from tessera_spark.operators import training as T
from tessera_spark.operators.mlp import Network, batch_matrix
from tessera_spark.operators.numbering import hash_bucket, order_hash, permuted_batches, rank_in_group
from tessera_spark.session import remove_scratch, scratch_path, spread_rows

#: Row groups of an epoch's table, so that a mini-batch is found by their bounds.
ROW_GROUP_BYTES = 4 << 20


@dataclass
class Known:
    """What the passes so far found of one mini-batch: its rows, mean and variance per normalised
    layer from the input on, and means of the errors per normalised layer from the output on."""

    rows: int = 0
    moments: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    errors: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)


def kept_units(keys: np.ndarray, units: int, rate: float, tag: str) -> np.ndarray:
    """Dropout mask of a layer. Each cell follows from its row's key, its unit and the tag, so it is
    the same on whatever worker the row lies."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(units, dtype=np.uint64)
        x = x * np.uint64(0xD1B54A32D192ED03) + np.uint64(zlib.crc32(tag.encode()))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)) / float(1 << 53) >= rate) / (1.0 - rate)


def partial_sums(network: Network, known: Known, keys: np.ndarray, x: np.ndarray, y: np.ndarray, tag: str) -> list[np.ndarray]:
    """Sums over some rows of a mini-batch, as far as what is known allows: sums and squares of the
    next normalised layer's inputs, or the errors' sums there, or gradient, loss and class counts.
    Without ``tag`` no dropout."""
    hidden = sum(layer.norm is not None for layer in network)
    tape = []
    for i, layer in enumerate(network):
        entry = {"x": x}
        x = x @ layer.weight.T + layer.bias
        if layer.norm is not None:
            if i == len(known.moments):
                return [x.sum(axis=0), (x * x).sum(axis=0)]
            mean, var = known.moments[i]
            width = 1.0 / np.sqrt(var + BATCH_NORM_EPS)
            unit = (x - mean) * width
            x = unit * layer.norm["bn_gamma"] + layer.norm["bn_beta"]
            slope = np.where(x < 0, LEAKY_SLOPE, 1.0)
            if tag:
                slope = slope * kept_units(keys, x.shape[1], T.LAST_DROPOUT if i == hidden - 1 else T.DROPOUT, f"{tag}:{i}")
            x = x * slope
            entry.update(unit=unit, width=width, slope=slope)
        tape.append(entry)
    weights = np.exp(x - x.max(axis=1, keepdims=True))
    total = weights.sum(axis=1)
    each, classes = np.arange(len(y)), x.shape[1]
    loss = (np.log(total) + x.max(axis=1) - x[each, y]).sum()
    guess = x.argmax(axis=1)
    counts = [np.bincount(c, minlength=classes).astype(float) for c in (y, guess, y[guess == y])]

    grad = weights / total[:, None]
    grad[each, y] -= 1.0
    pieces: list[list[np.ndarray]] = []
    for layer, entry in zip(reversed(network), reversed(tape), strict=True):
        extra, back = [], len([p for p in pieces if len(p) > 2])
        if layer.norm is not None:
            grad = grad * entry["slope"]
            unit, inner = entry["unit"], grad * layer.norm["bn_gamma"]
            if back == len(known.errors):
                return [inner.sum(axis=0), (inner * unit).sum(axis=0)]
            mean, along = known.errors[back]
            extra = [(grad * unit).sum(axis=0), grad.sum(axis=0)]
            grad = entry["width"] * (inner - mean - unit * along)
        pieces.append([grad.T @ entry["x"], grad.sum(axis=0), *extra])
        grad = grad @ layer.weight
    return [*(a for piece in reversed(pieces) for a in piece), np.array([loss]), *counts]


def summed_pass(batch: DataFrame, network: Network, known: Known, tag: str) -> tuple[int, np.ndarray]:
    """Rows of the mini-batch and the sums over all of them, from one pass."""
    shared = batch.sparkSession.sparkContext.broadcast((network, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, found = shared.value
        whole = None
        for rows in batches:
            if not rows.num_rows:
                continue
            x, y = batch_matrix(rows.column("embedding")), rows.column("label_id").to_numpy()
            sums = partial_sums(start, found, rows.column("key").to_numpy(), x, y, tag)
            flat = np.concatenate([[len(y)], *(a.ravel() for a in sums)])
            whole = flat if whole is None else whole + flat
        if whole is not None:
            starts = range(0, len(whole), T.BLOCK)
            part = TaskContext.get().partitionId()
            yield pa.record_batch(
                [
                    pa.array(range(len(starts)), pa.int32()),
                    pa.array([part] * len(starts), pa.int32()),
                    pa.array([whole[s : s + T.BLOCK].tobytes() for s in starts], pa.binary()),
                ],
                ["block", "part", "payload"],
            )

    partials, parts = batch.select("key", "embedding", "label_id").mapInArrow(run, T._PARTIAL), batch.rdd.getNumPartitions()
    while parts > T.FAN_IN:
        partials = T._sum_blocks(partials.withColumn("part", (F.col("part") / T.FAN_IN).cast("int")), "block", "part")
        parts = -(-parts // T.FAN_IN)
    blocks = sorted(T._sum_blocks(partials, "block").collect(), key=lambda r: r["block"])
    shared.destroy()
    values = np.concatenate([np.frombuffer(r["payload"], dtype=np.float64) for r in blocks])
    return int(values[0]), values[1:]


def update(batch: DataFrame, network: Network, momentum: np.ndarray, rate: float, step: int, tag: str) -> dict:
    """One update from one mini-batch; network and momentum are changed."""
    known = Known()
    hidden, classes = sum(layer.norm is not None for layer in network), len(network[-1].bias)
    for _ in range(hidden):
        known.rows, sums = summed_pass(batch, network, known, tag)
        mean, square = np.split(sums / known.rows, 2)
        known.moments.append((mean, np.maximum(square - mean * mean, 0.0)))
    for _ in range(hidden):
        _, sums = summed_pass(batch, network, known, tag)
        known.errors.append(tuple(np.split(sums / known.rows, 2)))
    rows, sums = summed_pass(batch, network, known, tag)
    size = len(momentum)
    grad = sums[:size] / rows
    theta = T._flat(T._trainable(network))
    theta -= rate * np.sign(T.BETAS[0] * momentum + (1 - T.BETAS[0]) * grad)
    momentum *= T.BETAS[1]
    momentum += (1 - T.BETAS[1]) * grad
    T._assign(T._trainable(network), theta)
    unbiased = [a for mean, var in known.moments for a in (mean, var * rows / max(rows - 1, 1))]
    T._update_norms(network, T._flat(unbiased), step + 1)
    return {"rows": rows, "loss": float(sums[size]), "counts": sums[size + 1 :].reshape(3, classes)}


class Epochs:
    """The epochs of one training: numbers the rows once and deals them to mini-batches anew each
    time. Handed to ``training.fit_mlp`` as its ``epoch``."""

    def __init__(self, workers: int = 0):
        self._workers, self._paths, self._rows = workers, [], None

    def _stored(self, rows: DataFrame, name: str, **options) -> DataFrame:
        path = scratch_path(rows.sparkSession, name)
        rows.write.options(**options).parquet(path)
        self._paths.append(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def _dealt(self, rows: DataFrame, workers: int) -> DataFrame:
        return rows.repartition(max(workers, self._workers), "key") if self._workers else spread_rows(rows, "key")

    def __call__(self, stored, network, momentum, workers, rate, batch_rows, step, seed, epoch, dropout) -> dict:
        if self._rows is None:
            digest = order_hash(seed, F.col("key"))
            numbered = rank_in_group(stored.withColumn("_digest", digest), [], [F.col("_digest"), F.col("key")], hash_bucket(F.col("_digest")), "place")
            self._rows = self._stored(self._dealt(numbered.drop("_digest"), workers), "numbered")
        rows = self._rows.count()
        # An even cut, so that no mini-batch is left with a single row.
        steps = max(1, rows // batch_rows)
        batches = self._rows
        if steps > 1:
            placed = permuted_batches(self._rows, "place", rows, 1, seed, epoch).withColumn("batch", F.call_function("div", F.col("batch") * steps, F.lit(rows)))
            batches = self._stored(self._dealt(placed, workers).sortWithinPartitions("batch"), "epoch", **{"parquet.block.size": ROW_GROUP_BYTES})
        done = []
        for k in range(steps):
            batch = batches.filter(F.col("batch") == k) if steps > 1 else batches
            done.append(update(batch, network, momentum, rate, step + k, f"{seed}:{epoch}:{k}" if dropout else ""))
        if steps > 1:
            remove_scratch(stored.sparkSession, self._paths.pop())
        total = sum(d["rows"] for d in done)
        return {"counts": sum(d["counts"] for d in done), "loss": sum(d["loss"] for d in done) / total, "steps": steps, "rows": total}

    def close(self, spark) -> None:
        while self._paths:
            remove_scratch(spark, self._paths.pop())


def fit_mlp(train: DataFrame, val: DataFrame | None = None, hidden: Sequence[int] = T.HIDDEN_UNITS, workers: int = 0, **settings) -> T.Fitted:
    """As ``training.fit_mlp``, with one update per global mini-batch. ``workers`` is the number of
    parts the rows are dealt to; 0 takes as many as there are cores or shuffle partitions."""
    epochs = Epochs(workers)
    try:
        return T.fit_mlp(train, val, hidden, epoch=epochs, **settings)
    finally:
        epochs.close(train.sparkSession)
