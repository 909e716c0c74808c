"""Distributed training of the perceptron.

``fit_mlp`` is data-parallel descent with parameter averaging. An epoch deals the rows to workers by a
hash of their key; each worker takes its rows in an order that a hash of epoch and key gives, cut into
mini-batches, and makes one update per mini-batch on its own copy. Then the copies are averaged by rows,
in blocks and over as many levels as it takes for a task to add up a bounded number of them. A worker
has at most ``WORKER_ROWS`` rows on average, so their number follows the rows and one job covers all
updates of an epoch. Batches, order and dropout depend on keys and epoch only: the result is the same
however the input is partitioned, and a retried task repeats itself.

The update is the sign-momentum rule of Chen et al. 2023 (arXiv:2302.06675). Batch normalisation uses
the statistics of each mini-batch; the stored statistics are bias-corrected running means.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.functions import vectors as V
from tessera_spark.functions.schedules import LR_END, LR_START, VALIDATE_EVERY
from tessera_spark.functions.vectors import BATCH_NORM_EPS, LEAKY_SLOPE
from tessera_spark.operators.mlp import Layer, Network, batch_matrix, check_size, mlp_forward
from tessera_spark.operators.runs import MIN_DELTA, PATIENCE
from tessera_spark.schemas import EPOCH_METRICS
from tessera_spark.session import remove_scratch, scratch_path

# Layer sizes, seed, momentum pair, dropout of inner and last hidden layer.
HIDDEN_UNITS = (4096, 1024, 512, 128)
SEED = 42
BETAS = (0.95, 0.98)
DROPOUT, LAST_DROPOUT = 0.7, 0.5
BATCH_ROWS = 256
NORM_MOMENTUM = 0.1
# Rows of one worker, parameters of one block (512 KB) and copies one task adds up per block.
WORKER_ROWS = 1 << 15
BLOCK = 1 << 16
FAN_IN = 64


@dataclass
class Fitted:
    """Last and best network, and one row per epoch and series."""

    last: Network
    best: Network
    best_epoch: int | None
    history: list[tuple] = field(default_factory=list)
    stopped: bool = False

    def epoch_metrics(self, spark, run_id: str = "run") -> DataFrame:
        return spark.createDataFrame([(run_id, *row) for row in self.history], EPOCH_METRICS)


def new_network(sizes: Sequence[int], seed: int = SEED) -> Network:
    """Uniform start in +-1/sqrt(inputs); hidden layers are normalised."""
    rng = np.random.default_rng(seed)
    network = []
    for i, (n_in, n_out) in enumerate(zip(sizes[:-1], sizes[1:])):
        bound = 1.0 / math.sqrt(n_in)
        norm = None
        if i < len(sizes) - 2:
            norm = {
                "bn_mean": np.zeros(n_out),
                "bn_var": np.ones(n_out),
                "bn_gamma": np.ones(n_out),
                "bn_beta": np.zeros(n_out),
            }
        network.append(
            Layer(rng.uniform(-bound, bound, (n_out, n_in)), rng.uniform(-bound, bound, n_out), norm)
        )
    return network


def _trainable(network: Network) -> list[np.ndarray]:
    arrays = []
    for layer in network:
        arrays += [layer.weight, layer.bias]
        if layer.norm is not None:
            arrays += [layer.norm["bn_gamma"], layer.norm["bn_beta"]]
    return arrays


def _flat(arrays: Sequence[np.ndarray]) -> np.ndarray:
    return np.concatenate([a.ravel() for a in arrays]) if arrays else np.zeros(0)


def _assign(arrays: Sequence[np.ndarray], flat: np.ndarray) -> None:
    start = 0
    for a in arrays:
        a[...] = flat[start : start + a.size].reshape(a.shape)
        start += a.size


def copy_network(network: Network) -> Network:
    return [
        Layer(
            l.weight.copy(), l.bias.copy(), None if l.norm is None else {k: v.copy() for k, v in l.norm.items()}
        )
        for l in network
    ]


def batch_gradient(
    network: Network, x: np.ndarray, y: np.ndarray, rng: np.random.Generator | None = None
) -> tuple[float, np.ndarray, list[np.ndarray], np.ndarray]:
    """Summed loss, flat gradient of the summed loss, batch statistics (mean and unbiased
    variance per normalised layer) and logits of one mini-batch. Without ``rng`` no dropout."""
    rows = len(x)
    hidden = sum(layer.norm is not None for layer in network)
    tape, stats = [], []
    for i, layer in enumerate(network):
        entry = {"x": x}
        x = x @ layer.weight.T + layer.bias
        if layer.norm is not None:
            mean, var = x.mean(axis=0), x.var(axis=0)
            stats += [mean, var * rows / max(rows - 1, 1)]
            width = 1.0 / np.sqrt(var + BATCH_NORM_EPS)
            unit = (x - mean) * width
            x = unit * layer.norm["bn_gamma"] + layer.norm["bn_beta"]
            slope = np.where(x < 0, LEAKY_SLOPE, 1.0)
            x = x * slope
            entry.update(unit=unit, width=width, slope=slope)
            if rng is not None:
                rate = LAST_DROPOUT if i == hidden - 1 else DROPOUT
                mask = (rng.random(x.shape) >= rate) / (1.0 - rate)
                x = x * mask
                entry["mask"] = mask
        tape.append(entry)
    logits = x
    shifted = logits - logits.max(axis=1, keepdims=True)
    weights = np.exp(shifted)
    total = weights.sum(axis=1, keepdims=True)
    loss = float((np.log(total[:, 0]) - shifted[np.arange(rows), y]).sum())

    grad = weights / total
    grad[np.arange(rows), y] -= 1.0
    pieces: list[list[np.ndarray]] = []
    for layer, entry in zip(reversed(network), reversed(tape)):
        extra = []
        if layer.norm is not None:
            if "mask" in entry:
                grad = grad * entry["mask"]
            grad = grad * entry["slope"]
            unit = entry["unit"]
            extra = [(grad * unit).sum(axis=0), grad.sum(axis=0)]
            inner = grad * layer.norm["bn_gamma"]
            grad = entry["width"] * (
                inner - inner.mean(axis=0) - unit * (inner * unit).mean(axis=0)
            )
        pieces.append([grad.T @ entry["x"], grad.sum(axis=0), *extra])
        grad = grad @ layer.weight
    return loss, _flat([a for piece in reversed(pieces) for a in piece]), stats, logits


_PARTIAL = "block int, part int, payload binary"


def _sum_blocks(partials: DataFrame, *keys: str) -> DataFrame:
    """Element-wise sums of the payloads of each key."""

    def add(table: pa.Table) -> pa.Table:
        total = None
        for payload in table.column("payload"):
            values = np.frombuffer(payload.as_buffer(), dtype=np.float64)
            total = values.copy() if total is None else total + values
        return pa.table(
            {
                "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
                "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
                "payload": pa.array([total.tobytes()], pa.binary()),
            }
        )

    return partials.groupBy(*keys).applyInArrow(add, _PARTIAL)


def _norms(network: Network) -> list[np.ndarray]:
    return [layer.norm[kind] for layer in network if layer.norm is not None for kind in ("bn_mean", "bn_var")]


def local_epoch(
    network: Network, momentum: np.ndarray, x: np.ndarray, y: np.ndarray, rate: float, batch_rows: int, step: int, seed: str
) -> dict:
    """One pass over ordered rows with an update per mini-batch; network and momentum are changed.
    Without ``seed`` no dropout."""
    classes = len(network[-1].bias)
    support, predicted, hits = np.zeros((3, classes))
    total, taken = 0.0, 0
    # An even cut, so that no mini-batch is left with a single row.
    for k, chosen in enumerate(np.array_split(np.arange(len(y)), max(1, len(y) // batch_rows))):
        rng = np.random.default_rng(zlib.crc32(f"{seed}:{k}".encode())) if seed else None
        loss, grad, stats, logits = batch_gradient(network, x[chosen], y[chosen], rng)
        grad /= len(chosen)
        theta = _flat(_trainable(network))
        theta -= rate * np.sign(BETAS[0] * momentum + (1 - BETAS[0]) * grad)
        momentum *= BETAS[1]
        momentum += (1 - BETAS[1]) * grad
        _assign(_trainable(network), theta)
        taken += 1
        _update_norms(network, _flat(stats), step + taken)
        guess = logits.argmax(axis=1)
        support += np.bincount(y[chosen], minlength=classes)
        predicted += np.bincount(guess, minlength=classes)
        hits += np.bincount(y[chosen][guess == y[chosen]], minlength=classes)
        total += loss
    return {"loss": total, "steps": taken, "counts": np.concatenate([support, predicted, hits])}


def _epoch(stored: DataFrame, network: Network, momentum: np.ndarray, workers: int, rate: float, batch_rows: int, step: int, seed: int, epoch: int, dropout: bool) -> dict:
    """All workers' passes over their rows, averaged by rows."""
    shared = stored.sparkSession.sparkContext.broadcast((network, momentum))
    worker = F.pmod(F.xxhash64("key", F.lit(seed), F.lit(epoch)), F.lit(workers)).cast("int")
    order = F.xxhash64(F.lit(epoch), F.lit(seed), "key")

    def run(table: pa.Table) -> pa.Table:
        start, moving = shared.value
        own, own_momentum = copy_network(start), moving.copy()
        table = table.sort_by([("order", "ascending"), ("key", "ascending")])
        number = table.column("worker")[0].as_py()
        x, y = batch_matrix(table.column("embedding").combine_chunks()), table.column("label_id").to_numpy()
        done = local_epoch(own, own_momentum, x, y, rate, batch_rows, step, f"{seed}:{epoch}:{number}" if dropout else "")
        rows = len(y)
        copy = rows * np.concatenate([_flat(_trainable(own)), own_momentum, _flat(_norms(own))])
        whole = np.concatenate([copy, done["counts"], [done["loss"], done["steps"] * rows, rows]])
        starts = range(0, len(whole), BLOCK)
        return pa.table(
            {
                "block": pa.array(range(len(starts)), pa.int32()),
                "part": pa.array([number] * len(starts), pa.int32()),
                "payload": pa.array([whole[s : s + BLOCK].tobytes() for s in starts], pa.binary()),
            }
        )

    dealt = stored.select("key", "embedding", "label_id", worker.alias("worker"), order.alias("order"))
    partials, parts = dealt.groupBy("worker").applyInArrow(run, _PARTIAL), workers
    while parts > FAN_IN:
        partials = partials.withColumn("part", (F.col("part") / FAN_IN).cast("int"))
        partials = _sum_blocks(partials, "block", "part")
        parts = -(-parts // FAN_IN)
    # A few blocks per network: their number depends on its size, not on the rows.
    summed = sorted(_sum_blocks(partials, "block").collect(), key=lambda r: r["block"])
    shared.destroy()
    values = np.concatenate([np.frombuffer(r["payload"], dtype=np.float64) for r in summed])
    size, norms, classes = len(momentum), sum(a.size for a in _norms(network)), len(network[-1].bias)
    rows = values[-1]
    _assign(_trainable(network), values[:size] / rows)
    momentum[...] = values[size : 2 * size] / rows
    _assign(_norms(network), values[2 * size : 2 * size + norms] / rows)
    counts = values[2 * size + norms : -3].reshape(3, classes)
    return {"counts": counts, "loss": float(values[-3] / rows), "steps": max(1, round(values[-2] / rows)), "rows": int(rows)}


def _update_norms(network: Network, stats: np.ndarray, step: int) -> None:
    """Running means that weigh the first steps fully instead of the start values."""
    share = NORM_MOMENTUM / (1.0 - (1.0 - NORM_MOMENTUM) ** step)
    start = 0
    for layer in network:
        if layer.norm is None:
            continue
        width = len(layer.bias)
        for kind in ("bn_mean", "bn_var"):
            layer.norm[kind] += share * (stats[start : start + width] - layer.norm[kind])
            start += width


def _macro(support: np.ndarray, predicted: np.ndarray, hits: np.ndarray) -> dict[str, float]:
    """Macro measures of counts per class, over the classes that occur."""
    seen = (support + predicted) > 0

    def mean(part, whole):
        return float(np.divide(part, whole, out=np.zeros_like(part), where=whole > 0)[seen].mean())

    recall = mean(hits, support)
    return {
        "acc": recall,
        "f1_score": mean(2 * hits, support + predicted),
        "precision": mean(hits, predicted),
        "recall": recall,
    }


def validate(val: DataFrame, network: Network) -> dict[str, float]:
    """Loss and measures on validation rows: one scoring pass combined to three counts per class.
    Accuracy is micro, the others are macro."""
    cells = (
        mlp_forward(val.select("embedding", "label_id"), network)
        .groupBy(F.col("label_id").alias("true_id"), V.argmax(F.col("logits")).alias("pred_id"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(V.row_cross_entropy(F.col("logits"), F.col("label_id"))).alias("loss"),
        )
    )
    sides = F.array(
        F.struct(F.col("true_id").alias("id"), F.col("n").alias("support"), F.lit(0).alias("predicted"), "loss"),
        F.struct(F.col("pred_id").alias("id"), F.lit(0).alias("support"), F.col("n").alias("predicted"), F.lit(0.0).alias("loss")),
    )
    hit = F.when((F.col("true_id") == F.col("pred_id")) & (F.col("s.support") > 0), F.col("n")).otherwise(0)
    per_class = cells.withColumn("s", F.explode(sides)).groupBy("s.id").agg(
        F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum(hit).alias("hits"), F.sum("s.loss").alias("loss")
    )
    found = per_class.collect()  # one row per class
    if not found:
        return {}
    support, predicted, hits = (np.array([float(r[c]) for r in found]) for c in ("support", "predicted", "hits"))
    measures = _macro(support, predicted, hits)
    measures["acc"] = float(hits.sum() / support.sum())
    measures["loss"] = sum(r["loss"] for r in found) / float(support.sum())
    return measures


def _store(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Labelled rows with a vector, as a table in the shared folder. Rows whose image failed have
    no vector and take no part."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    known = rows.filter((F.col("label_id") >= 0) & F.col("embedding").isNotNull())
    known.select(F.col("embedding_index").alias("key"), "embedding", "label_id").write.parquet(path)
    return spark.read.schema("key long, embedding array<float>, label_id int").parquet(path), path


def fit_mlp(
    train: DataFrame,
    val: DataFrame | None = None,
    hidden: Sequence[int] = HIDDEN_UNITS,
    epochs: int = 100,
    batch_rows: int = BATCH_ROWS,
    lr: float = LR_START,
    lr_end: float = LR_END,
    dropout: bool = True,
    validate_every: int = VALIDATE_EVERY,
    patience: int = PATIENCE,
    seed: int = SEED,
    worker_rows: int = WORKER_ROWS,
    start: Network | None = None,
    epoch: Callable[..., dict] = _epoch,
) -> Fitted:
    """Train on ``(embedding_index, embedding, label_id)``. The number of workers follows the rows;
    ``epoch`` makes one pass over them (``synchronous`` has another one); input size and number of classes come from the data, the network begins with ``start`` or with
    seeded numbers. What is stored on the way is removed at the end."""
    spark = train.sparkSession
    stored, train_path = _store(train, "train")
    shape = stored.agg(F.max("label_id"), F.max(F.size("embedding")), F.count(F.lit(1))).first()
    if shape[0] is None:
        raise ValueError("no labelled rows to train on")
    classes, inputs = shape[0] + 1, shape[1]
    paths = [train_path]
    if val is not None:
        val, val_path = _store(val, "val")
        paths.append(val_path)
        top = val.agg(F.max("label_id")).first()[0]
        classes = max(classes, (top if top is not None else -1) + 1)

    sizes = [inputs, *hidden, classes]
    check_size(3 * sum((n + 3) * m for n, m in zip(sizes[:-1], sizes[1:])))
    network = copy_network(start) if start is not None else new_network(sizes, seed)
    momentum = np.zeros(sum(a.size for a in _trainable(network)))
    workers = max(1, -(-shape[2] // worker_rows))
    fitted = Fitted(network, network, None)
    best, misses, step = None, 0, 0
    for number in range(epochs):
        rate = lr_end + (lr - lr_end) * (1 + math.cos(math.pi * number / epochs)) / 2
        done = epoch(stored, network, momentum, workers, rate, batch_rows, step, seed, number, dropout)
        step += done["steps"]
        fitted.history.append((number, "train", "loss", done["loss"]))
        fitted.history += [(number, "train", name, v) for name, v in _macro(*done["counts"]).items()]
        if val is None or (number + 1) % validate_every:
            continue
        measures = validate(val, network)
        fitted.history += [(number, "val", name, float(v)) for name, v in measures.items()]
        recall = measures.get("recall", float("nan"))
        if best is None or recall > best:
            fitted.best, fitted.best_epoch = copy_network(network), number
        if not math.isfinite(recall):
            fitted.stopped = True
        elif best is None or recall - MIN_DELTA > best:
            best, misses = recall, 0
        else:
            misses += 1
            fitted.stopped = misses >= patience
        if fitted.stopped:
            break
    fitted.last = network
    for path in paths:
        remove_scratch(spark, path)
    return fitted


def fit_builtin_mlp(
    train: DataFrame, hidden: Sequence[int], max_iter: int = 100, seed: int = SEED, block_size: int = BATCH_ROWS
):
    """The same task with MLlib's own network (sigmoid units, L-BFGS)."""
    train = train.filter((F.col("label_id") >= 0) & F.col("embedding").isNotNull())
    labelled = train.select(
        array_to_vector(V.doubles(F.col("embedding"))).alias("features"),
        F.col("label_id").cast("double").alias("label"),
    )
    shape = train.agg(F.max("label_id"), F.max(F.size("embedding"))).first()
    classifier = MultilayerPerceptronClassifier(
        layers=[shape[1], *hidden, shape[0] + 1], maxIter=max_iter, seed=seed, blockSize=block_size
    )
    return classifier.fit(labelled)


def predict_builtin(df: DataFrame, model) -> DataFrame:
    scored = model.transform(
        df.withColumn("features", array_to_vector(V.doubles(F.col("embedding"))))
    )
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias("predicted_class"),
        F.array_max(vector_to_array("probability")).alias("confidence_score"),
    )
