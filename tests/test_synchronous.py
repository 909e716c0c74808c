"""Updates over global mini-batches against one machine that sees the whole mini-batch."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera_spark.functions import permutation as P
from tessera_spark.operators import numbering
from tessera_spark.operators import synchronous as S
from tessera_spark.operators import training as TR

D, K, ROWS = 5, 3, 240


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    y = np.arange(ROWS) % K
    return (rng.normal(size=(K, D))[y] * 2 + rng.normal(size=(ROWS, D))).astype(np.float32), y


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y = data
    listed = [(i, x[i].tolist(), int(y[i])) for i in range(ROWS)]
    return spark.createDataFrame(listed, "embedding_index long, embedding array<float>, label_id int")


def plain(data, network, steps, rate):
    x, y = data[0].astype(float), data[1]
    network = TR.copy_network(network)
    momentum = np.zeros(sum(a.size for a in TR._trainable(network)))
    for step in range(steps):
        _, grad, stats, _ = TR.batch_gradient(network, x, y)
        grad /= len(y)
        theta = TR._flat(TR._trainable(network)) - rate * np.sign(TR.BETAS[0] * momentum + (1 - TR.BETAS[0]) * grad)
        momentum = TR.BETAS[1] * momentum + (1 - TR.BETAS[1]) * grad
        TR._assign(TR._trainable(network), theta)
        TR._update_norms(network, TR._flat(stats), step + 1)
    return network


def numbers(network, skip_hidden_bias=True):
    out = []
    for layer in network:
        out.append(layer.weight.ravel())
        if layer.norm is None or not skip_hidden_bias:
            out.append(layer.bias)
        out += [] if layer.norm is None else [layer.norm["bn_gamma"], layer.norm["bn_beta"]]
    return np.concatenate(out)


@pytest.mark.parametrize("hidden", [(), (6,), (7, 6)])
def test_whole_batch_steps_equal_one_machine(rows, data, hidden):
    start = TR.new_network([D, *hidden, K], seed=5)
    want = plain(data, start, 3, 0.01)
    for parts, workers in ((1, 1), (4, 8), (17, 17)) if hidden == (6,) else ((4, 8),):
        fitted = S.fit_mlp(
            rows.repartition(parts), hidden=hidden, workers=workers, epochs=3, batch_rows=ROWS, lr=0.01, lr_end=0.01, dropout=False, start=start
        )
        assert np.allclose(numbers(fitted.last), numbers(want), rtol=0, atol=1e-12)
        for a, b in zip(fitted.last[:-1], want[:-1], strict=True):
            assert np.allclose(a.norm["bn_var"], b.norm["bn_var"])


def test_mini_batches_and_dropout_do_not_follow_partitions(rows, monkeypatch):
    monkeypatch.setattr(TR, "BLOCK", 17)
    monkeypatch.setattr(TR, "FAN_IN", 2)
    found = []
    for parts, workers in ((1, 2), (17, 9)):
        fitted = S.fit_mlp(rows.repartition(parts), rows, hidden=(6,), workers=workers, epochs=2, batch_rows=60, lr=0.02, validate_every=1)
        found.append(numbers(fitted.last))
        assert {h[2] for h in fitted.history if h[1] == "val"} >= {"recall", "loss"}
    assert np.allclose(found[0], found[1], rtol=0, atol=1e-12)


def test_no_task_holds_more_than_its_part(spark, rows):
    epochs = S.Epochs(workers=8)
    stored, path = TR._store(rows, "train")
    network = TR.new_network([D, K])
    epochs(stored, network, np.zeros(sum(a.size for a in TR._trainable(network))), 1, 0.01, ROWS, 0, 1, 0, False)
    sizes = [r["count"] for r in epochs._rows.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and sum(sizes) == ROWS and max(sizes) < 2 * ROWS / 8
    epochs.close(spark)


def test_dropped_units_follow_rows():
    keys = np.arange(4000)
    mask = S.kept_units(keys, 30, 0.7, "1:0:0:0")
    order = np.random.default_rng(0).permutation(4000)
    assert np.array_equal(S.kept_units(keys[order], 30, 0.7, "1:0:0:0"), mask[order])
    assert abs((mask > 0).mean() - 0.3) < 0.01 and np.allclose(mask[mask > 0], 1 / 0.3)
    assert not np.array_equal(S.kept_units(keys, 30, 0.7, "1:0:1:0"), mask)


def test_it_learns(rows):
    fitted = S.fit_mlp(rows, hidden=(8,), epochs=8, batch_rows=80, lr=0.05, lr_end=0.01, dropout=False)
    loss = [v for _, _, n, v in fitted.history if n == "loss"]
    assert len(loss) == 8 and loss[-1] < 0.6 * loss[0]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 1000, 4097])
def test_permutation(spark, n):
    found = [r.p for r in spark.range(n).select(P.permuted(F.col("id"), n, "7:1").alias("p")).collect()]
    assert sorted(found) == list(range(n))
    if n > 100:
        keys = P.round_keys("7:1")
        want = []
        for v in range(n):
            v = P.once(v, n, keys)
            while v >= n:
                v = P.once(v, n, keys)
            want.append(v)
        assert found == want and abs(np.corrcoef(np.arange(n), found)[0, 1]) < 0.2
        other = [r.p for r in spark.range(n).select(P.permuted(F.col("id"), n, "7:2").alias("p")).collect()]
        assert sum(a == b for a, b in zip(found, other, strict=True)) < n / 10


def test_permuted_batches_need_no_shuffle(spark):
    dealt = numbering.permuted_batches(spark.range(1000).withColumnRenamed("id", "i"), "i", 1000, 64)
    assert "Exchange" not in dealt._jdf.queryExecution().executedPlan().toString()
    sizes = sorted(r["count"] for r in dealt.groupBy("batch").count().collect())
    assert sizes == [1000 - 15 * 64] + [64] * 15


def test_large_numbers(spark):
    n = 10**10 + 7
    numbers = [0, 1, n // 2, n - 2, n - 1]
    found = [r.p for r in spark.createDataFrame([(k,) for k in numbers], "i long").select(P.permuted(F.col("i"), n, "a").alias("p")).collect()]
    keys, want = P.round_keys("a"), []
    for v in numbers:
        v = P.once(v, n, keys)
        while v >= n:
            v = P.once(v, n, keys)
        want.append(v)
    assert sorted(found) == sorted(want)
