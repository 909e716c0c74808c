import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera_spark import schemas
from tessera_spark.operators import mlp
from tessera_spark.operators import training as TR
from tessera_spark.sources import tables as IO

D, K = 5, 3


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    y = np.arange(240) % K
    centres = rng.normal(size=(K, D)) * 2
    return (centres[y] + rng.normal(size=(240, D))).astype(np.float32), y


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y = data
    listed = [(i, x[i].tolist(), int(y[i])) for i in range(len(y))]
    return spark.createDataFrame(listed, "embedding_index long, embedding array<float>, label_id int").repartition(3)


def network():
    made = TR.new_network([D, 7, 6, K], seed=2)
    rng = np.random.default_rng(4)
    for layer in made[:-1]:
        for k, v in layer.norm.items():
            layer.norm[k] = rng.uniform(0.5, 1.5, v.shape)
    return made


def plain_forward(x, net):
    for layer in net:
        x = x @ layer.weight.T + layer.bias
        if layer.norm:
            n = layer.norm
            x = (x - n["bn_mean"]) / np.sqrt(n["bn_var"] + 1e-5) * n["bn_gamma"] + n["bn_beta"]
            x = np.maximum(x, 0) + 0.02 * np.minimum(x, 0)
    return x


def test_forward_and_predict(rows, data):
    net = network()
    want = plain_forward(data[0].astype(float), net)
    got = mlp.mlp_forward(rows, net).orderBy("embedding_index").collect()
    assert np.allclose([r.logits for r in got], want)
    soft = np.exp(want - want.max(axis=1, keepdims=True))
    soft /= soft.sum(axis=1, keepdims=True)
    scored = mlp.predict(rows, net).orderBy("embedding_index").collect()
    assert [r.predicted_class for r in scored] == want.argmax(axis=1).tolist()
    assert np.allclose([r.confidence_score for r in scored], soft.max(axis=1))


def test_null_vectors_stay_null(spark):
    rows = spark.createDataFrame(
        [(0, None), (1, [1.0] * D), (2, None), (3, [2.0] * D)], "i long, embedding array<float>"
    ).coalesce(1)
    net = network()
    got = {r.i: r for r in mlp.predict(rows, net).collect()}
    assert got[0].predicted_class is None and got[2].confidence_score is None
    assert got[3].predicted_class == plain_forward(np.full((1, D), 2.0), net).argmax()
    logits = {r.i: r.logits for r in mlp.mlp_forward(rows, net).collect()}
    assert logits[0] is None and np.allclose(logits[1], plain_forward(np.ones((1, D)), net)[0])
    none = rows.filter("embedding is null")
    assert [r.predicted_class for r in mlp.predict(none, net).collect()] == [None, None]


def test_a_filter_does_not_score_twice(rows):
    for frame in (
        mlp.predict(rows, network()).filter("predicted_class = 1"),
        mlp.mlp_forward(rows, network()).filter("size(logits) > 0"),
    ):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_layers_round_trip(spark, tmp_path, monkeypatch):
    net = network()
    path = str(tmp_path / "layers")
    IO.save_layers(spark, net, path)
    back = IO.load_layers(spark, path)
    assert np.allclose(plain_forward(np.ones((2, D)), back), plain_forward(np.ones((2, D)), net))
    with pytest.raises(Exception):
        IO.load_layers(spark, str(tmp_path / "absent"))
    monkeypatch.setattr(mlp, "MAX_NETWORK_BYTES", 80)
    with pytest.raises(ValueError):
        IO.load_layers(spark, path)


def test_gradient_against_finite_differences(data):
    x, y = data[0][:20].astype(float), data[1][:20]
    net = network()
    _, grad, _, _ = TR.batch_gradient(net, x, y)
    arrays = TR._trainable(net)
    theta = TR._flat(arrays)
    rng = np.random.default_rng(0)
    for i in rng.choice(len(theta), 40, replace=False):
        moved = []
        for step in (1e-6, -1e-6):
            changed = theta.copy()
            changed[i] += step
            TR._assign(arrays, changed)
            moved.append(TR.batch_gradient(net, x, y)[0])
        TR._assign(arrays, theta)
        assert (moved[0] - moved[1]) / 2e-6 == pytest.approx(grad[i], rel=1e-4, abs=1e-4)


@pytest.mark.parametrize("block, fan_in", [(1 << 16, 64), (17, 2)])
def test_epoch_is_partition_independent(rows, data, monkeypatch, block, fan_in):
    monkeypatch.setattr(TR, "BLOCK", block)
    monkeypatch.setattr(TR, "FAN_IN", fan_in)
    found = []
    for parts in (1, 4, 17):
        fitted = TR.fit_mlp(rows.repartition(parts), hidden=(6,), epochs=3, batch_rows=16, lr=0.02, worker_rows=40)
        found.append(np.concatenate([a.ravel() for a in TR._trainable(fitted.last)]))
        assert [h[:3] for h in fitted.history if h[2] == "loss"] == [(e, "train", "loss") for e in range(3)]
    assert np.allclose(found[0], found[1], rtol=0, atol=1e-12) and np.allclose(found[0], found[2], rtol=0, atol=1e-12)


def test_one_worker_is_plain_descent(rows, data):
    x, y = data
    net = TR.new_network([D, K])
    fitted = TR.fit_mlp(rows, hidden=(), epochs=1, batch_rows=10_000, lr=0.01, dropout=False, start=net)
    _, grad, _, _ = TR.batch_gradient(net, x.astype(float), y)
    expected = TR._flat(TR._trainable(net)) - 0.01 * np.sign(grad)
    assert np.allclose(TR._flat(TR._trainable(fitted.last)), expected)


def test_default_rate_learns(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(4, 8)) * 3
    points = [(k, (centres[k % 4] + rng.normal(size=8)).tolist(), k % 4) for k in range(4000)]
    frame = spark.createDataFrame(points, "embedding_index long, embedding array<float>, label_id int")
    fitted = TR.fit_mlp(frame, hidden=(64,), epochs=12, batch_rows=32, dropout=False, validate_every=100)
    loss = [v for _, _, n, v in fitted.history if n == "loss"]
    assert loss[-1] < 0.6 * loss[0]


def test_rows_without_vector_take_no_part(spark, rows):
    broken = rows.withColumn("embedding", F.when(F.col("embedding_index") % 7 != 0, F.col("embedding")))
    fitted = TR.fit_mlp(broken, broken, hidden=(), epochs=1, validate_every=1)
    whole = TR.fit_mlp(rows.filter("embedding_index % 7 <> 0"), hidden=(), epochs=1)
    assert np.allclose(TR._flat(TR._trainable(fitted.last)), TR._flat(TR._trainable(whole.last)))
    model = TR.fit_builtin_mlp(broken, (4,), max_iter=2)
    assert model.numFeatures == D


def test_training_learns(spark, rows):
    val = rows.filter(F.col("embedding_index") % 4 == 0)
    train = rows.filter(F.col("embedding_index") % 4 != 0)
    fitted = TR.fit_mlp(
        train, val, hidden=(8,), epochs=12, batch_rows=32, lr=0.05, lr_end=0.01,
        dropout=False, validate_every=3,
    )
    loss = [v for e, p, n, v in fitted.history if (p, n) == ("train", "loss")]
    assert len(loss) == 12 and loss[-1] < 0.6 * loss[0]
    recalls = {e: v for e, p, n, v in fitted.history if (p, n) == ("val", "recall")}
    assert sorted(recalls) == [2, 5, 8, 11] and max(recalls.values()) > 0.7
    assert fitted.best_epoch == min(e for e in recalls if recalls[e] == max(recalls.values()))
    table = fitted.epoch_metrics(spark, "r1")
    assert table.schema == schemas.EPOCH_METRICS
    best = mlp.predict(val, fitted.best)
    share = best.agg(F.avg((F.col("predicted_class") == F.col("label_id")).cast("double"))).first()[0]
    assert share > 0.7


def test_training_stops_early(rows):
    fitted = TR.fit_mlp(rows, rows, hidden=(), epochs=30, lr=0.0, lr_end=0.0, validate_every=1, patience=2)
    epochs = {e for e, *_ in fitted.history}
    assert fitted.stopped and max(epochs) == 2 and fitted.best_epoch == 0


def test_builtin_network(rows):
    model = TR.fit_builtin_mlp(rows, (6,), max_iter=30)
    scored = TR.predict_builtin(rows, model)
    share = scored.agg(F.avg((F.col("predicted_class") == F.col("label_id")).cast("double"))).first()[0]
    assert share > 0.8 and scored.filter("confidence_score < 0.3").count() == 0


def test_results_table(spark, tmp_path, rows):
    scored = mlp.predict(rows, network())
    wide = scored.select(
        *[
            (F.col(f.name) if f.name in scored.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.SCORED.fields
        ]
    )
    IO.export_results(mlp.as_scored(wide), str(tmp_path / "r"))
    back = IO.read_results(spark, str(tmp_path / "r"))
    assert back.schema == schemas.SCORED and back.count() == rows.count()


def test_centroids(rows, data):
    net = mlp.centroid_network(rows)
    x, y = data
    assert np.allclose(net[0].weight, [x[y == c].astype(float).mean(axis=0) for c in range(K)])
    with pytest.raises(ValueError):
        mlp.centroid_network(rows.filter("label_id > 90"))
