import numpy as np
import pytest

from tessera_spark.operators import embeddings as E
from tessera_spark.operators import random_range
from tessera_spark.sources import append_log


def frame(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, embedding array<double>")


@pytest.mark.parametrize("n,d,k", [(300, 30, 4), (6, 5, 5)])
def test_components_equal_the_covariance_path(spark, n, d, k):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((n, d)) * np.linspace(3, 0.2, d)
    rows = frame(spark, x).repartition(5)
    a, b = (E.fit_steps(rows, standardize=False, components=k, method=m) for m in ("covariance", "randomized"))
    assert np.allclose(E.principal_components(a), E.principal_components(b), atol=1e-6)
    assert np.allclose(E.pca_model(a).explainedVariance.toArray(), E.pca_model(b).explainedVariance.toArray())
    assert np.isclose(E.explained_variance(a), E.explained_variance(b)) and E.output_dimension(b, d) == k
    got = {r["id"]: r["features"] for r in E.transform_embeddings(rows, b).collect()}
    want = {r["id"]: r["features"] for r in E.transform_embeddings(rows, a).collect()}
    assert all(np.allclose(got[i], want[i], atol=1e-6) for i in range(n))


def test_factors_over_several_levels(spark):
    x = np.random.default_rng(3).standard_normal((60, 7))
    basis = np.eye(7)[:, :3]
    r = random_range.tall_factor(frame(spark, x).select("embedding").repartition(9), basis, group=2)
    assert np.allclose(r.T @ r, (x @ basis).T @ (x @ basis))


def test_repeated_appends_change_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    one, two = (spark.createDataFrame([(k, i) for i in range(3)], "a long, b long") for k in (1, 2))

    def rows():
        return sorted(map(tuple, append_log.read(spark, path, one.schema).collect()))

    assert rows() == []
    append_log.compact(spark, path, one.schema)
    for _ in range(2):
        append_log.append(one, path, "w", 0)
    assert rows() == [(1, 0), (1, 1), (1, 2)]
    append_log.compact(spark, path, one.schema)
    append_log.append(one, path, "w", 0)
    append_log.append(two, path, "w", 1)
    want = [(k, i) for k in (1, 2) for i in range(3)]
    assert rows() == want
    append_log.compact(spark, path, one.schema)
    append_log.append(two, path, "w", 1)
    assert rows() == want and len(list((tmp_path / "log" / "compacted").iterdir())) == 1
    append_log.append(two, path)
    assert len(rows()) == 9
