"""The full-batch subgradient solver."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortlab.plans import subgradient as S


def plain(x, y, reg, bias, iterations):
    x = np.hstack([x, np.full((len(x), 1), float(bias))])
    w = np.zeros(x.shape[1])
    for t in range(1, iterations + 1):
        g = np.zeros_like(w)
        for a, b in zip(x, y):
            if b * (a @ w) < 1:
                g -= b * a
        w = w * (1 - reg / np.sqrt(t)) - g / max(len(x), 1) / np.sqrt(t)
    return w


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(180, 4))
    y = np.where(x @ [1.0, -2.0, 0.5, 0.0] + rng.normal(size=180) > 0.3, 1.0, 0.0)
    rows = [(i, [float(v) for v in a], float(b), i % 5) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "pid long, features array<double>, label double, fold int").repartition(5).cache()
    df.count()
    return df, x, np.where(y > 0, 1.0, -1.0)


@pytest.mark.parametrize("local", [S.LOCAL_BYTES, 0])
def test_weights_equal_plain_descent(points, local):
    df, x, y = points
    tr = [S.Trajectory(b, r, f) for b in (True, False) for r in (0.1, 2.0) for f in (S.NO_FOLD, 2)]
    got = S.descend(df, tr, [12, 5], fold="fold", local_bytes=local)
    fold = np.arange(len(x)) % 5
    for t in (5, 12):
        for k, m in enumerate(tr):
            want = plain(x[fold != m.held_out], y[fold != m.held_out], m.reg, m.intercept, t)
            assert np.allclose(got[t][k], want, rtol=1e-10, atol=1e-12)
            assert m.intercept or got[t][k][-1] == 0


def test_sparse_vectors_and_separation(points):
    df, x, y = points
    vec = df.select("label", array_to_vector("features").alias("features"))
    m = S.fit_svm_subgradient(vec, 60, 0.01)
    assert np.allclose([*m.weights, m.intercept], plain(x, y, 0.01, True, 60), rtol=1e-9)
    scored = m.score(vec).select("score", "label").collect()
    assert np.mean([(r.score > 0) == (r.label > 0) for r in scored]) > 0.85


def test_grid_has_one_winner(points):
    df, _, _ = points
    grid = {"intercept": [True], "iterations": [30, 60], "reg": [0.01, 0.1]}
    out, best = S.cv_grid_subgradient(df.drop("fold"), grid, seed=4)
    rows = out.collect()
    assert [(r.intercept, r.iterations, r.reg) for r in rows] == S.grid_points(grid) and sum(r.best for r in rows) == 1
    assert best["mean_auc"] == max(r.mean_auc for r in rows)


def test_empty_and_uneven(spark):
    none = spark.createDataFrame([], "features array<double>, label double")
    assert S.fit_svm_subgradient(none, 5).weights == []
    odd = spark.createDataFrame([([1.0], 1.0), ([1.0, 2.0], 0.0)], "features array<double>, label double")
    with pytest.raises(ValueError):
        S.fit_svm_subgradient(odd, 5)
    one = spark.createDataFrame([(1, [1.0, 2.0], 1.0)], "pid long, features array<double>, label double")
    out, best = S.cv_grid_subgradient(one, {"intercept": [True], "iterations": [3], "reg": [0.1]})
    assert out.filter(F.col("mean_auc").isNull()).count() == 1 and best["mean_auc"] is None
