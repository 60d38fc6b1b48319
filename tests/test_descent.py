import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators.descent import dense_rows, fit_descent


def descended(x, y, n, iterations, reg=0.0, tol=0.0):
    w = np.zeros(x.shape[1])
    for i in range(1, iterations + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -700, 700)))
        size = 1 / np.sqrt(i)
        moved = w * (1 - size * reg) - size * (x.T @ ((p - y) * n)) / n.sum()
        done, w = np.linalg.norm(moved - w) < tol * max(1, np.linalg.norm(moved)), moved
        if done:
            return w, i
    return w, iterations


def test_recorded_predictions(spark):
    # fixed values: four parsed rows, two test rows and their recorded predictions
    rows = [(1.0, 12.0, 15.0), (1.0, 17.0, 34.0), (1.0, 56.0, 67.0), (0.0, 24.0, 45.0)]
    model = fit_descent(dense_rows(spark.createDataFrame(rows, "label double, a double, b double"), ["a", "b"], "label"), 2)
    test = dense_rows(spark.createDataFrame([(14.0, 16.2, 1.0), (25.0, 43.2, 0.0)], "a double, b double, want double"), ["a", "b"], "want")
    assert [r.prediction == r.want for r in model.predict(test).collect()] == [True, True]
    data = np.array(rows)
    assert np.allclose(model.weights, descended(data[:, 1:], data[:, 0], np.ones(4), 100, tol=0.001)[0])


@pytest.mark.parametrize("reg,tol", [(0.0, 0.0), (0.1, 0.02)])
def test_equals_the_same_steps_in_numpy(spark, reg, tol):
    """Sparse rows over several tasks, weighted rows, slots that no row has, an early stop."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 3, (60, 6)) * (rng.random((60, 6)) < 0.4)
    y, n = (x[:, 0] + rng.random(60) > 1).astype(float), rng.integers(1, 5, 60)
    rows = [(float(y[i]), int(n[i]), np.flatnonzero(x[i]).tolist(), x[i][x[i] > 0].astype(float).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "label double, n int, slots array<int>, values array<double>").repartition(5)
    model = fit_descent(df, 8, iterations=15, reg=reg, tol=tol)
    want, steps = descended(np.c_[x, np.zeros((60, 2))], y, n.astype(float), 15, reg, tol)
    assert np.allclose(model.weights, want) and model.steps == steps and (tol == 0 or steps < 15)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "label double, slots array<int>, values array<double>")
    model = fit_descent(empty, 3)
    assert model.steps == 0 and not model.weights.any()
    assert model.predict(spark.createDataFrame([([0], [1.0])], "slots array<int>, values array<double>")).select(F.sum("prediction")).first()[0] == 0.0
