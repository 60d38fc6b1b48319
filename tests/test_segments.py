import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from kestrel.operators.segments import SegmentedModel, fit_segments


def newton(x, y):
    x, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w = w + np.linalg.pinv((x * (p * (1 - p))[:, None]).T @ x) @ (x.T @ (y - p))
    return w


def sample(spark, segments, per, seed=1):
    rng = np.random.default_rng(seed)
    s = np.repeat(np.arange(segments), per)
    x = rng.normal(size=(len(s), 2))
    slope = rng.normal(size=(segments, 2))
    y = (rng.random(len(s)) < 1 / (1 + np.exp(-(x * slope[s]).sum(1) - 0.3))).astype(float)
    df = spark.createDataFrame([(int(a), float(b), float(c), float(d)) for a, (b, c), d in zip(s, x, y)], "s int, a double, b double, label double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).repartition(6), s, x, y


@pytest.mark.parametrize("segments,per", [(2, 300), (200, 60)])
def test_equals_a_fit_of_each_segment(spark, segments, per):
    df, s, x, y = sample(spark, segments, per)
    table = fit_segments(df, "s").collect()
    assert len(table) == segments
    for r in table:
        if r.converged:
            assert np.allclose(r.weights, newton(x[s == r.segment], y[s == r.segment]), atol=1e-5)
    assert sum(r.converged for r in table) >= segments - 2 and max(r.steps for r in table if r.converged) < 20


def test_routing_by_join(spark):
    df, s, x, y = sample(spark, 3, 200)
    model = SegmentedModel("s", fit_segments(df, "s"))
    w = {r.segment: np.array(r.weights) for r in model.table.collect()}
    new = df.limit(40).withColumn("s", F.when(F.col("a") > 0.5, 77).when(F.col("a") < -1, None).otherwise(F.col("s")))
    got = model.transform(new).collect()
    assert len(got) == new.count()
    for r in got:  # unknown and null segments: the model of the greatest one
        z = np.array([r.a, r.b, 1.0]) @ w[r.s if r.s in w else 2]
        assert r.prediction == float(z > 0) and r.probability == pytest.approx(1 / (1 + np.exp(-z)))
    assert {(r.model, r.feature) for r in model.report(("a", "b"), "m").collect()} == {(f"m[s={i}]", f) for i in range(3) for f in ("a", "b", "intercept")}


def test_constant_features_and_separable_segments_end(spark):
    rows = [(1, 1.0, 5.0, float(i % 2)) for i in range(10)] + [(2, float(i), 0.0, float(i > 4)) for i in range(10)] + [(None, 1.0, 1.0, 1.0)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "s int, a double, b double, label double"))
    table = {r.segment: r for r in fit_segments(df, "s").collect()}
    assert set(table) == {1, 2} and table[1].converged and np.allclose(table[1].weights, 0)
    model = SegmentedModel("s", fit_segments(df, "s"))
    assert all(r.prediction == r.label for r in model.transform(df.where("s = 2")).collect())
    assert fit_segments(df.where("s = 9"), "s").count() == 0
