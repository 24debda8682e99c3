"""Perceptron: MLlib's weights step by step, all folds in the same passes, held-out rows left out."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from casebook.operators import models as MD
from casebook.operators import perceptron as PC


def frame(spark, n=384, seed=2, parts=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = (x[:, 1] + x[:, 3] ** 2 + 0.3 * rng.normal(size=n) > 1.2).astype(int)
    rows = [(i, x[i].tolist(), float(y[i]), i % 3) for i in range(n)]
    return MD.with_features(spark.createDataFrame(rows, "k long, x array<double>, label double, fold int").repartition(parts), "x")


def test_weights_are_those_of_mllib(spark):
    """Stacks of 128 rows of a partition, the last one shorter, as MLlib has them."""
    df = frame(spark, 450, parts=2).cache()
    for steps in (2, 25):
        theirs = MultilayerPerceptronClassifier(layers=[4, 7, 2], maxIter=steps, seed=5).fit(df)
        ours = PC.Perceptron(4, 7, steps, 5).fit(df)
        assert np.allclose(ours.weights.toArray(), theirs.weights.toArray(), rtol=1e-4, atol=1e-5), steps
    got, want = (m.transform(df).select("k", "prediction").orderBy("k").collect() for m in (ours, theirs))
    assert got == want


def test_it_stops_where_mllib_stops(spark):
    rows = [(Vectors.dense([v, -v]), float(v > 0)) for v in np.linspace(-3, 3, 128)]
    df = spark.createDataFrame(rows, ["features", "label"]).coalesce(1).cache()
    theirs = MultilayerPerceptronClassifier(layers=[2, 3, 2], maxIter=500, tol=1e-3, seed=1).fit(df)
    ours = PC.Perceptron(2, 3, 500, 1, tol=1e-3).fit(df)
    assert np.allclose(ours.weights.toArray(), theirs.weights.toArray(), rtol=1e-3, atol=1e-4)


def test_a_step_of_all_folds_is_one_pass(spark, monkeypatch):
    """Before, every fold's fit had jobs of its own."""
    df, passes, plain = frame(spark, 120), [], PC.gradients

    def counted(blocks, points, *rest):
        passes.append(len(points))
        return plain(blocks, points, *rest)

    monkeypatch.setattr(PC, "gradients", counted)
    pred = MD.out_of_fold(lambda: PC.Perceptron(4, 5, 6, 1), df)
    assert pred.count() == 120 and passes[0] == 3 and len(passes) <= sum(passes) / 2
    assert isinstance(MD.classifiers(4, 120)["mlp"](), PC.Perceptron)


def test_no_row_is_scored_by_weights_that_saw_it(spark):
    df = frame(spark, 90).cache()  # else a filter moves below the repartition and stacks differ
    flipped = df.withColumn("label", F.when(F.col("fold") == 1, 1 - F.col("label")).otherwise(F.col("label")))
    a, b = ({r["k"]: float(r["probability"][1]) for r in MD.out_of_fold(lambda: PC.Perceptron(4, 5, 15, 3), d).collect()} for d in (df, flipped))
    assert all(abs(a[i] - b[i]) < 1e-5 for i in a if i % 3 == 1) and any(abs(a[i] - b[i]) > 0.01 for i in a if i % 3 != 1)
    only = {r["k"]: float(r["probability"][1]) for r in PC.Perceptron(4, 5, 15, 3).fold_predictions(df, "fold", [1], MD.training_parts(df, 90, 3)).collect()}
    assert len(only) == 30 and all(abs(only[i] - a[i]) < 1e-4 for i in only)


def test_gradients_meet_in_a_shuffle_where_they_are_many(spark, monkeypatch):
    df = frame(spark, 90)
    got = []
    for most in (PC.SUMS, 0):
        monkeypatch.setattr(PC, "SUMS", most)
        got.append(PC.Perceptron(4, 5, 3, 1).weights(df, "fold", [0, 1, 2]))
    assert all(np.array_equal(got[0][f], got[1][f]) for f in (0, 1, 2)) and not np.allclose(got[0][0], got[0][1])


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    x, y, w = np.c_[rng.normal(size=(700, 3)), np.ones(700)], rng.integers(0, 2, 700).astype(float), rng.normal(size=4 * 5 + 6 * 2)

    def sums(w):
        total = np.zeros(len(w) + 2)
        PC.add_sums(total, x, y, w, 5)
        return total

    at = sums(w)
    step = 1e-6 * np.eye(len(w))
    slope = [(sums(w + s)[1] - sums(w - s)[1]) / 2e-6 for s in step]
    assert at[0] == 700 and np.allclose(at[2:], slope, rtol=1e-4, atol=1e-4)


def test_what_mllib_refuses_is_refused(spark):
    good = (Vectors.dense([1.0, 2.0]), 1.0)
    for bad in ((Vectors.dense([1.0, float("nan")]), 0.0), (Vectors.dense([1.0, 2.0]), 2.0), (Vectors.dense([1.0, 2.0]), None), (None, 0.0)):
        df = spark.createDataFrame([good, good, bad], MD.with_features(frame(spark, 3), "x").select("features", "label").schema)
        with pytest.raises(Exception, match="must"):
            PC.Perceptron(2, 3, 2).fit(df)


def test_folds_weigh_rows_as_mllib_does(spark):
    df = frame(spark, 450, parts=3).cache()
    ours = PC.Perceptron(4, 5, 10, 1).weights(df, "fold", [0, 1, 2], 2)
    for f in (0, 2):
        theirs = MultilayerPerceptronClassifier(layers=[4, 5, 2], maxIter=10, seed=1).fit(df.filter(F.col("fold") != f).coalesce(2))
        assert np.allclose(ours[f], theirs.weights.toArray(), rtol=1e-4, atol=1e-5)
