"""Kernel SVC by Nyström features against an exact solver of the kernel problem."""

import numpy as np
from pyspark.sql import functions as F

from casebook.operators import kernels as KN
from casebook.operators import models as MD
from casebook.session import stage


def table(n=900, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = ((x[:, 0] ** 2 + x[:, 1] ** 2 > 1.8) ^ (rng.random(n) < 0.03)).astype(int)  # no plane parts these
    return x, y


def exact_svc(x, y, gamma, c=1.0, steps=200_000):
    """The kernel SVC's dual by pairs of the largest violation (SMO)."""
    k, t = KN.rbf(x, x, gamma), 2.0 * y - 1
    a, g = np.zeros(len(t)), -np.ones(len(t))
    for _ in range(steps):
        up, low = np.where(((t > 0) & (a < c)) | ((t < 0) & (a > 0)), -t * g, -np.inf), np.where(((t > 0) & (a > 0)) | ((t < 0) & (a < c)), -t * g, np.inf)
        i, j = int(up.argmax()), int(low.argmin())
        if up[i] - low[j] < 1e-3:
            break
        step = (up[i] - low[j]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        step = min(step, c - a[i] if t[i] > 0 else a[i], a[j] if t[j] > 0 else c - a[j])
        a[i] += t[i] * step
        a[j] -= t[j] * step
        g += step * t * (k[i] - k[j])
    b = (up[i] + low[j]) / 2
    return lambda z: KN.rbf(z, x, gamma) @ (a * t) + b


def test_agrees_with_the_exact_kernel_svc(spark):
    x, y = table()
    rows = [(i, v.tolist(), int(c), int(i % 3 == 0)) for i, (v, c) in enumerate(zip(x, y))]
    df = stage(spark.createDataFrame(rows, "k long, x array<double>, label int, fold int").repartition(4))
    made = KN.nystroem(df, "k", "x")
    gamma = 1.0 / (4 * x.var())
    assert abs(KN.scale_of(df, "x") - gamma) < 1e-9
    train = np.arange(len(x)) % 3 != 0
    pred = MD.out_of_fold(MD.classifiers(4, int(train.sum()))["kernel_svc"], made, only_fold=1)
    got = {r["k"]: int(r["prediction"]) for r in pred.select("k", "prediction").collect()}
    held = np.flatnonzero(~train)
    exact = (exact_svc(x[train], y[train], gamma)(x[held]) > 0).astype(int)
    agree = np.mean([got[int(i)] == e for i, e in zip(held, exact)])
    plain = np.mean(exact == y[held])
    assert agree >= 0.97 and plain > 0.85 and np.mean([got[int(i)] == y[i] for i in held]) > 0.85, (agree, plain)


def test_features_give_back_the_kernel(spark):
    x, _ = table(200)
    df = stage(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k long, x array<double>"))
    marks = KN.landmarks(df, "k", "x", 0.2, width=120)
    features = KN.rbf(x, marks, 0.2) @ KN.whitening(marks, 0.2)
    assert len(marks) <= 120 and np.abs(features @ features.T - KN.rbf(x, x, 0.2)).mean() < 0.005


def test_odd_tables(spark):
    schema = "k long, x array<double>, label int, fold int"
    assert KN.nystroem(spark.createDataFrame([], schema), "k", "x").count() == 0
    df = spark.createDataFrame([(1, [1.0, 2.0], 1, 0), (1, [1.0, 2.0], 0, 1), (2, None, 1, 0)], schema)
    out = KN.nystroem(df, "k", "x").select(F.col("k"), "features").collect()
    assert [r["k"] for r in out] == [1, 1] and out[0]["features"] == out[1]["features"]
