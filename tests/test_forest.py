"""Random forest: the same trees however their growth is shared out, held-out rows left out, no model on the driver."""

import numpy as np
from pyspark.sql import functions as F

from casebook.operators import forest as FR
from casebook.operators import histboost as HB
from casebook.operators import models as MD


def frame(spark, n=600, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    y = (x[:, 1] + x[:, 3] ** 2 > 1.2).astype(int)
    rows = [(i, x[i].tolist(), int(y[i]), i % 3) for i in range(n)]
    return x, y, MD.with_features(spark.createDataFrame(rows, "k long, x array<double>, label int, fold int").repartition(3), "x")


def test_small_blocks_grow_the_same_trees(spark):
    x, y, df = frame(spark)
    got = []
    for block in (10 ** 9, 60):
        out = FR.Forest(8, 30, 1, block=block).fold_predictions(df, "fold", [0, 1, 2])
        got.append({r["k"]: (r["fold"], float(r["probability"][1]), r["prediction"]) for r in out.collect()})
    assert got[0] == got[1] and len(got[0]) == len(x)
    assert np.mean([got[0][i][2] == y[i] for i in range(len(x))]) > 0.85
    models = [FR.Forest(8, 30, 1, block=block).fit(df) for block in (10 ** 9, 60)]
    assert models[1].grown.top_gains and not models[0].grown.top_gains
    imp = [m.featureImportances.toArray() for m in models]
    assert np.allclose(*imp) and abs(imp[0].sum() - 1) < 1e-9 and set(np.argsort(imp[0])[-2:]) == {1, 3}
    same = models[0].transform(df).filter(F.col("prediction") == F.col("label")).count()
    assert same > 0.95 * len(x)


def test_no_row_is_scored_by_trees_that_saw_it(spark):
    _, _, df = frame(spark, 300)
    flipped = df.withColumn("label", F.when(F.col("fold") == 1, 1 - F.col("label")).otherwise(F.col("label")))
    a, b = ({r["k"]: float(r["probability"][1]) for r in MD.out_of_fold(lambda: FR.Forest(5, 30, 3), d).collect()} for d in (df, flipped))
    assert all(a[i] == b[i] for i in a if i % 3 == 1) and any(a[i] != b[i] for i in a if i % 3 != 1)
    assert {r["fold"] for r in MD.out_of_fold(lambda: FR.Forest(5, 30, 3), df, only_fold=1).select("fold").distinct().collect()} == {1}


def test_a_tree_splits_where_the_impurity_falls_most():
    rng = np.random.default_rng(4)
    codes, w = rng.integers(0, 8, size=(400, 3)).astype(np.uint8), rng.integers(1, 4, size=400)
    y = ((codes[:, 2] > 4) ^ (rng.random(400) < 0.1)).astype(np.int64)
    gini = lambda m: 2 * (w[m] @ y[m]) * (w[m].sum() - w[m] @ y[m]) / w[m].sum()
    gain = {(j, c): gini(np.ones(400, bool)) - gini(codes[:, j] <= c) - gini(codes[:, j] > c) for j in range(3) for c in range(7)}
    feature, cut, child, value, gains = FR.grow(codes, y, w, 0, 1, FR.run_key(0, 0, 0), 3, 9)
    assert (feature[0], cut[0]) == max(gain, key=gain.get) and np.isclose(gains.sum(), max(gain.values()))
    left = codes[:, feature[0]] <= cut[0]
    assert np.allclose(value[1:], [w[m] @ y[m] / w[m].sum() for m in (left, ~left)]) and (feature[1:] == -1).all()
    assert np.allclose(FR.votes(feature, cut, child, value, codes), np.where(left, value[1], value[2]))


def test_constant_rows_and_draws(spark):
    rows = [(i, [1.0, float("nan")], i % 2, i % 2) for i in range(40)]
    df = MD.with_features(spark.createDataFrame(rows, "k long, x array<double>, label int, fold int"), "x")
    out = FR.Forest(3, 30, block=4).fold_predictions(df, "fold", [0, 1]).collect()
    assert len(out) == 40 and all(r["prediction"] != r["label"] for r in out)  # a fold holds one class only
    times = FR.draws(FR.run_key(1, 2, 3), np.arange(200_000))
    assert abs(times.mean() - 1) < 0.01 and abs((times == 0).mean() - np.exp(-1)) < 0.01
    tried = FR.features_of(FR.run_key(1, 2, 3), np.arange(4000), 9, 3)
    assert (np.diff(tried, axis=1) > 0).all() and abs(np.bincount(tried.reshape(-1)) / 4000 - 1 / 3).max() < 0.05
