"""Histogram boosting against plain numpy over all split points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.operators import boosting as BO
from casebook.operators import histboost as HB


def table(n=240, seed=4):
    """Few distinct values a feature, so that every split point is a bin edge; some values are missing."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 5)) * 3)
    y = ((x[:, 0] + x[:, 1] > 0) ^ (rng.random(n) < 0.1)).astype(int)
    x[rng.random(n) < 0.2, 2] = np.nan
    x[y == 1, 3] = np.where(rng.random((y == 1).sum()) < 0.5, np.nan, x[y == 1, 3])
    return x, y


def frame(spark, x, y):
    rows = [(i, [None if np.isnan(v) else float(v) for v in r], int(c), i % 3) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k long, x array<double>, label int, fold int").repartition(3)


def brute_split(x, g, h, lam, gamma, min_child):
    worth = lambda a, b: a * a / (b + lam)
    best = (0.0, None)
    for j in range(x.shape[1]):
        known = ~np.isnan(x[:, j])
        for cut in np.unique(x[known, j]):  # the last one parts missing values from all others
            for missing_left in (True, False):
                left = np.where(known, x[:, j] <= cut, missing_left)
                gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
                if hl >= min_child and hr >= min_child:
                    gain = 0.5 * (worth(gl, hl) + worth(gr, hr) - worth(g.sum(), h.sum())) - gamma
                    if gain > best[0] + 1e-9:
                        best = (gain, (j, cut, missing_left))
    return best


def brute_newton(x, y, rounds, depth, rate, lam=1.0):
    score, trees = np.zeros(len(y)), []

    def grow(rows, level, g, h):
        gain, at = brute_split(x[rows], g[rows], h[rows], lam, 0.0, 1.0) if level < depth else (0.0, None)
        if at is None:
            return -rate * g[rows].sum() / (h[rows].sum() + lam)
        j, cut, missing_left = at
        left = np.where(np.isnan(x[rows, j]), missing_left, x[rows, j] <= cut)
        return (at, grow(rows[left], level + 1, g, h), grow(rows[~left], level + 1, g, h))

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        trees.append(grow(np.arange(len(y)), 0, p - y, p * (1 - p)))
        score = score + value(trees[-1], x)
    return trees


def value(tree, x):
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    (j, cut, missing_left), low, high = tree
    left = np.where(np.isnan(x[:, j]), missing_left, x[:, j] <= cut)
    out = np.empty(len(x))
    out[left], out[~left] = value(low, x[left]), value(high, x[~left])
    return out


def test_split_gain_equals_brute_force():
    rng = np.random.default_rng(1)
    for seed in range(20):
        x, y = table(60, seed)
        p = rng.random(len(y))
        g, h = p - y, p * (1 - p)
        edges = [np.unique(c[~np.isnan(c)])[:-1] for c in x.T]
        hist = HB.histogram(HB._codes(x, edges), np.zeros(len(y), dtype=np.int64), [0], g, h, HB.missing_code(edges) + 1)[0]
        gain, j, cut, missing_left, total_g, total_h = HB.best_split(hist, 1.0, 0.01, 0.5)
        want, at = brute_split(x, g, h, 1.0, 0.01, 0.5)
        assert gain == pytest.approx(want) and (total_g, total_h) == pytest.approx((g.sum(), h.sum()))
        if at is not None:
            left = np.where(np.isnan(x[:, j]), missing_left, x[:, j] <= np.append(edges[j], np.inf)[min(cut, len(edges[j]))])
            worth = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1.0)
            assert 0.5 * (worth(left) + worth(~left) - worth(left | ~left)) - 0.01 == pytest.approx(want)


def test_newton_trees_equal_numpy(spark, monkeypatch):
    monkeypatch.setattr(HB, "STAGE_EVERY", 2)
    x, y = table()
    got = {int(r["id"]): r for r in HB.newton_folds(frame(spark, x, y), "k", "x", rounds=5, depth=3).collect()}
    assert len(got) == len(y)
    fold = np.arange(len(y)) % 3
    for f in range(3):
        held = np.flatnonzero(fold == f)
        score = sum(value(t, x[held]) for t in brute_newton(x[fold != f], y[fold != f], 5, 3, 0.3))
        assert np.allclose([got[i]["score"] for i in held], 1 / (1 + np.exp(-score)), atol=1e-9)
    assert np.mean([got[i]["prediction"] == y[i] for i in range(len(y))]) > 0.8


def test_stumps_on_all_rows_equal_the_exact_ones(spark, monkeypatch):
    monkeypatch.setattr(HB, "STAGE_EVERY", 3)
    x, y = table()
    x = np.nan_to_num(x)
    stumps = []
    out = HB.ada_folds(frame(spark, x, y), "k", "x", rates=(0.5, 1.0), rounds=8, stumps_out=stumps)
    fold = np.arange(len(y)) % 3
    for f, rate, found in stumps:
        own = fold != f
        exact = BO.boost(x[own], y[own], np.ones(own.sum()), rate, 8)
        assert len(found) == len(exact)
        for (j, edge, left, alpha), (j2, edge2, left2, alpha2) in zip(found, exact):
            assert alpha == pytest.approx(alpha2, abs=1e-9) and ((j, left) != (j2, left2) or edge == edge2)
        held = {int(r["id"]): r["score"] for r in out.filter((F.col("fold") == f) & (F.col("rate") == rate)).collect()}
        want = BO.staged_scores(found, x, (8,))[8]
        assert np.allclose([held[i] for i in np.flatnonzero(~own)], want[~own])


def test_boosting_of_odd_tables(spark):
    schema = "k long, x array<double>, label int, fold int"
    assert HB.newton_folds(spark.createDataFrame([], schema), "k", "x", rounds=2).count() == 0
    assert HB.ada_folds(spark.createDataFrame([], schema), "k", "x", rounds=2).count() == 0
    rows = [(1, [1.0, None], 1, 0), (2, [None, None], 0, 1), (3, None, 1, 0), (4, [1.0, 2.0], 1, 1), (4, [1.0, 2.0], 1, 1)]
    for fit in (HB.newton_folds, HB.ada_folds):
        assert sorted(r["id"] for r in fit(spark.createDataFrame(rows, schema), "k", "x", rounds=2).collect()) == ["1", "2", "4", "4"]
