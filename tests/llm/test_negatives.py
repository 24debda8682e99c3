import math
import random
from collections import Counter

import numpy as np
import pytest

from casebook.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, _row long, q long, score double, rank int"


def make(spark, rows):
    return spark.createDataFrame([(i, x, y, 1, 2, 3.0, 4) for i, x, y in rows], SCHEMA)


def brute(rows):
    """All pairs in whole numbers."""
    use = []
    for i, x, y in rows:
        if y is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            use.append((i, (y + 1) % 10 if i is not None and i % 7 == 0 else y, [math.floor(256 * float(np.float32(c))) for c in x]))
    out = []
    last = lambda i: (i is None, i)
    for a, (i, y, q) in enumerate(use):
        if i is None or i % 50:
            continue
        scored = sorted(((-sum(s * t for s, t in zip(q, p)), last(j), z) for b, (j, z, p) in enumerate(use) if b != a), key=lambda t: t[:2])
        for ps, (_, pid), _ in [t for t in scored if t[2] == y][:5]:
            fit = [t for t in scored if t[2] != y and 50 * -ps <= 100 * -t[0] <= 95 * -ps][:3]
            out += [(i, pid, r, t[1][1], -ps, -t[0]) for r, t in enumerate(fit, 1)]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in negatives.hard_negatives(df).collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(4, 12))
    out = [(i, [float(v) for v in centres[rng.integers(4)] * 0.6 + 0.5 * rng.normal(size=12)], int(rng.integers(10))) for i in range(700)]
    out += [(i, out[i][1], out[i][2]) for i in (50, 100, 51)]  # repeated rows
    out += [(None, out[60][1], out[60][2]), (2000, None, 1), (2050, out[1][1], None), (2100, [float("nan")] * 12, 1), (2150, [float("inf")] * 12, 1),
            (2200, [None] + [0.0] * 11, 1), (2250, [], 2), (2300, [1.0, 2.0], 5), (2350, [0.0] * 12, 6), (2400, [1.0] * 15, 6)]
    return out


def test_equals_all_pairs(spark, rows, monkeypatch):
    want = brute(rows)
    assert len(want) > 50
    assert found(make(spark, rows).repartition(5)) == want
    monkeypatch.setattr(negatives, "ROW_CELL", 60)
    monkeypatch.setattr(negatives, "ANCHOR_CELL", 5)
    assert found(make(spark, rows).repartition(3)) == want


def test_great_components_stay_exact(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.uniform(-1, 1) * 2.0 ** rnd.randint(0, 20) for _ in range(6)], rnd.randint(0, 2)) for i in range(200)]
    assert found(make(spark, rows)) == brute(rows)


def test_a_scan_strikes_off_without_losing_the_best():
    """Clustered vectors: the bounds leave few candidates to the end, and the exact best are among them."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(3000, 64)) * 20 + 200 * (rng.integers(0, 30, size=3000)[:, None] == np.arange(64))).astype(np.float64)
    columns, anchor = np.ascontiguousarray(x.T), x[7]
    order, least, most = (part[0] for part in negatives.orders(x[7:8], columns))
    left, score = negatives.vertical(columns, np.arange(3000), anchor, order, least, most, negatives.nearest(5))
    exact = x @ anchor
    assert set(np.argsort(-exact)[:5]) <= set(left) and len(left) < 300 and np.array_equal(score, exact[left])
    window = (0.5 * exact.max(), 0.8 * exact.max())
    left, score = negatives.vertical(columns, np.arange(3000), anchor, order, least, most, negatives.within([window], 3))
    inside = np.flatnonzero((exact >= window[0]) & (exact <= window[1]))
    assert set(inside[np.argsort(-exact[inside])[:3]]) <= set(left) and np.array_equal(score, exact[left])


def test_copies_in_thousands(spark):
    """One vector copied to thousands of rows with other labels: ties go to the smaller ids."""
    rows = [(i, [0.5, 0.25], i % 3) for i in range(2500)] + [(5000, [1.0, 0.5], 1), (5001, [1.0, 0.5], 1)]
    got = negatives.hard_negatives(make(spark, rows)).filter("anchor_id = 5000").collect()
    assert {(r["positive_id"], r["rank"], r["negative_id"]) for r in got if r["positive_id"] == 5001} == {(5001, 1, 2), (5001, 2, 3), (5001, 3, 5)}


def test_edges(spark):
    assert negatives.hard_negatives(make(spark, [])).count() == 0
    assert negatives.hard_negatives(make(spark, [(50, [1.0], 1)])).count() == 0
    assert negatives.hard_negatives(make(spark, [(1, [1.0], 1), (2, [1.0], 2)])).count() == 0
