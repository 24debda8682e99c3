"""Model smoke tests on separable data: fits within bounds, metrics consistent."""

import threading

import numpy as np
from pyspark.sql import functions as F

from casebook.functions.columns import seeded_hash
from casebook.operators import boosting as BO
from casebook.operators import metrics as MT
from casebook.operators import models as MD
from casebook.operators import neighbours as NN


def data(spark, n=200):
    df = spark.range(n).select(
        F.col("id").alias("k"),
        F.array((F.col("id") % 2) * 4.0 + F.rand(1), F.rand(2)).alias("x"),
        (F.col("id") % 2).cast("int").alias("label"))
    return MD.with_features(df, "x")


def test_adaboost_separable(spark):
    df = data(spark).withColumn("label", F.col("label").cast("double"))
    model = MD.AdaBoost(n_estimators=5).fit(df)
    acc = model.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc == 1.0


def test_gaussian_nb_and_auc(spark):
    df = data(spark)
    pred = MD.gaussian_nb(df, df, "k", "x")
    acc = pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.95
    scored = df.select("label", F.element_at("x", 1).alias("score"))
    assert MT.auc(scored).first()["auc"] == 1.0


def brute_knn(x, y, fold, k):
    out = []
    for i in range(len(x)):
        near = sorted((round(float(((x[i] - x[j]) ** 2).sum()), 6), j, y[j]) for j in range(len(x)) if fold[j] != fold[i])[:k]
        out.append(int(sum(t[2] for t in near) / k > 0.5))
    return out


def points(spark, n=90):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=n) > 0.4).astype(int)
    rows = [(i, x[i].tolist(), int(y[i]), i % 3) for i in range(n)]
    return x, y, spark.createDataFrame(rows, "k long, x array<double>, label int, fold int")


def test_knn_equals_brute_force(spark):
    x, y, df = points(spark)
    got = NN.knn_classify(df, df, "k", "x", k=5, fold="fold").orderBy("k").collect()
    assert [r["prediction"] for r in got] == brute_knn(x, y, [i % 3 for i in range(len(x))], 5)


def test_enn_keeps_what_its_neighbours_confirm(spark):
    x, y, df = points(spark)
    keep = []
    for i in range(len(x)):
        near = sorted((round(float(((x[i] - x[j]) ** 2).sum()), 6), j) for j in range(len(x)) if j != i)[:3]
        if all(y[j] == y[i] for _, j in near):
            keep.append(i)
    assert [r["k"] for r in NN.edited(df, "k", "x").orderBy("k").collect()] == keep


def test_smote_points_lie_between_a_row_and_a_near_one(spark):
    x, y, df = points(spark)
    minor = int(y.sum() < len(y) / 2)
    made = NN.smote_rows(df, "k", "x", k=4).collect()
    assert len(made) == abs(len(y) - 2 * int(y.sum()))
    for r in made:
        b, o = r["base_id"], r["neighbour_id"]
        near = sorted((round(float(((x[b] - x[j]) ** 2).sum()), 6), j) for j in range(len(x)) if y[j] == minor and j != b)[:4]
        assert y[b] == minor and o in [j for _, j in near] and 0 <= r["u"] < 1
        assert np.allclose(r["x"], x[b] + r["u"] * (x[o] - x[b]))
    both = NN.smote(df, "k", "x").groupBy("label").count().collect()
    assert len({r["count"] for r in both}) == 1


def brute_near(x, rows, k, every=1):
    """{i: [(rounded squared distance, j)]} of every n-th of ``rows`` against all of them."""
    out = {}
    for i in rows[::every]:
        d = np.zeros(len(rows))
        for c in range(x.shape[1]):
            step = x[i, c] - x[rows, c]
            d += step * step
        d = np.floor(d * 1e6 + 0.5) / 1e6
        order = np.lexsort((rows, d))
        out[i] = [(float(d[o]), int(rows[o])) for o in order if rows[o] != i][:k]
    return out


def clustered(n, d=6, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(40, d))[rng.integers(0, 40, size=n)] * 8 + rng.normal(size=(n, d))
    x[n // 3:n // 3 + n // 4] = x[0]  # one vector in a quarter of all rows
    x[-n // 10:] = np.round(x[-n // 10:])  # many equal distances
    return x


def test_index_equals_all_pairs_at_ten_thousand_rows(spark):
    x = clustered(10_000)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "k long, x array<double>, y int").repartition(6)
    rows = NN.indexed_rows(df, "k", "x", "y")
    number = {r["row"]: r["id"] for r in rows.select("row", "id").collect()}
    got = {}
    for r in NN.nearest(rows, rows, 3, block=1500, pivots=64).orderBy("q_row", "rank").collect():
        got.setdefault(number[r["q_row"]], []).append((r["d"], r["id"]))
    want = brute_near(x, np.arange(len(x)), 3, every=7)
    assert len(got) == len(x) and {i: got[i] for i in want} == want


def test_far_groups_are_not_visited():
    pivots = np.array([[0.0, 0.0], [1.0, 0.0], [100.0, 0.0], [101.0, 0.0]])
    plan = NN.Plan(pivots, [(0, c, 10, 0.5, 10, 0.5) for c in range(4)], block=20)
    assert [len(np.unique(plan.group[:2])), len(np.unique(plan.group[2:]))] == [1, 1] and plan.group[0] != plan.group[2]
    assert plan.visits({(0, c): 5.0 for c in range(4)}) == [] and len(plan.visits({(0, c): 200.0 for c in range(4)})) == 2
    assert NN.Plan(pivots, [(0, 0, 90, 1.0, 90, 1.0)], block=20).parts[0] == 5


def test_keys_are_searched_apart(spark):
    x = clustered(600, 4)
    df = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "k long, x array<double>, g int")
    rows = NN.indexed_rows(df, "k", "x", key=F.col("g"))
    number = {r["row"]: r["id"] for r in rows.select("row", "id").collect()}
    got = {}
    for r in NN.nearest(rows, rows, 4, block=100, pivots=9).orderBy("q_row", "rank").collect():
        got.setdefault(number[r["q_row"]], []).append((r["d"], r["id"]))
    assert got == brute_near(x, np.arange(0, 600, 2), 4) | brute_near(x, np.arange(1, 600, 2), 4)


def test_resampled_training_sets_leave_held_out_rows_alone(spark):
    """SMOTEENN keyed by the fold left out: the rows of a fold neither stand in its own set nor shape it."""
    x, y, df = points(spark, 150)
    out = NN.smote_enn_folds(df, "k", "x").collect()
    for f in range(3):
        kept = {r["k"]: r for r in out if r["fold"] == f}
        assert all(i < 0 or i % 3 != f for i in kept) and any(i < 0 for i in kept) == (f != 2)  # fold 2 leaves classes of one size
        alone = NN.smote_enn(df.filter(F.col("fold") != f), "k", "x")
        held = [i for i in kept if i >= 0]
        moved = df.withColumn("x", F.when(F.col("fold") == f, F.transform("x", lambda v: v * 100 + 7)).otherwise(F.col("x")))
        again = {r["k"]: r for r in NN.smote_enn_folds(moved, "k", "x").filter(F.col("fold") == f).collect()}
        assert {i: (tuple(r["x"]), r["label"]) for i, r in kept.items()} == {i: (tuple(r["x"]), r["label"]) for i, r in again.items()}
        assert alone.count() > 0 and len(held) > 50


def test_neighbours_of_nothing(spark):
    df = spark.createDataFrame([], "k long, x array<double>, label int, fold int")
    assert NN.edited(df, "k", "x").count() == NN.smote(df, "k", "x").count() == NN.smote_enn(df, "k", "x").count() == 0
    one = spark.createDataFrame([(1, [1.0], 1, 0), (2, None, 0, 1)], "k long, x array<double>, label int, fold int")
    assert [r["k"] for r in NN.edited(one, "k", "x").collect()] == [1]
    assert sorted((r["k"], r["prediction"]) for r in NN.knn_classify(one, one, "k", "x", fold="fold").collect()) == [(1, 0), (2, 0)]


def test_naive_bayes_by_fold_equals_a_fit_per_fold(spark):
    x, y, df = points(spark)
    got = {r["k"]: r for r in MD.nb_out_of_fold(df, "k", "x").collect()}
    for f in range(3):
        for r in MD.gaussian_nb(df.filter(F.col("fold") != f), df.filter(F.col("fold") == f), "k", "x").collect():
            assert got[r["k"]]["prediction"] == r["prediction"] and abs(got[r["k"]]["score"] - r["score"]) < 1e-6
        train, held = np.arange(len(x)) % 3 != f, np.flatnonzero(np.arange(len(x)) % 3 == f)
        eps = 1e-9 * x[train].var(axis=0).max()
        ll = []
        for c in (0, 1):
            part = x[train & (y == c)]
            var = part.var(axis=0) + eps
            ll.append(np.log(len(part) / train.sum()) - 0.5 * (np.log(2 * np.pi * var) + (x[held] - part.mean(axis=0)) ** 2 / var).sum(axis=1))
        assert np.allclose([got[int(i)]["score"] for i in held], ll[1] - ll[0])


def test_boosting_prefixes_equal_shorter_runs(spark):
    x, y, _ = points(spark)
    long = BO.boost(x, y, np.ones(len(y)), 0.5, 40)
    short = BO.boost(x, y, np.ones(len(y)), 0.5, 10)
    assert long[:10] == short
    scores = BO.staged_scores(long, x, (10, 40))
    assert np.allclose(scores[10], BO.staged_scores(short, x, (10,))[10])
    assert ((scores[40] > 0) == (y == 1)).mean() > ((scores[10] > 0) == (y == 1)).mean() - 0.05


def test_first_stump_is_the_best_one():
    x = np.array([[0.0, 5.0], [1.0, 4.0], [2.0, 3.0], [3.0, 2.0]])
    (j, edge, left, _), = BO.boost(x, np.array([0, 0, 1, 1]), np.ones(4), 1.0, 5)
    assert (j, edge, left) == (0, 1.0, 0)


def test_metrics_in_one_pass(spark):
    rows = [("m", 0, 1, 1, 0.9), ("m", 0, 0, 0, 0.2), ("m", 0, 0, 1, 0.9), ("m", 0, 1, 0, 0.1), ("m", 1, 1, 1, 0.8), ("m", 1, 0, 0, 0.8)]
    pred = spark.createDataFrame(rows, "model string, fold int, label int, prediction int, score double")
    got = {(r["fold"], r["metric"]): r["value"] for r in MD.cross_validate(pred).collect()}
    assert got[0, "accuracy"] == 0.5 and got[1, "accuracy"] == 1.0 and got[0, "recall"] == 0.5
    assert got[0, "roc_auc"] == 0.375 and got[1, "roc_auc"] == 0.5


def test_boosted_folds_cover_every_row_once_per_setting(spark):
    x, y, df = points(spark)
    out = BO.boosted_folds(df, "k", "x", rates=(0.1, 1.0), rounds=(5, 20))
    assert {(r["rate"], r["rounds"], r["count"]) for r in out.groupBy("rate", "rounds").count().collect()} == {
        (a, n, len(x)) for a in (0.1, 1.0) for n in (5, 20)}


def test_boosted_folds_score_rows_beyond_the_training_sample(spark):
    x, y, df = points(spark)
    got = {r["id"]: r for r in BO.boosted_folds(df, "k", "x", rounds=(5,), sample=30, seed=3).collect()}
    assert len(got) == len(x)
    for f in range(3):
        order = df.filter(F.col("fold") != f).select(F.col("k").cast("string").alias("id")).orderBy(seeded_hash(3, F.col("id")), "id")
        train = sorted((r["id"] for r in order.limit(30).collect()))
        at = [int(i) for i in train]
        stumps = BO.boost(x[at], y[at], np.ones(30), 1.0, 5)
        held = [i for i in range(len(x)) if i % 3 == f]
        want = BO.staged_scores(stumps, x[held], (5,))[5]
        assert np.allclose([got[str(i)]["score"] for i in held], want) and all(got[str(i)]["fold"] == f for i in held)


def test_boosted_folds_learn_from_all_training_rows(spark, monkeypatch):
    """More training rows than the 20,000 that a fit once took, in a task's memory and by rounds of jobs."""
    n = 44_000
    rng = np.random.default_rng(8)
    x = rng.integers(0, 60, size=(n, 2)).astype(float)
    y = ((x[:, 0] > 30) ^ (rng.random(n) < 0.3)).astype(int)
    df = spark.createDataFrame([(i, v.tolist(), int(c), i % 2) for i, (v, c) in enumerate(zip(x, y))], "k long, x array<float>, label int, fold int")
    for cells in (BO.FIT_CELLS, 0):
        monkeypatch.setattr(BO, "FIT_CELLS", cells)
        got = {int(r["id"]): r["score"] for r in BO.boosted_folds(df, "k", "x", rates=(0.5,), rounds=(4,)).collect()}
        assert len(got) == n
        for f in (0, 1):
            train, held = np.arange(n) % 2 != f, np.flatnonzero(np.arange(n) % 2 == f)
            want = BO.staged_scores(BO.boost(x[train], y[train], np.ones(train.sum()), 0.5, 4), x[held], (4,))[4]
            assert np.allclose([got[int(i)] for i in held], want)


def test_boosted_folds_learn_from_all_resampled_rows(spark):
    """More given training rows than the 20,000 that a fit once took of them."""
    n = 25_000
    rng = np.random.default_rng(10)
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] + rng.normal(size=n) > 0).astype(int)
    train = spark.createDataFrame([(i, v.tolist(), int(c), 0) for i, (v, c) in enumerate(zip(x, y))], "k long, x array<double>, label int, fold int")
    held = spark.createDataFrame([(i, v.tolist(), int(c), 0) for i, (v, c) in enumerate(zip(x[:200] + 0.1, y[:200]))], "k long, x array<double>, label int, fold int")
    got = {int(r["id"]): r["score"] for r in BO.boosted_folds(held, "k", "x", rates=(1.0,), rounds=(3,), train=train).collect()}
    want = BO.staged_scores(BO.boost(x, y, np.ones(n), 1.0, 3), x[:200] + 0.1, (3,))[3]
    assert np.allclose([got[i] for i in range(200)], want)


def test_boosting_searches_a_feature_again_only_when_it_may_win(spark):
    """The stumps are those of a search through all features and cuts, equal values and copies of a feature included."""
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(300, 6)), 1)
    x[:, 3] = x[:, 1]
    y = (x[:, 0] + x[:, 1] + rng.normal(size=300) > 1).astype(int)
    for rate in (0.01, 0.7):
        w = np.ones(300) / 300
        for j, edge, left, alpha in BO.boost(x, y, np.ones(300), rate, 60):
            wrong = [[(np.where(x[:, c] <= v, side, 1 - side) != y) @ w for v in np.unique(x[:, c])] for c in range(6) for side in (0, 1)]
            at = np.where(x[:, j] <= edge, left, 1 - left) != y
            assert abs(w @ at - min(map(min, wrong))) < 1e-9
            w = w * np.where(at, np.exp(alpha), 1.0)
            w /= w.sum()


def test_a_block_is_searched_through_the_least_of_its_groups(spark, monkeypatch):
    """Neighbours equal brute force, also of queries with parts, limits and many equal distances, and no step but the matrix
    product and one minimum looks at every pair."""
    rng = np.random.default_rng(4)
    looked, real = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, *args, **kwargs: looked.append(a.size) or real(a, *args, **kwargs))
    for x in (rng.normal(size=(3000, 8)), np.round(rng.normal(size=(3000, 2)), 1), rng.normal(size=(3000, 8)) * 1e-4 + 1e4):
        part = rng.integers(-1, 4, size=3000)
        rank = rng.permutation(3000)
        for omit, limit in ((None, None), (part, None), (None, np.full(300, 0.5))):
            looked.clear()
            q, s, d = NN.block_nearest(x[:300], np.arange(300), x, np.arange(3000), rank, 3, limit, q_omit=None if omit is None else omit[:300], s_omit=omit)
            assert sum(looked) <= 300 * 3000 / 16
            got = {}
            for i, j, far in zip(q.tolist(), s.tolist(), d.tolist()):
                got.setdefault(i, []).append((far, rank[j]))
            for i in range(300):
                far = np.zeros(3000)
                for c in range(x.shape[1]):
                    far += (x[i, c] - x[:, c]) * (x[i, c] - x[:, c])
                far = np.floor(far * 1e6 + 0.5) / 1e6
                use = np.arange(3000) != i
                if omit is not None:
                    use &= (omit != omit[i]) | (omit[i] == NN.NONE)
                if limit is not None:
                    use &= far <= limit[i]
                assert got.get(i, []) == sorted(zip(far[use].tolist(), rank[use].tolist()))[:3]


def test_what_the_search_shuffles_is_a_fixed_multiple_of_the_rows():
    """A row goes to every pair of blocks that it stands in, so the number of blocks must not grow with the rows."""
    for keys in (1, 10):
        groups = []
        for n in (40_000, 100_000, 200_000):
            stats = [(key, cell, n // 400, 9.0, n // 400, 9.0) for key in range(keys) for cell in range(400)]
            pivots = np.random.default_rng(0).normal(size=(400, 4))
            plan = NN.Plan(pivots, stats, NN.block_size(stats))
            groups.append(sum(plan.parts))
        assert max(groups) <= min(groups) + 2 and max(groups) <= (10 if keys == 1 else 5)
    assert NN.block_size([(0, 0, 10 ** 8, 1.0, 10 ** 8, 1.0)]) == NN.LARGE_BLOCK and NN.block_size([(0, 0, 10, 1.0, 10, 1.0)]) == NN.BLOCK


def test_knn_sends_a_training_row_once_whatever_the_folds(spark, monkeypatch):
    """Folds are left out in the search; the training rows are not copied once a fold."""
    _, _, df = points(spark, 90)
    seen, real = [], NN.nearest
    monkeypatch.setattr(NN, "nearest", lambda q, r, k: seen.append((q.count(), r.count())) or real(q, r, k))
    assert NN.knn_classify(df, df, "k", "x", k=5, fold="fold").count() == 90 and seen == [(90, 90)]


def test_knn_out_of_fold_among_copies(spark):
    """Equal vectors of many folds, more of them than neighbours asked for."""
    x = clustered(300, 3)
    x[::2] = x[0]
    y = (np.arange(300) % 7 == 0).astype(int)
    df = spark.createDataFrame([(i, v.tolist(), int(y[i]), i % 3) for i, v in enumerate(x)], "k long, x array<double>, label int, fold int")
    got = NN.knn_classify(df, df, "k", "x", k=5, fold="fold").orderBy("k").collect()
    assert [r["prediction"] for r in got] == brute_knn(x, y, [i % 3 for i in range(300)], 5)


def test_training_sets_have_no_more_partitions_than_fill_the_cores(spark):
    """What a fit shuffles is its sums times the partitions of its rows."""
    x, y, df = points(spark, 90)
    seen = []

    class Marked(MD.AdaBoost):
        def _fit(self, train):
            seen.append((train.rdd.getNumPartitions(), train.count()))
            return super()._fit(train)

    many = MD.with_features(df, "x").repartition(40)
    assert MD.out_of_fold(lambda: Marked(2), many).count() == 90
    assert len(seen) == 3 and all(parts <= -(-spark.sparkContext.defaultParallelism // 3) and n == 60 for parts, n in seen)
    assert MD.training_parts(df, 10_000_000, 5) == 100


def test_models_of_a_line_up_are_fitted_side_by_side(spark, monkeypatch):
    _, _, df = points(spark, 60)
    both, plain = threading.Barrier(2, timeout=60), MD.out_of_fold

    def meeting(*args, **kwargs):
        both.wait()
        return plain(*args, **kwargs)

    monkeypatch.setattr(MD, "out_of_fold", meeting)
    pred = MD.line_up(MD.with_features(df, "x"), "k", "x", 2, ["logreg", "tree"])
    assert {(r["model"], r["count"]) for r in pred.groupBy("model").count().collect()} == {("logreg", 60), ("tree", 60)}


def test_fits_of_a_grid_are_spread_over_partitions(spark):
    """Joined by size, forty small groups would lie in one partition."""
    pool = spark.range(40).selectExpr("cast(id % 4 as double) AS rate", "cast(id div 4 as int) AS fold")
    groups = BO.spread(pool, 40).select("rate", "fold", F.spark_partition_id().alias("p"))
    assert max(r["count"] for r in groups.groupBy("p").count().collect()) <= 4


def test_each_fit_of_a_grid_has_a_partition_of_its_own(spark):
    """Hashed, some fits share a partition and wait for each other."""
    rates = (0.00001, 0.2, 1.0)
    pool = spark.range(300).select(F.element_at(F.array(*[F.lit(r) for r in rates]), (F.col("id") % 3 + 1).cast("int")).alias("rate"),
                                   (F.col("id") % 10).cast("int").alias("fold"))
    order = [(r, f) for r in sorted(rates, reverse=True) for f in range(10)]
    got = BO.spread(pool, 30, order).select("rate", "fold", F.spark_partition_id().alias("p")).distinct().collect()
    assert {(r["rate"], r["fold"]): r["p"] for r in got} == {fit: i for i, fit in enumerate(order)} and len(got) == 30
