"""Classifiers, cross-validation and model comparison.

Training runs on executors through MLlib; the driver only holds loop state (fold ids, AdaBoost
stump weights) and small metric tables. Folds come from ``sampling.add_folds`` (seeded,
stratified), so every comparison is reproducible.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from casebook.operators import forest as FR
from casebook.operators import histboost as HB
from casebook.operators import kernels as KN
from casebook.operators import metrics as MT
from casebook.operators import neighbours as NB
from casebook.operators import perceptron as PC
from casebook.session import stage


def with_features(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """Array column → ML vector (JVM-side conversion)."""
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


# ---------------------------------------------------------------- M6: Gaussian naive Bayes


def _likelihoods(v, model, eps):
    """Per class of ``model`` (array of (y, lp, s: array of (mu, var))) its log-likelihood, and -y to break ties."""
    def likelihood(c):
        def term(xj, s):
            var = s["var"] + eps
            return -0.5 * (F.log(2 * math.pi * var) + (xj - s["mu"]) * (xj - s["mu"]) / var)

        terms = F.zip_with(v, c["s"], term)
        return F.struct(F.round(F.aggregate(terms, F.lit(0.0), lambda t, w: t + w) + c["lp"], 9).alias("ll"), (-c["y"]).alias("ny"))

    return F.transform(model, likelihood)


MODEL = "array<struct<y:int,lp:double,s:array<struct<mu:double,var:double>>>>"


def fold_moments(df: DataFrame, x: str, fold: str, label: str) -> dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]]:
    """By (fold, class): rows, and per feature the mean and the sum of squared deviations. One pass over the
    rows; folds x classes x features numbers reach the driver."""
    long = df.select(F.col(fold).cast("int").alias("f"), F.col(label).cast("int").alias("y"), F.posexplode(F.col(x).cast("array<double>")).alias("j", "v"))
    per = long.groupBy("f", "y", "j").agg(F.count("v").alias("n"), F.avg("v").alias("mu"), (F.var_pop("v") * F.count("v")).alias("m2"))
    out: dict[tuple[int, int], list] = {}
    for r in per.orderBy("j").collect():
        out.setdefault((r["f"], r["y"]), []).append((r["n"], r["mu"], r["m2"]))
    return {key: (rows[0][0], np.array([r[1] for r in rows]), np.array([r[2] for r in rows])) for key, rows in out.items()}


def merged(moments: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Moments of the union of disjoint row sets."""
    n = sum(m[0] for m in moments)
    mu = sum(m[0] * m[1] for m in moments) / n
    return n, mu, sum(m[2] + m[0] * (m[1] - mu) ** 2 for m in moments)


def nb_model(moments: dict[int, tuple[int, np.ndarray, np.ndarray]], var_smoothing: float) -> tuple[list, float]:
    """(model, variance floor) from the classes' moments."""
    n, _, m2 = merged(list(moments.values()))
    model = [(y, math.log(c / n), [(float(a), float(b)) for a, b in zip(mu, dev / c)]) for y, (c, mu, dev) in sorted(moments.items())]
    return model, float((m2 / n).max() * var_smoothing)


def _nb_scored(test: DataFrame, x: str, model, eps) -> DataFrame:
    scored = test.withColumn("_all", _likelihoods(F.col(x).cast("array<double>"), model, eps)).withColumn("_best", F.array_max("_all"))
    return scored.withColumn("prediction", (-F.col("_best.ny")).cast("int")).withColumn(
        "score", F.element_at("_all", -1)["ll"] - F.element_at("_all", 1)["ll"]).drop("_all", "_best", "_model", "_eps")


def gaussian_nb(train: DataFrame, test: DataFrame, id_col: str, x: str, label: str = "label",
                var_smoothing: float = 1e-9) -> DataFrame:
    """M6: sklearn-style Gaussian NB: per (class, feature) mean and population variance (one pass of partial
    aggregates), variance smoothing ``var_smoothing·max_j var(x_j)``, log prior + Σ_j log N(x_j; μ, σ²), argmax (ties →
    lower class). Returns the test rows with ``prediction`` and ``score`` (log-likelihood margin of the last class)."""
    moments = {y: m for (_, y), m in fold_moments(train.withColumn("_fold", F.lit(0)), x, "_fold", label).items()}
    model, eps = nb_model(moments, var_smoothing)
    held = train.sparkSession.createDataFrame([(model, eps)], f"_model {MODEL}, _eps double")
    one = lambda c: held.select(c).scalar()
    # Scalar subqueries may not stand inside a lambda, so they become columns first.
    return _nb_scored(test.withColumn("_model", one("_model")).withColumn("_eps", one("_eps")), x, F.col("_model"), F.col("_eps"))


def nb_out_of_fold(df: DataFrame, id_col: str, x: str, fold: str = "fold", label: str = "label", only_fold: int | None = None,
                   var_smoothing: float = 1e-9) -> DataFrame:
    """M6 out of fold: every row scored by the classes' statistics over the other folds. The moments of every
    (fold, class) come from one pass; a training set's are the union of the other folds'."""
    moments = fold_moments(df, x, fold, label)
    folds = sorted({f for f, _ in moments})
    models = []
    for held in folds if only_fold is None else [only_fold]:
        classes: dict[int, list] = {}
        for (f, y), m in moments.items():
            if f != held:
                classes.setdefault(y, []).append(m)
        if classes:
            models.append((held, *nb_model({y: merged(ms) for y, ms in classes.items()}, var_smoothing)))
    table = df.sparkSession.createDataFrame(models, f"_held int, _model {MODEL}, _eps double")  # a row a fold
    test = df.join(F.broadcast(table), F.col(fold) == F.col("_held")).drop("_held")
    return _nb_scored(test, x, F.col("_model"), F.col("_eps"))


# ---------------------------------------------------------------- M5: AdaBoost (SAMME on stumps)


class AdaBoostModel(Model):
    """Weighted vote of decision stumps ``x_j <= t → left class`` (pure Column expressions)."""

    def __init__(self, stumps: list[tuple[int, float, int]], alphas: list[float], featuresCol: str = "features"):
        super().__init__()
        self.stumps, self.alphas, self.featuresCol = stumps, alphas, featuresCol

    def _transform(self, df: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.featuresCol))
        score = F.lit(0.0)
        for (j, t, left), a in zip(self.stumps, self.alphas):
            pred = F.when(x[j] <= F.lit(t), F.lit(left)).otherwise(F.lit(1 - left))
            score = score + F.lit(a) * (2 * pred - 1)
        return (df.withColumn("score", score).withColumn("prediction", (F.col("score") > 0).cast("double"))
                .withColumn("rawPrediction", array_to_vector(F.array(-F.col("score"), F.col("score")))))


class AdaBoost(Estimator):
    """M5: discrete SAMME boosting of decision stumps (two classes). Features are cut once into
    ``max_bins`` bins at approximate quantiles; every round is one grouped aggregate of the sample
    weights per (feature, bin) — a table of features × bins rows, read on the driver to pick the
    split with the lowest weighted error — and one weight update (cached; a Parquet stage every few
    rounds bounds the lineage). Stops early on a perfect or useless stump."""

    def __init__(self, n_estimators: int = 50, learning_rate: float = 1.0, labelCol: str = "label",
                 featuresCol: str = "features", max_bins: int = 32, checkpoint_every: int = 10):
        super().__init__()
        self.n_estimators, self.learning_rate, self.max_bins = n_estimators, learning_rate, max_bins
        self.labelCol, self.featuresCol, self.checkpoint_every = labelCol, featuresCol, checkpoint_every

    def copy(self, extra=None):
        extra = extra or {}
        return AdaBoost(extra.get("n_estimators", self.n_estimators), extra.get("learning_rate", self.learning_rate),
                        self.labelCol, self.featuresCol, self.max_bins, self.checkpoint_every)

    def _edges(self, df: DataFrame) -> list[list[float]]:
        x = vector_to_array(F.col(self.featuresCol))
        d = len(df.select(self.featuresCol).first()[0])
        wide = df.select(*[x[j].alias(f"f{j}") for j in range(d)])
        probs = [i / self.max_bins for i in range(1, self.max_bins)]
        qs = wide.approxQuantile([f"f{j}" for j in range(d)], probs, 0.001)  # d × (bins − 1) values
        return [sorted(set(q)) for q in qs]

    def _fit(self, df: DataFrame) -> AdaBoostModel:
        edges = self._edges(df)
        x = vector_to_array(F.col(self.featuresCol))
        def below(xj):
            return lambda e: e < xj

        bins = F.array(*[F.size(F.filter(F.array(*[F.lit(float(e)) for e in es]) if es else F.array().cast("array<double>"),
                                         below(x[j]))) for j, es in enumerate(edges)])
        n = df.count()
        cur = df.select(bins.alias("_bins"), F.col(self.labelCol).cast("int").alias("_y"),
                        F.lit(1.0 / n).alias("_w")).cache()
        stumps, alphas = [], []
        for m in range(self.n_estimators):
            stats = (cur.select("_y", "_w", F.posexplode("_bins").alias("j", "b")).groupBy("j", "b")
                     .agg(F.sum(F.when(F.col("_y") == 1, F.col("_w")).otherwise(0.0)).alias("pos"),
                          F.sum(F.when(F.col("_y") == 0, F.col("_w")).otherwise(0.0)).alias("neg"))).collect()
            best = _best_split(stats, len(edges), [len(es) for es in edges])
            err, j, b, left = best
            if err >= 0.5:
                break
            t = edges[j][b] if b < len(edges[j]) else float("inf")
            alpha = self.learning_rate * math.log((1 - err) / err) if err > 0 else 1.0
            stumps.append((j, t, left))
            alphas.append(alpha)
            if err <= 0:
                break
            pred = F.when(F.col("_bins")[j] <= b, F.lit(left)).otherwise(F.lit(1 - left))
            total = sum(r["pos"] + r["neg"] for r in stats if r["j"] == j)
            nxt = cur.withColumn("_w", F.when(pred != F.col("_y"), F.col("_w") * math.exp(alpha))
                                 .otherwise(F.col("_w")) / F.lit(total))
            nxt = stage(nxt) if (m + 1) % self.checkpoint_every == 0 else nxt.cache()
            nxt.count()
            cur.unpersist()
            cur = nxt
        cur.unpersist()
        return AdaBoostModel(stumps, alphas, self.featuresCol)


def _best_split(stats, d: int, n_edges: list[int]) -> tuple[float, int, int, int]:
    """Lowest weighted error over (feature j, bin cut b, left class); ties → smallest (j, b, class).
    ``stats`` rows: (j, b, pos, neg) weight sums; cut b sends bins ≤ b left."""
    by_j: dict[int, dict[int, tuple[float, float]]] = {}
    for r in stats:
        by_j.setdefault(r["j"], {})[r["b"]] = (r["pos"], r["neg"])
    best = None
    for j in range(d):
        cells = by_j.get(j, {})
        tot_p = sum(p for p, _ in cells.values())
        tot_n = sum(q for _, q in cells.values())
        tot = tot_p + tot_n
        lp = ln = 0.0
        for b in range(n_edges[j] + 1):
            p, q = cells.get(b, (0.0, 0.0))
            lp, ln = lp + p, ln + q
            for left, e in ((0, lp + (tot_n - ln)), (1, ln + (tot_p - lp))):
                cand = (e / tot if tot else 1.0, j, b, left)
                if best is None or cand < best:
                    best = cand
    return best


# ---------------------------------------------------------------- MLlib classifiers (M1, M2, M4, M7, M8)


def classifiers(n_features: int, n_rows: int, seed: int = 0) -> dict[str, Callable[[], Estimator]]:
    """The line-up (MLlib's, but for the forest and the network's training), with the reference's settings where MLlib has them: an L2 term
    of 1 / n on raw features (sklearn's C = 1), trees as deep as MLlib grows them (30), 100 trees, 100 boosting rounds
    of depth 6 and rate 0.3, one hidden layer of 100 for 200 steps."""
    return {
        "logreg": lambda: LogisticRegression(maxIter=100, regParam=1.0 / max(n_rows, 1), standardization=False),
        "tree": lambda: DecisionTreeClassifier(maxDepth=30, seed=seed),
        "forest": lambda: FR.Forest(trees=100, depth=30, seed=seed),
        "mlp": lambda: PC.Perceptron(n_features, hidden=100, steps=200, seed=seed),
        "svc": lambda: LinearSVC(maxIter=100, regParam=1.0 / max(n_rows, 1)),
        # On kernel features: their scales are part of the kernel, so they are not standardised.
        "kernel_svc": lambda: LinearSVC(maxIter=300, regParam=1.0 / max(n_rows, 1), standardization=False, tol=1e-6),
        "gbt": lambda: GBTClassifier(maxIter=100, maxDepth=6, stepSize=0.3, seed=seed),
    }


#: Training rows that a partition holds at least, beyond a partition a core.
PART_ROWS = 100_000


def training_parts(df: DataFrame, rows: int, at_a_time: int) -> int:
    """Partitions of a training set when so many are fitted at a time: their tasks fill the cores. Every step of a fit sends
    its sums (of trees: 64 features x 32 bins x nodes) once a partition, so more partitions only send more of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(-(-cores // at_a_time), -(-rows // PART_ROWS))


def side_by_side(spark: SparkSession, run: Callable, items: Sequence, at_a_time: int) -> list:
    """``run`` of every item, in their order, so many at a time: each thread starts its own Spark jobs."""
    with ThreadPool(at_a_time) as pool:
        return pool.map(inheritable_thread_target(spark)(run), items, chunksize=1)


def out_of_fold(make: Callable[[], Estimator], df: DataFrame, fold_col: str = "fold", label: str = "label",
                resample: Callable[[DataFrame], DataFrame] | None = None, parallel: int = 5,
                only_fold: int | None = None) -> DataFrame:
    """Every row predicted by the model trained on the other folds (resampling, if given, applied
    to the training folds only). The folds are independent, so ``parallel`` of them are fitted at a
    time (their Spark jobs run side by side). Pass a staged ``df``: each fold reads it again. With
    ``only_fold`` just that fold is predicted (a train/test split)."""
    folds = [only_fold] if only_fold is not None else sorted(r[0] for r in df.select(fold_col).distinct().collect())  # k values
    typed = df.withColumn(label, F.col(label).cast("double"))
    estimator = make()
    if resample is None and isinstance(estimator, FR.Forest):  # all folds in one plan
        return estimator.fold_predictions(typed, fold_col, folds)

    parts = training_parts(df, df.count(), min(parallel, max(len(folds), 1)))
    if resample is None and isinstance(estimator, PC.Perceptron):  # all folds in the same passes
        return estimator.fold_predictions(typed, fold_col, folds, parts)

    def one(f: int) -> DataFrame:
        train = typed.filter(F.col(fold_col) != f)
        if resample is not None:
            train = resample(train)
        train = train.coalesce(parts)
        return make().fit(train).transform(typed.filter(F.col(fold_col) == f))

    parts = side_by_side(df.sparkSession, one, folds, parallel)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def scored(pred: DataFrame, name: str, id_col: str, label: str = "label", fold_col: str = "fold") -> DataFrame:
    """(model, fold, id, label, prediction, score) of an out-of-fold table; the score is the probability
    or raw margin of class 1."""
    if "score" in pred.columns:
        score = F.col("score")
    else:
        score = vector_to_array("probability" if "probability" in pred.columns else "rawPrediction").getItem(1)
    return pred.select(F.lit(name).alias("model"), F.col(fold_col).cast("int").alias("fold"), F.col(id_col).cast("string").alias("id"),
                       F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), score.cast("double").alias("score"))


def line_up(df: DataFrame, id_col: str, x: str, n_features: int, names: Sequence[str], seed: int = 0, k: int = 3,
            ada_rounds: int = 50, xgb_rounds: int = 20, fold_col: str = "fold", label: str = "label", only_fold: int | None = None) -> DataFrame:
    """Out-of-fold predictions of the named models (MLlib's, and knn, nb, adaboost and xgb on all
    rows, svm on Nyström features), stacked as ``scored`` rows. ``df`` should be staged."""
    n = df.count()
    mllib = classifiers(n_features, n, seed)
    test = df if only_fold is None else df.filter(F.col(fold_col) == only_fold)

    def one(name: str) -> DataFrame:
        if name == "knn":
            return scored(NB.knn_classify(df, test, id_col, x, label, k=k, fold=fold_col), name, id_col, label, fold_col)
        if name == "nb":
            return scored(nb_out_of_fold(df, id_col, x, fold_col, label, only_fold), name, id_col, label, fold_col)
        if name == "adaboost":
            return scored(HB.ada_folds(df, id_col, x, label, fold_col, rounds=ada_rounds, only_fold=only_fold), name, "id")
        if name == "xgb":
            return scored(HB.newton_folds(df, id_col, x, label, fold_col, rounds=xgb_rounds, only_fold=only_fold), name, "id")
        if name == "svm":
            rbf = KN.nystroem(df, id_col, x, seed=seed)
            return scored(out_of_fold(mllib["kernel_svc"], rbf, fold_col, label, only_fold=only_fold), name, id_col, label, fold_col)
        return scored(out_of_fold(mllib[name], df, fold_col, label, only_fold=only_fold), name, id_col, label, fold_col)

    # Most steps of a fit are short jobs that leave cores free, so the models are fitted side by side.
    parts = side_by_side(df.sparkSession, one, names, len(names))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return stage(out)


def cross_validate(pred: DataFrame, by: Sequence[str] = ("model", "fold")) -> DataFrame:
    """M9: per model and fold accuracy, weighted precision, recall and F1, recall of class 1 and ROC AUC,
    as (by…, metric, value), from one pass over out-of-fold predictions."""
    by = list(by)
    t = pred.groupBy(*by).agg(*[F.count_if((F.col("label") == y) & (F.col("prediction") == p)).cast("double").alias(c)
                                for c, y, p in (("tp", 1, 1), ("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0))])
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    div = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    n, pos, neg = tp + tn + fp + fn, tp + fn, tn + fp
    p1, r1, p0, r0 = div(tp, tp + fp), div(tp, pos), div(tn, tn + fn), div(tn, neg)
    f1, f0 = div(2 * p1 * r1, p1 + r1), div(2 * p0 * r0, p0 + r0)
    weighted = lambda a, b: (a * pos + b * neg) / n
    values = {"accuracy": (tp + tn) / n, "precision_weighted": weighted(p1, p0), "recall_weighted": weighted(r1, r0),
              "f1_weighted": weighted(f1, f0), "recall": r1}
    joined = t.join(MT.auc(pred, by=by).select(*by, "auc"), by)
    values["roc_auc"] = F.col("auc")
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.round(v, 6).alias("value")) for m, v in values.items()])
    return joined.select(*by, F.explode(pairs).alias("m")).select(*by, "m.metric", "m.value")


def grid_search(pred: DataFrame, params: Sequence[str], metric: str = "recall_weighted") -> DataFrame:
    """Mean over the folds of a metric for every combination of ``params``, best first."""
    params = list(params)
    cv = cross_validate(pred, [*params, "fold"]).filter(F.col("metric") == metric)
    return cv.groupBy(*params).agg(F.round(F.avg("value"), 6).alias("mean")).orderBy(F.desc("mean"), *params)


def feature_scores(model, names: Sequence[str], spark) -> DataFrame:
    """Feature importances with names, highest first."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, imp)), "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def probability_of_one(pred: DataFrame) -> DataFrame:
    return pred.withColumn("score", vector_to_array("probability").getItem(1))
