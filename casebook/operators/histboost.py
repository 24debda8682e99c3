"""Boosting on all rows by histograms (M5, M8): second-order trees and AdaBoost stumps.

Features are cut once, at the distinct values of a feature that has few and else at quantiles of Spark's mergeable
sketch; from then on a row is one byte a feature (a null or NaN is a byte of its own). Each level of the trees
is one Spark job for *all* runs (folds, rates) together: every task adds up its rows' gradients and hessians by (run,
node, feature, bin), a shuffle sums these histograms per node, the best split of a node is found where its sums
meet, and only that split reaches the driver. A job's work is linear in the rows; histograms have a size of
their own, whatever the rows. Scores of finished trees are staged every few rounds, so a round never walks all trees.

* ``newton_folds``: gradient boosting with Newton steps. Leaf = -G / (H + λ); the gain of a split is
  ½ (G_l² / (H_l + λ) + G_r² / (H_r + λ) - G² / (H + λ)) - γ; rows without the feature go to the side that
  gains more; a child needs a hessian of ``min_child`` at least.
* ``ada_folds``: discrete SAMME on stumps, the histograms holding the weights of the two classes. Stumps are the exact ones
  where features have no more distinct values than bins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.operators import neighbours  # noqa: F401  (registers the package for by-value pickling)
from casebook.session import stage

BINS = 32
STAGE_EVERY = 10
SCHEMA = "rate double, rounds int, fold int, id string, label int, score double, prediction int"


# ---------------------------------------------------------------- bins

def bin_edges(df: DataFrame, x: str, bins: int = BINS) -> list[np.ndarray]:
    """Ascending cut points per feature, at most ``bins`` - 1: a value lies in the bin of the number of cuts below it."""
    long = df.select(F.posexplode(F.col(x).cast("array<double>")).alias("j", "v")).filter("v is not null and not isnan(v)")
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = long.groupBy("j").agg(F.percentile_approx("v", probs, 10_000).alias("q"), F.approx_count_distinct("v").alias("n")).collect()
    edges = {r["j"]: np.unique(np.array(r["q"], dtype=float)) for r in found}
    few = [r["j"] for r in found if r["n"] <= bins * 0.9]
    if few:
        for r in long.filter(F.col("j").isin(few)).groupBy("j").agg(F.sort_array(F.collect_set("v")).alias("v")).collect():  # few values each
            if len(r["v"]) <= bins:
                edges[r["j"]] = np.array(r["v"][:-1], dtype=float)
    width = df.select(F.max(F.size(x))).first()[0] or 0
    return [edges.get(j, np.zeros(0)) for j in range(max(width, 0))]


def missing_code(edges: list[np.ndarray]) -> int:
    """The byte of a missing value: the one after the last bin of any feature."""
    return max((len(e) for e in edges), default=0) + 1


def _codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    missing = missing_code(edges)
    out = np.empty(x.shape, dtype=np.uint8)
    for j, cuts in enumerate(edges):
        out[:, j] = np.where(np.isnan(x[:, j]), missing, np.searchsorted(cuts, x[:, j], side="left"))
    return out


def binned(df: DataFrame, id_col: str, x: str, label: str, fold: str, edges: list[np.ndarray], runs: int) -> DataFrame:
    """(id, label, fold, bins, scores), staged; ``scores`` holds a run's score of the row so far."""
    rows = df.filter(F.col(x).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(label).cast("int").alias("label"), F.col(fold).cast("int").alias("fold"),
                     F.transform(F.col(x).cast("array<double>"), lambda v: F.coalesce(v, F.lit(float("nan")))).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            codes = _codes(values, edges)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("fold"), pa.array([c.tobytes() for c in codes], pa.binary()),
                                              pa.array([np.zeros(runs).tobytes()] * len(codes), pa.binary())], names=["id", "label", "fold", "bins", "scores"])

    return stage(rows.mapInArrow(run, "id string, label int, fold int, bins binary, scores binary"))


def _arrays(batch: pa.RecordBatch, runs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bins, label, fold, scores) of a batch."""
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
    scores = np.frombuffer(b"".join(batch.column("scores").to_pylist())).reshape(batch.num_rows, runs)
    return bins, batch.column("label").to_numpy(), batch.column("fold").to_numpy(), scores


# ---------------------------------------------------------------- trees

@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i + 1, 2i + 2): a split (feature, last bin of the left side, missing goes left)
    or a leaf value; ``missing`` is the byte of a missing value."""
    missing: int
    splits: dict[int, tuple[int, int, bool]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), dtype=np.int64)
        for node in sorted(self.splits):
            j, cut, missing_left = self.splits[node]
            here = np.flatnonzero(at == node)
            code = bins[here, j]
            left = np.where(code == self.missing, missing_left, code <= cut)
            at[here] = 2 * node + np.where(left, 1, 2)
        return at

    def values(self, bins: np.ndarray) -> np.ndarray:
        at, out = self.nodes(bins), np.zeros(len(bins))
        for node, value in self.leaves.items():
            out[at == node] = value
        return out


def histogram(bins: np.ndarray, node: np.ndarray, nodes: Sequence[int], a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """(node, feature, bin, 2): sums of a and b of the rows in each of ``nodes``; the last of ``width`` bins is of missing
    values."""
    d = bins.shape[1]
    place = np.full(max([*nodes, int(node.max(initial=0))]) + 1, -1)
    place[list(nodes)] = np.arange(len(nodes))
    at = place[node]
    use = np.flatnonzero(at >= 0)
    cell = ((at[use, None] * d + np.arange(d)) * width + bins[use]).reshape(-1)
    out = np.empty((len(nodes), d, width, 2))
    for k, w in enumerate((a, b)):
        out[..., k] = np.bincount(cell, weights=np.repeat(w[use], d), minlength=len(nodes) * d * width).reshape(len(nodes), d, width)
    return out


def best_split(hist: np.ndarray, lam: float, gamma: float, min_child: float) -> tuple[float, int, int, bool, float, float]:
    """(gain, feature, last bin of the left side, missing goes left, G, H) of one node's (feature, bin, 2) sums; a gain of 0
    or less is no split. Ties go to the smaller feature, then bin, then missing to the left."""
    total = hist[0].sum(axis=0)
    missing = hist[:, -1]
    low = np.cumsum(hist[:, :-1], axis=1)
    worth = lambda s: s[..., 0] ** 2 / (s[..., 1] + lam)
    best = (0.0, -1, -1, True)
    for missing_left in (True, False):
        left = low + missing[:, None] if missing_left else low
        right = total - left
        gain = 0.5 * (worth(left) + worth(right) - worth(total)) - gamma
        gain[(left[..., 1] < min_child) | (right[..., 1] < min_child)] = -np.inf
        j, cut = np.unravel_index(gain.argmax(), gain.shape)
        if gain[j, cut] > best[0] + 1e-12:
            best = (float(gain[j, cut]), int(j), int(cut), missing_left)
    return (*best, float(total[0]), float(total[1]))


def best_stump(hist: np.ndarray, n_bins: list[int]) -> tuple[float, int, int, int]:
    """(share of wrong weight, feature, last bin of the left side, class of the left side) of (feature, bin, 2) sums of the
    weights of classes 0 and 1; a missing value goes right."""
    total = hist[0].sum(axis=0)
    low = np.cumsum(hist[:, :-1], axis=1)
    best = (np.inf, 0, 0, 0)
    for left_class in (0, 1):
        wrong = low[..., 1 - left_class] + total[left_class] - low[..., left_class]
        for j in range(len(hist)):
            b = int(wrong[j, :n_bins[j]].argmin())
            best = min(best, (float(wrong[j, b] / total.sum()), j, b, left_class))
    return best


# ---------------------------------------------------------------- jobs

def _summed(rows: DataFrame, partial, pick, schema: str, width: int) -> list:
    """One job: ``partial`` yields (run, node, histogram) per task, ``pick(run, node, sum)`` a row per node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in filter(len, batches):
            for key, hist in partial(batch):
                held[key] = held[key] + hist if key in held else hist
        if held:
            yield pa.RecordBatch.from_pydict({"run": pa.array([k[0] for k in held], pa.int32()), "node": pa.array([k[1] for k in held], pa.int32()),
                                              "hist": pa.array([h.tobytes() for h in held.values()], pa.binary())})

    def best(key: tuple, group: pa.Table) -> pa.Table:
        total = None
        for h in group.column("hist"):
            part = np.frombuffer(h.as_buffer())
            total = part.copy() if total is None else total + part
        return pa.Table.from_pylist([pick(key[0].as_py(), key[1].as_py(), total.reshape(-1, width, 2))], kinds)

    arrow = {"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    kinds = pa.schema([(name, arrow[kind]) for name, kind in (c.split() for c in schema.split(", "))])
    return rows.mapInArrow(run, "run int, node int, hist binary").groupBy("run", "node").applyInArrow(best, schema).collect()


def _with_scores(rows: DataFrame, runs: int, add) -> DataFrame:
    """Rows with ``add(run, bins)`` added to each run's score, staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            bins, _, _, scores = _arrays(batch, runs)
            new = scores + np.stack([add(r, bins) for r in range(runs)], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([s.tobytes() for s in new], pa.binary())], names=batch.schema.names)

    return stage(rows.mapInArrow(run, "id string, label int, fold int, bins binary, scores binary"))


def _predictions(rows: DataFrame, runs: Sequence[tuple[int, float]], rounds: int, cut: float, shape) -> DataFrame:
    n = len(runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            _, label, fold, scores = _arrays(batch, n)
            for r, (held, rate) in enumerate(runs):
                mine = np.flatnonzero(fold == held)
                if len(mine):
                    s = shape(scores[mine, r])
                    yield pa.RecordBatch.from_pydict({
                        "rate": np.full(len(mine), rate), "rounds": np.full(len(mine), rounds, dtype=np.int32), "fold": fold[mine].astype(np.int32),
                        "id": batch.column("id").take(pa.array(mine)), "label": label[mine].astype(np.int32), "score": s, "prediction": (s > cut).astype(np.int32)})

    return rows.mapInArrow(run, SCHEMA)


def _folds(df: DataFrame, fold: str, only_fold: int | None) -> list[int]:
    return [only_fold] if only_fold is not None else sorted(int(r[0]) for r in df.select(fold).distinct().collect())  # k values


def newton_folds(df: DataFrame, id_col: str, x: str, label: str = "label", fold: str = "fold", rounds: int = 100, depth: int = 6, rate: float = 0.3,
                 lam: float = 1.0, gamma: float = 0.0, min_child: float = 1.0, bins: int = BINS, only_fold: int | None = None) -> DataFrame:
    """M8: out-of-fold predictions (rate, rounds, fold, id, label, score, prediction) of second-order boosted trees with
    logistic loss; the score is the probability of class 1. Rows with a null vector take no part."""
    folds = _folds(df, fold, only_fold)
    if not folds:
        return df.sparkSession.createDataFrame([], SCHEMA)
    edges = bin_edges(df, x, bins)
    missing = missing_code(edges)
    rows = binned(df, id_col, x, label, fold, edges, len(folds))
    trees: list[list[Tree]] = [[] for _ in folds]  # since the scores were staged
    for done in range(rounds):
        growing = [Tree(missing) for _ in folds]
        sums: list[dict[int, tuple[float, float]]] = [{} for _ in folds]
        active: list[list[int]] = [[0] for _ in folds]
        for level in range(depth):
            if not any(active):
                break

            def partial(batch, growing=growing, active=active):
                codes, y, of, scores = _arrays(batch, len(folds))
                for r, held in enumerate(folds):
                    use = np.flatnonzero(of != held)
                    if not active[r] or not len(use):
                        continue
                    own = codes[use]
                    p = 1 / (1 + np.exp(-np.clip(scores[use, r] + sum(t.values(own) for t in trees[r]), -60, 60)))
                    hist = histogram(own, growing[r].nodes(own), active[r], p - y[use], p * (1 - p), missing + 1)
                    yield from (((r, node), hist[i]) for i, node in enumerate(active[r]))

            def pick(run, node, total):
                gain, j, cut, missing_left, g, h = best_split(total, lam, gamma, min_child)
                left = total[j, :cut + 1].sum(axis=0) + (total[j, -1] if missing_left else 0.0) if j >= 0 else np.zeros(2)
                return {"run": run, "node": node, "gain": gain, "feature": j, "cut": cut, "missing_left": missing_left, "g": g, "h": h,
                        "gl": float(left[0]), "hl": float(left[1])}

            found = _summed(rows, partial, pick, "run int, node int, gain double, feature int, cut int, missing_left boolean, g double, h double, gl double, hl double", missing + 1)
            active = [[] for _ in folds]
            for s in found:
                r, node = s["run"], s["node"]
                sums[r][node] = (s["g"], s["h"])
                if s["feature"] >= 0:
                    growing[r].splits[node] = (s["feature"], s["cut"], s["missing_left"])
                    sums[r][2 * node + 1], sums[r][2 * node + 2] = (s["gl"], s["hl"]), (s["g"] - s["gl"], s["h"] - s["hl"])
                    active[r] += [2 * node + 1, 2 * node + 2]
        for r, tree in enumerate(growing):
            tree.leaves = {node: -rate * g / (h + lam) for node, (g, h) in sums[r].items() if node not in tree.splits}
            trees[r].append(tree)
        if (done + 1) % STAGE_EVERY == 0 or done == rounds - 1:
            held = trees
            rows = _with_scores(rows, len(folds), lambda r, codes, held=held: sum(t.values(codes) for t in held[r]))
            trees = [[] for _ in folds]
    return _predictions(rows, [(f, rate) for f in folds], rounds, 0.5, lambda s: 1 / (1 + np.exp(-np.clip(s, -60, 60))))


def ada_folds(df: DataFrame, id_col: str, x: str, label: str = "label", fold: str = "fold", rates: Sequence[float] = (1.0,), rounds: int = 50,
              bins: int = 250, only_fold: int | None = None, stumps_out: list | None = None, sets_apart: bool = False) -> DataFrame:
    """M5: out-of-fold predictions of AdaBoost on all training rows, every rate and fold a run; one job a round for
    all runs. ``stumps_out`` (a list) gets (fold, rate, stumps), a stump being (feature, threshold, class at or below it, alpha).
    With ``sets_apart`` a fold's rows are its training set, not those left out of it (for the stumps alone)."""
    folds = _folds(df, fold, only_fold)
    runs = [(f, float(rate)) for f in folds for rate in rates]
    if not runs:
        return df.sparkSession.createDataFrame([], SCHEMA)
    edges = bin_edges(df, x, bins)
    n_bins, missing = [len(e) + 1 for e in edges], missing_code(edges)
    rows = binned(df, id_col, x, label, fold, edges, len(runs))
    # What is kept of a run is its score; a row's weight follows from the same stumps: alpha for each wrong one. The sum of
    # alphas is the same for all rows, so with labels ±1 the weight is exp(-label * score / 2) up to a factor.
    done: list[list[tuple[int, int, int, float]]] = [[] for _ in runs]
    recent: list[list[tuple[int, int, int, float]]] = [[] for _ in runs]
    ended = [False] * len(runs)

    def vote(stumps, codes):
        out = np.zeros(len(codes))
        for j, cut, left, alpha in stumps:
            low = (codes[:, j] <= cut) & (codes[:, j] != missing)
            out += alpha * np.where(low, 2 * left - 1, 1 - 2 * left)
        return out

    for at in range(rounds):
        if all(ended):
            break

        def partial(batch):
            codes, y, of, scores = _arrays(batch, len(runs))
            for r, (held, _) in enumerate(runs):
                use = np.flatnonzero((of == held) == sets_apart)
                if ended[r] or not len(use):
                    continue
                own, t = codes[use], y[use]
                w = np.exp(np.clip(-(2 * t - 1) * (scores[use, r] + vote(recent[r], own)) / 2, -700, 700))
                yield (r, 0), histogram(own, np.zeros(len(own), dtype=np.int64), [0], w * (t == 0), w * (t == 1), missing + 1)[0]

        def pick(run, node, total):
            error, j, cut, left = best_stump(total, n_bins)
            return {"run": run, "error": error, "feature": j, "cut": cut, "left": left}

        for s in _summed(rows, partial, pick, "run int, error double, feature int, cut int, left int", missing + 1):
            r, error = s["run"], s["error"]
            if error >= 0.5 or not math.isfinite(error):
                ended[r] = True
                continue
            perfect = error <= 1e-12
            stump = (s["feature"], s["cut"], s["left"], 1.0 if perfect else runs[r][1] * math.log((1 - error) / error))
            done[r].append(stump)
            recent[r].append(stump)
            ended[r] = perfect
        if (at + 1) % STAGE_EVERY == 0 or at == rounds - 1 or all(ended):
            held = recent
            rows = _with_scores(rows, len(runs), lambda r, codes, held=held: vote(held[r], codes))
            recent = [[] for _ in runs]
    if stumps_out is not None:
        cut_at = lambda j, b: float(edges[j][b]) if b < len(edges[j]) else math.inf
        stumps_out += [(f, rate, [(j, cut_at(j, b), left, a) for j, b, left, a in done[r]]) for r, (f, rate) in enumerate(runs)]
    return _predictions(rows, runs, rounds, 0.0, lambda s: s)
