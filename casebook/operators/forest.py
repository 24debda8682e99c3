"""Random forest on all rows (M2), grown for all folds and trees in one plan.

Features are cut into bins once (``histboost``); each tree draws every row as often as a Poisson(1) number of the row's own key
says and tries √d features a node, by Gini impurity, as MLlib does (leaves are not merged afterwards, as in sklearn). Draws and
features follow from (seed, fold, tree, node), so a tree does not depend on how its growth is shared out:

* A node of more than ``block`` drawn rows is split by one job a level for *all* trees: tasks add up class counts by (tree, node,
  feature, bin), and only the splits reach the driver. Every level halves the nodes, more or less, so there are about
  log2(rows / block) of them.
* A node of at most ``block`` rows is sent to one task, packed (a byte a feature), which grows the rest of its subtree.

Subtrees stay in a staged table; held-out rows go to them by (tree, node), and of each row only the sum of its votes comes back.
No model and no row reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.operators import histboost as HB
from casebook.operators.histboost import _codes
from casebook.session import stage

#: Drawn rows of a node that one task may hold (64 features: 4 MB).
BLOCK = 65_536
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate(([1.0], np.arange(1, 15)))))
TREES = "run int, node long, feature binary, cut binary, child binary, value binary, gains array<double>"


# ---------------------------------------------------------------- draws

def _mix(h: np.ndarray) -> np.ndarray:
    """Splitmix64: evenly spread 64-bit numbers."""
    with np.errstate(over="ignore"):
        h = h + np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def run_key(seed: int, fold: int, tree: int) -> np.uint64:
    return _mix(_mix(_mix(np.array([seed], dtype=np.int64).view(np.uint64)) ^ np.uint64(fold + 2)) ^ np.uint64(tree))[0]


def draws(key: np.uint64, rows: np.ndarray) -> np.ndarray:
    """How often a tree draws each row: Poisson(1)."""
    u = (_mix(key ^ rows.view(np.uint64)) >> np.uint64(11)) / float(1 << 53)
    return np.searchsorted(_POISSON, u, side="right").astype(np.int64)


def features_of(key: np.uint64, nodes: np.ndarray, d: int, m: int) -> np.ndarray:
    """The m features that each node tries, ascending."""
    if m >= d:
        return np.tile(np.arange(d), (len(nodes), 1))
    with np.errstate(over="ignore"):
        order = _mix(_mix(~key ^ nodes.astype(np.uint64))[:, None] + np.arange(d, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return np.sort(np.argpartition(order, m - 1, axis=1)[:, :m], axis=1)


# ---------------------------------------------------------------- one tree

def best_cuts(hists: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature slot, last bin of the left side) per node, of one (node, bin, class) count table per slot; the gain is
    that of Gini impurity times the node's rows, 0 or less being no split. Ties go to the smaller slot, then bin."""
    best = None
    for slot, hist in enumerate(hists):
        total = hist.sum(axis=1)
        left = np.cumsum(hist[:, :-1], axis=1)
        right = total[:, None] - left
        n_left, n_right = left.sum(axis=2), right.sum(axis=2)
        worth = (left ** 2).sum(axis=2) / np.maximum(n_left, 1) + (right ** 2).sum(axis=2) / np.maximum(n_right, 1)
        worth[(n_left == 0) | (n_right == 0)] = -np.inf
        cut = worth.argmax(axis=1)
        n = total.sum(axis=1)
        gain = worth[np.arange(len(cut)), cut] - (total ** 2).sum(axis=1) / np.maximum(n, 1)
        gain[gain <= 1e-10 * n] = 0.0
        if best is None:
            best = gain, np.zeros(len(cut), dtype=np.int64), cut
        else:
            better = gain > best[0]
            best = np.where(better, gain, best[0]), np.where(better, slot, best[1]), np.where(better, cut, best[2])
    return best


def _counts(code: np.ndarray, at: np.ndarray, y: np.ndarray, w: np.ndarray, nodes: int, width: int) -> np.ndarray:
    return np.bincount((at * width + code) * 2 + y, weights=w, minlength=nodes * width * 2).reshape(nodes, width, 2)


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, node: int, depth: int, key: np.uint64, m: int, width: int) -> tuple[np.ndarray, ...]:
    """(feature or -1, last bin of the left side, left child, share of class 1) of a subtree's nodes and its gain by feature.
    ``node`` is its root in heap order; the right child follows the left one. All nodes of a level are split at once."""
    d = codes.shape[1]
    level = (node + 1).bit_length() - 1
    flat, rows, at, ids, begin = codes.reshape(-1), np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64), np.array([node]), 0
    out, gains = [], np.zeros(d)
    while len(ids):
        n = len(ids)
        total = np.bincount(at * 2 + y[rows], weights=w[rows], minlength=2 * n).reshape(n, 2)
        feature, cut, child = np.full(n, -1, dtype=np.int32), np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.int32)
        out.append((feature, cut, child, total[:, 1] / np.maximum(total.sum(axis=1), 1)))
        open_ = np.flatnonzero(total.min(axis=1) > 0) if level < depth else np.zeros(0, dtype=np.int64)
        if not len(open_):
            break
        place = np.full(n, -1)
        place[open_] = np.arange(len(open_))
        at = place[at]
        rows, at = rows[at >= 0], at[at >= 0]
        tried = features_of(key, ids[open_], d, m)
        y_rows, w_rows, offset = y[rows], w[rows], rows * d
        gain, slot, last = best_cuts(_counts(flat[offset + tried[at, s]].astype(np.int64), at, y_rows, w_rows, len(open_), width) for s in range(tried.shape[1]))
        good = np.flatnonzero(gain > 0)
        chosen = tried[good, slot[good]]
        feature[open_[good]], cut[open_[good]] = chosen, last[good]
        child[open_[good]] = begin + n + 2 * np.arange(len(good))
        gains += np.bincount(chosen, weights=gain[good], minlength=d)
        place = np.full(len(open_), -1)
        place[good] = np.arange(len(good))
        at = place[at]
        rows, at = rows[at >= 0], at[at >= 0]
        right = flat[rows * d + chosen[at]] > last[good][at]
        at = 2 * at + right
        ids = (2 * ids[open_[good]][:, None] + np.array([1, 2])).reshape(-1)
        begin, level = begin + n, level + 1
    return (*(np.concatenate([level_[i] for level_ in out]) for i in range(4)), gains)


def votes(feature: np.ndarray, cut: np.ndarray, child: np.ndarray, value: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The share of class 1 in each row's leaf."""
    at, live = np.zeros(len(codes), dtype=np.int64), np.arange(len(codes))
    while len(live):
        live = live[feature[at[live]] >= 0]
        here = at[live]
        at[live] = child[here] + (codes[live, feature[here]] > cut[here])
    return value[at]


# ---------------------------------------------------------------- jobs

def binned(df: DataFrame, row: str, x: str, label: str | None, fold: str | None, edges: list[np.ndarray]) -> DataFrame:
    """(row, draw, label, fold, bins), staged; ``draw`` is the key of a row's draws. Rows with a null vector take no part."""
    vector = F.transform(F.col(x).cast("array<double>"), lambda v: F.coalesce(v, F.lit(float("nan"))))
    rows = df.filter(F.col(x).isNotNull()).select(
        F.col(row).cast("long").alias("row"), F.xxhash64("_id", x).alias("draw"), (F.lit(0) if label is None else F.col(label)).cast("int").alias("label"),
        (F.lit(-1) if fold is None else F.col(fold)).cast("int").alias("fold"), vector.alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            codes = _codes(batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), edges)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([c.tobytes() for c in codes], pa.binary())], names=["row", "draw", "label", "fold", "bins"])

    return stage(rows.mapInArrow(run, "row long, draw long, label int, fold int, bins binary"))


def _bins(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)


def _routed(top: dict[int, tuple[int, int]], codes: np.ndarray) -> np.ndarray:
    """The node, below the splits of ``top``, that each row comes to."""
    at = np.zeros(len(codes), dtype=np.int64)
    for node in sorted(top):
        here = np.flatnonzero(at == node)
        j, cut = top[node]
        at[here] = 2 * node + 1 + (codes[here, j] > cut)
    return at


def _by_node(at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for node in np.unique(at):
        yield int(node), np.flatnonzero(at == node)


def _parts(df: DataFrame, runs: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(runs, 200))


class Grown:
    """The trees of all runs: splits of large nodes (small, on the driver) and a staged table of subtrees."""

    def __init__(self, rows: DataFrame, folds: Sequence[int], n_trees: int, depth: int, seed: int, edges: list[np.ndarray], block: int):
        self.folds, self.n_trees, self.d = list(folds), n_trees, len(edges)
        width, m = HB.missing_code(edges) + 1, int(np.ceil(np.sqrt(max(len(edges), 1))))
        runs = [(fold, run_key(seed, fold, t)) for fold in folds for t in range(n_trees)]
        self.top: list[dict[int, tuple[int, int]]] = [{} for _ in runs]
        top, leaves = self.top, {}
        per = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}  # k values
        # A tree draws as many rows as there are, give or take a few times the root.
        large = [[0] if (n := sum(per.values()) - per.get(fold, 0)) + 6 * n ** 0.5 > block else [] for fold, _ in runs]
        self.top_gains: list[tuple[int, int, float]] = []
        while any(large):
            def partial(batch, large=large):
                codes, y, of, who = _bins(batch), batch.column("label").to_numpy(), batch.column("fold").to_numpy(), batch.column("draw").to_numpy()
                for r, (fold, key) in enumerate(runs):
                    if not large[r]:
                        continue
                    times = draws(key, who)
                    use = np.flatnonzero((of != fold) & (times > 0))
                    at = _routed(top[r], codes[use])
                    for node in large[r]:
                        mine = use[at == node]
                        if len(mine):
                            tried = features_of(key, np.array([node]), codes.shape[1], m)[0]
                            zero = np.zeros(len(mine), dtype=np.int64)
                            yield (r, node), np.concatenate([_counts(codes[mine, j].astype(np.int64), zero, y[mine], times[mine], 1, width) for j in tried])

            def pick(run, node, total):
                gain, slot, cut = best_cuts(h[None] for h in total)
                tried = features_of(runs[run][1], np.array([node]), len(edges), m)[0]
                sums = total[0].sum(axis=0)
                left = total[slot[0], :cut[0] + 1].sum()
                return {"run": run, "node": node, "feature": int(tried[slot[0]]), "cut": int(cut[0]), "gain": float(gain[0]), "none": float(sums[0]), "one": float(sums[1]), "left": float(left)}

            found = HB._summed(rows, partial, pick, "run int, node int, feature int, cut int, gain double, none double, one double, left double", width)
            large = [[] for _ in runs]
            for s in found:
                r, node, n = s["run"], s["node"], s["none"] + s["one"]
                if s["gain"] <= 0 or (node + 1).bit_length() - 1 >= depth:
                    leaves[r, node] = s["one"] / n
                    continue
                top[r][node] = (s["feature"], s["cut"])
                self.top_gains.append((r, s["feature"], s["gain"]))
                large[r] += [child for child, size in ((2 * node + 1, s["left"]), (2 * node + 2, n - s["left"])) if size > block]

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in filter(len, batches):
                codes, y, of, who = _bins(batch), batch.column("label").to_numpy(), batch.column("fold").to_numpy(), batch.column("draw").to_numpy()
                for r, (fold, key) in enumerate(runs):
                    times = draws(key, who)
                    use = np.flatnonzero((of != fold) & (times > 0))
                    sent = [(node, use[mine]) for node, mine in _by_node(_routed(top[r], codes[use])) if (r, node) not in leaves]
                    if sent:
                        yield pa.RecordBatch.from_pydict({
                            "run": pa.array([r] * len(sent), pa.int32()), "node": pa.array([node for node, _ in sent], pa.int64()),
                            "bins": pa.array([codes[mine].tobytes() for _, mine in sent], pa.binary()),
                            "drawn": pa.array([(2 * times[mine] + y[mine]).astype(np.uint8).tobytes() for _, mine in sent], pa.binary())})

        kinds = pa.schema([("run", pa.int32()), ("node", pa.int64()), ("feature", pa.binary()), ("cut", pa.binary()), ("child", pa.binary()), ("value", pa.binary()),
                           ("gains", pa.list_(pa.float64()))])

        def subtree(key: tuple, group: pa.Table) -> pa.Table:
            run, node = key[0].as_py(), key[1].as_py()
            drawn = np.frombuffer(b"".join(group.column("drawn").to_pylist()), dtype=np.uint8).astype(np.int64)
            codes = np.frombuffer(b"".join(group.column("bins").to_pylist()), dtype=np.uint8).reshape(len(drawn), -1)
            feature, cut, child, value, gains = grow(codes, drawn & 1, drawn >> 1, node, depth, runs[run][1], m, width)
            return pa.Table.from_pylist([{"run": run, "node": node, "feature": feature.tobytes(), "cut": cut.tobytes(), "child": child.tobytes(),
                                          "value": value.tobytes(), "gains": gains.tolist()}], kinds)

        packed = rows.mapInArrow(pack, "run int, node long, bins binary, drawn binary").repartition(_parts(rows, len(runs)), "run", "node")
        grown = packed.groupBy("run", "node").applyInArrow(subtree, TREES)
        if leaves:  # large nodes that cannot be split
            one = [(r, node, np.array([-1], np.int32).tobytes(), np.zeros(1, np.uint8).tobytes(), np.zeros(1, np.int32).tobytes(), np.array([p]).tobytes(), [0.0] * self.d)
                   for (r, node), p in leaves.items()]
            grown = grown.unionByName(rows.sparkSession.createDataFrame(one, TREES))
        self.trees = stage(grown)

    def scores(self, rows: DataFrame, held_out: bool) -> DataFrame:
        """(row, score): the mean share of class 1 in a row's leaves, over the trees of its own fold (``held_out``) or of
        the only run set."""
        top, folds, n_trees = self.top, self.folds, self.n_trees

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in filter(len, batches):
                codes, of, row = _bins(batch), batch.column("fold").to_numpy(), batch.column("row").to_numpy()
                for k, fold in enumerate(folds):
                    use = np.flatnonzero(of == fold) if held_out else np.arange(len(row))
                    if not len(use):
                        continue
                    for r in range(k * n_trees, (k + 1) * n_trees):
                        sent = [(node, use[mine]) for node, mine in _by_node(_routed(top[r], codes[use]))]
                        yield pa.RecordBatch.from_pydict({
                            "run": pa.array([r] * len(sent), pa.int32()), "node": pa.array([node for node, _ in sent], pa.int64()),
                            "bins": pa.array([codes[mine].tobytes() for _, mine in sent], pa.binary()), "rows": pa.array([row[mine].tobytes() for _, mine in sent], pa.binary())})

        def vote(trees: pa.Table, asked: pa.Table) -> pa.Table:
            schema = pa.schema([("row", pa.int64()), ("vote", pa.float64())])
            if not len(trees) or not len(asked):
                return schema.empty_table()
            feature, cut, child, value = (np.frombuffer(trees.column(c)[0].as_buffer(), dtype=kind) for c, kind in
                                          (("feature", np.int32), ("cut", np.uint8), ("child", np.int32), ("value", np.float64)))
            row = np.frombuffer(b"".join(asked.column("rows").to_pylist()), dtype=np.int64)
            codes = np.frombuffer(b"".join(asked.column("bins").to_pylist()), dtype=np.uint8).reshape(len(row), -1)
            return pa.table({"row": row, "vote": votes(feature, cut, child, value, codes)}, schema)

        parts = _parts(rows, len(top))
        asked = rows.mapInArrow(pack, "run int, node long, bins binary, rows binary").repartition(parts, "run", "node")
        trees = self.trees.drop("gains").repartition(parts, "run", "node")
        found = trees.groupBy("run", "node").cogroup(asked.groupBy("run", "node")).applyInArrow(vote, "row long, vote double")
        # Rounded, as the order of the sum is not fixed.
        return found.groupBy("row").agg(F.round(F.sum("vote") / n_trees, 9).alias("score"))

    def importances(self) -> np.ndarray:
        """Gain by feature, as shares of each tree's gain, averaged over the trees that split at all."""
        per = np.zeros((len(self.top), self.d))
        for r in self.trees.select("run", F.posexplode("gains").alias("j", "g")).groupBy("run", "j").agg(F.sum("g").alias("g")).collect():  # trees x features
            per[r["run"], r["j"]] = r["g"]
        for run, j, gain in self.top_gains:
            per[run, j] += gain
        sums = per.sum(axis=1)
        mean = (per[sums > 0] / sums[sums > 0, None]).sum(axis=0)
        return mean / mean.sum() if mean.sum() > 0 else mean


# ---------------------------------------------------------------- the estimator

def _with_scores(df: DataFrame, scores: DataFrame, n_trees: int) -> DataFrame:
    share = F.array(1.0 - F.col("score"), F.col("score"))
    out = df.join(scores.withColumnRenamed("row", "_row"), "_row").withColumn("rawPrediction", array_to_vector(F.transform(share, lambda p: p * n_trees)))
    return out.withColumn("probability", array_to_vector(share)).withColumn("prediction", (F.col("score") > 0.5).cast("double")).drop("_row", "_x", "_id", "score")


class ForestModel(Model):
    """Trees grown on all rows; ``featureImportances`` as MLlib's."""

    def __init__(self, forest: "Forest", edges: list[np.ndarray], grown: Grown):
        super().__init__()
        self.forest, self.edges, self.grown = forest, edges, grown

    @property
    def featureImportances(self) -> DenseVector:
        return Vectors.dense(self.grown.importances())

    def _transform(self, df: DataFrame) -> DataFrame:
        numbered = self.forest.numbered(df)
        rows = binned(numbered, "_row", "_x", None, None, self.edges)
        return _with_scores(numbered, self.grown.scores(rows, False), self.forest.trees)


class Forest(Estimator):
    """M2: random forest of two classes. ``fold_predictions`` grows the forests of all folds in one plan."""

    def __init__(self, trees: int = 100, depth: int = 30, seed: int = 0, labelCol: str = "label", featuresCol: str = "features", bins: int = HB.BINS, block: int = BLOCK):
        super().__init__()
        self.trees, self.depth, self.seed, self.labelCol, self.featuresCol, self.bins, self.block = trees, depth, seed, labelCol, featuresCol, bins, block

    def copy(self, extra=None):
        return Forest(self.trees, self.depth, self.seed, self.labelCol, self.featuresCol, self.bins, self.block)

    def numbered(self, df: DataFrame) -> DataFrame:
        """Staged with ``_row`` (a row's number), ``_x`` (the features as an array) and ``_id`` (what, beside ``_x``, draws go by)."""
        plain = [F.col(c).cast("string") for c, kind in df.dtypes if kind in ("string", "int", "bigint") and c != self.labelCol]
        return stage(df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_x", vector_to_array(F.col(self.featuresCol)))
                     .withColumn("_id", F.concat_ws("\x1f", *plain) if plain else F.lit("")))

    def _fit(self, df: DataFrame) -> ForestModel:
        rows = self.numbered(df.filter(F.col(self.labelCol).isNotNull()))
        edges = HB.bin_edges(rows, "_x", self.bins)
        return ForestModel(self, edges, Grown(binned(rows, "_row", "_x", self.labelCol, None, edges), [-2], self.trees, self.depth, self.seed, edges, self.block))

    def fold_predictions(self, df: DataFrame, fold: str, folds: Sequence[int]) -> DataFrame:
        """Every row of ``folds`` with the prediction of the forest grown on the other folds' rows."""
        numbered = self.numbered(df)
        edges = HB.bin_edges(numbered, "_x", self.bins)
        rows = binned(numbered, "_row", "_x", self.labelCol, fold, edges)
        grown = Grown(rows, folds, self.trees, self.depth, self.seed, edges, self.block)
        return _with_scores(numbered, grown.scores(rows, True), self.trees)
