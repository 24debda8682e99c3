"""Multilayer perceptron (M4): MLlib's network, start and steps, trained for all folds together.

MLlib fits a training set at a time: every step of every fold is a job of its own, over a copy of the training rows held as JVM
blocks. Here the rows are packed once, some hundred of a fold to a block, and each step is one pass over them for *all* folds: a
task adds up loss and gradient of every fold's network but the block's own in numpy. What reaches the driver is a gradient a fold and
partition, or, where these pass ``SUMS``, a gradient a fold: they meet in a shuffle first.

Weights start as MLlib draws them for the seed, move by the L-BFGS steps of Breeze (ten corrections, strong Wolfe line search,
the same tests of convergence), and end in an MLlib model, which scores. The loss is MLlib's too: the mean over stacks of 128 training rows
of a partition, whose last one is shorter, so that its rows weigh more. Only those rows carry weights, at most 127 a partition and fold.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.operators import neighbours  # noqa: F401  (registers the package for by-value pickling)
from casebook.session import stage

#: Values (rows x inputs) that a partition holds at most, beyond a partition a core (51 MB).
PART_VALUES = 6_400_000
#: Bytes of gradients that a pass may bring to the driver.
SUMS = 32 << 20
#: Rows of a block at most, and of a stack of MLlib's.
CHUNK, STACK = 512, 128
CORRECTIONS = 10


# ---------------------------------------------------------------- loss and gradient

def add_sums(total: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray, hidden: int, weight: np.ndarray | None = None) -> None:
    """Adds (weight of the rows, cross entropy, its gradient) to ``total``; without ``weight`` a row weighs 1. ``x`` ends in a column of ones; ``w`` lies as in MLlib: by layer
    (input, unit), then the units' biases."""
    cut = x.shape[1] * hidden
    first, second = w[:cut].reshape(-1, hidden), w[cut:].reshape(-1, 2)
    to_first, to_second = total[2:2 + cut].reshape(-1, hidden), total[2 + cut:].reshape(-1, 2)
    slope = second[:, 1] - second[:, 0]
    out = x @ first
    with np.errstate(over="ignore"):
        np.exp(np.negative(out, out=out), out=out)
        out += 1.0
        np.reciprocal(out, out=out)
        margin = out @ slope[:-1] + slope[-1]
        wrong = 1.0 / (1.0 + np.exp(-margin)) - y
    loss = np.logaddexp(0.0, np.where(y > 0, -margin, margin))
    if weight is not None:
        loss *= weight
        wrong *= weight
    total[0] += len(x) if weight is None else weight.sum()
    total[1] += loss.sum()
    up = np.append(wrong @ out, wrong.sum())
    to_second[:, 1] += up
    to_second[:, 0] -= up
    delta = 1.0 - out
    delta *= out
    delta *= slope[:-1]
    delta *= wrong[:, None]
    to_first += x.T @ delta


def _added(sums: Sequence[bytes]) -> np.ndarray:
    """Their sum, in an order of their own, so that reruns agree."""
    return np.add.reduce([np.frombuffer(h) for h in sorted(sums)])


def gradients(blocks: DataFrame, points: dict[int, tuple[int, np.ndarray]], inputs: int, hidden: int, parts: int) -> dict[int, tuple[float, np.ndarray]]:
    """One job: mean loss and its gradient of each run's weights over the rows outside its fold; ``points`` has (fold, weights)
    by run (a number), the blocks lie in about so many ``parts``."""
    size = len(next(iter(points.values()))[1]) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for fold, x, y, weights in zip(batch.column("fold").to_pylist(), batch.column("x"), batch.column("y"), batch.column("weights").to_pylist()):
                rows, t = np.frombuffer(x.as_buffer()).reshape(-1, inputs), np.frombuffer(y.as_buffer(), dtype=np.uint8).astype(float)
                rows = np.concatenate([rows, np.ones((len(rows), 1))], axis=1)
                by_run = None if weights is None else np.frombuffer(weights).reshape(-1, len(rows))
                for r, (out, w) in points.items():
                    if out != fold:
                        add_sums(held.setdefault(r, np.zeros(size)), rows, t, w, hidden, None if by_run is None else by_run[r])
        if held:
            yield pa.RecordBatch.from_pydict({"run": pa.array(list(held), pa.int32()), "sums": pa.array([h.tobytes() for h in held.values()], pa.binary())})

    def add(key: tuple, group: pa.Table) -> pa.Table:
        return pa.table({"run": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([_added(group.column("sums").to_pylist()).tobytes()], pa.binary())})

    sums = blocks.mapInArrow(run, "run int, sums binary")
    if parts * len(points) * size * 8 > SUMS:
        sums = sums.repartition(len(points), "run").groupBy("run").applyInArrow(add, "run int, sums binary")
    by_run: dict[int, list[bytes]] = {}
    for row in sums.toArrow().to_pylist():
        by_run.setdefault(row["run"], []).append(row["sums"])
    found = {r: _added(s) for r, s in by_run.items()}
    return {r: (s[1] / s[0], s[2:] / s[0]) for r, s in found.items()}


# ---------------------------------------------------------------- L-BFGS, as Breeze has it

class SearchFailed(Exception):
    pass


#: Yields a point, is sent (value, gradient) there.
Asking = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


def _direction(grad: np.ndarray, steps: list[np.ndarray], changes: list[np.ndarray]) -> np.ndarray:
    """Two-loop recursion; the latest step comes first."""
    out, rho = grad.copy(), [float(s @ c) for s, c in zip(steps, changes)]
    if rho and not rho[0] >= 0:
        raise SearchFailed("curvature")
    shares = []
    for s, c, p in zip(steps, changes, rho):
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.float64(s @ out) / p
        if math.isnan(share):
            raise SearchFailed("curvature")
        shares.append(share)
        out -= share * c
    if rho:
        out *= rho[0] / float(changes[0] @ changes[0])
    for s, c, p, share in reversed(list(zip(steps, changes, rho, shares))):
        out += (share - float(c @ out) / p) * s
    return -out


def _between(low: tuple, high: tuple) -> float:
    """Minimum of the cubic through two ends (t, value, slope), off both by a tenth at least."""
    (lt, lv, ls), (rt, rv, rs) = low[:3], high[:3]
    with np.errstate(all="ignore"):
        d1 = np.float64(ls + rs - 3 * (lv - rv) / (lt - rt))
        d2 = np.sqrt(d1 * d1 - ls * rs)
        t = float(rt - (rt - lt) * (rs + d2 - d1) / (rs - ls + 2 * d2))
    least, most = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
    return least if t < least else most if t > most else t


def _search(x: np.ndarray, value: float, grad: np.ndarray, way: np.ndarray, t: float) -> Generator:
    """Strong Wolfe line search: (step, value, gradient there)."""
    fall = float(grad @ way)
    if fall > 0:
        raise SearchFailed("not a descent")
    low = (0.0, value, fall, grad)

    def at(t):
        v, g = yield x + way * t
        return t, v, float(g @ way), g

    def zoom(low, high):
        for _ in range(10):
            c = yield from at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if c[1] > value + 1e-4 * c[0] * fall or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(fall):
                return c
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise SearchFailed("zoom")

    for i in range(10):
        c = yield from at(t)
        if not math.isfinite(c[1]):
            t /= 2.0
            continue
        if c[1] > value + 1e-4 * t * fall or (c[1] >= low[1] and i > 0):
            return (yield from zoom(low, c))
        if abs(c[2]) <= 0.9 * abs(fall):
            return c
        if c[2] >= 0:
            return (yield from zoom(c, low))
        low, t = c, t * 1.5
    raise SearchFailed("line")


def minimise(w: np.ndarray, steps: int, tol: float) -> Asking:
    """Asks for values and gradients point by point and returns the last point stepped to."""
    value, grad = yield w
    start, seen, made, failed = value, [math.inf], 0, False
    moves: list[np.ndarray] = []
    changes: list[np.ndarray] = []
    while made < steps and not (len(seen) >= 2 and abs(value - max(seen)) <= tol * start) and np.linalg.norm(grad) > max(tol * value, 1e-8):
        try:
            way = _direction(grad, moves, changes)
            t, new_value, _, new_grad = yield from _search(w, value, grad, way, 1.0 if made else 1.0 / float(np.linalg.norm(way)))
            if t * np.linalg.norm(grad) < 1e-10:
                raise SearchFailed("step")
        except SearchFailed:
            if failed:
                break
            failed, moves, changes = True, [], []
            continue
        new = w + way * t
        moves, changes = [new - w, *moves][:CORRECTIONS], [new_grad - grad, *changes][:CORRECTIONS]
        w, value, grad = new, new_value, new_grad
        seen, made, failed = [*seen, value][-20:], made + 1, False
    return w


# ---------------------------------------------------------------- the estimator

class Perceptron(Estimator):
    """M4: one hidden layer, two classes. ``fold_predictions`` trains the networks of all folds in the same passes; ``fit`` one, as
    an MLlib model."""

    def __init__(self, inputs: int, hidden: int = 100, steps: int = 200, seed: int = 0, labelCol: str = "label", featuresCol: str = "features", tol: float = 1e-6):
        super().__init__()
        self.inputs, self.hidden, self.steps, self.seed, self.labelCol, self.featuresCol, self.tol = inputs, hidden, steps, seed, labelCol, featuresCol, tol

    def copy(self, extra=None):
        return Perceptron(self.inputs, self.hidden, self.steps, self.seed, self.labelCol, self.featuresCol, self.tol)

    def model(self, df: DataFrame, w: np.ndarray | None = None) -> Model:
        """MLlib's model with these weights, or those it draws for the seed."""
        made = MultilayerPerceptronClassifier(layers=[self.inputs, self.hidden, 2], maxIter=0, seed=self.seed, labelCol=self.labelCol, featuresCol=self.featuresCol)
        if w is not None:
            made = made.setInitialWeights(Vectors.dense(w))
        row = (Vectors.dense([0.0] * self.inputs), 0.0)  # a fit of no steps reads the weights only
        return made.fit(df.sparkSession.createDataFrame([row], [self.featuresCol, self.labelCol]))

    def blocks(self, df: DataFrame, fold: str | None, folds: Sequence[int], stacked: int | None) -> tuple[DataFrame, int]:
        """(fold, x, y, weights), staged, and its partitions: inputs and labels of some rows of a fold, and where rows lie in the last
        stack of a fold's training set, their weights by run. ``stacked`` is the number of partitions that stacks are made in (null: those of
        ``df``). Null or non-finite inputs and labels other than 0 and 1 are errors, as in MLlib."""
        inputs = self.inputs
        rows = df.select((F.lit(-1) if fold is None else F.col(fold)).cast("int").alias("fold"), vector_to_array(F.col(self.featuresCol)).alias("x"),
                         F.col(self.labelCol).cast("double").alias("y")).filter("fold is not null")
        parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows.count() * inputs // PART_VALUES))

        def block(f: int, x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"fold": pa.array([f], pa.int32()), "x": pa.array([x.tobytes()], pa.binary()),
                                               "y": pa.array([y.astype(np.uint8).tobytes()], pa.binary()),
                                               "weights": pa.array([None if weights is None else weights.tobytes()], pa.binary())})

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Of every fold the last rows, with their places, are held back to the end: all last stacks lie in them.
            held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
            count: dict[int, int] = {}
            seen = 0
            for batch in filter(len, batches):
                if batch.column("x").null_count or batch.column("y").null_count:
                    raise ValueError("vectors and labels must not be null")
                x, y, of = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
                if x.shape[1] != inputs or not np.isfinite(x).all() or not np.isin(y, (0.0, 1.0)).all():
                    raise ValueError(f"vectors must hold {inputs} finite numbers, labels be 0 or 1")
                for f in np.unique(of).tolist():
                    at = np.flatnonzero(of == f)
                    count[f] = count.get(f, 0) + len(at)
                    own = (x[at], y[at], seen + at)
                    if f in held:
                        own = tuple(np.concatenate(pair) for pair in zip(held[f], own))
                    done = max(len(own[1]) - STACK, 0)
                    held[f] = tuple(a[done:] for a in own)
                    yield from (block(f, own[0][b:min(b + CHUNK, done)], own[1][b:min(b + CHUNK, done)]) for b in range(0, done, CHUNK))
                seen += batch.num_rows
            weights = {f: np.ones((len(folds), len(rows[1]))) for f, rows in held.items()}
            for r, out in enumerate(folds):
                rest = (seen - count.get(out, 0)) % STACK
                if rest:
                    first = np.sort(np.concatenate([rows[2] for f, rows in held.items() if f != out]))[-rest]
                    for f, rows in held.items():
                        weights[f][r, rows[2] >= first] = STACK / rest
            yield from (block(f, x, y, weights[f]) for f, (x, y, _) in held.items())

        packed = (rows if stacked is None else rows.coalesce(stacked)).mapInArrow(pack, "fold int, x binary, y binary, weights binary")
        return stage(packed.repartition(parts).sortWithinPartitions(F.xxhash64("x", "y"))), parts

    def weights(self, df: DataFrame, fold: str | None, folds: Sequence[int], stacked: int | None = None) -> dict[int, np.ndarray]:
        """By fold, the weights trained on the other folds' rows; -2 leaves no row out."""
        start, (rows, parts) = self.model(df).weights.toArray(), self.blocks(df, fold, folds, stacked)
        out, points = {}, {}
        runs = {r: minimise(start, self.steps, self.tol) for r in range(len(folds))}
        for r, asking in runs.items():
            points[r] = (folds[r], next(asking))
        while points:
            found = gradients(rows, points, self.inputs, self.hidden, parts)
            for r in list(points):
                if r not in found:
                    raise ValueError(f"no training rows outside fold {folds[r]}")
                try:
                    points[r] = (folds[r], runs[r].send(found[r]))
                except StopIteration as end:
                    out[folds[r]] = end.value
                    del points[r]
        return out

    def _fit(self, df: DataFrame) -> Model:
        return self.model(df, self.weights(df, None, [-2])[-2])

    def fold_predictions(self, df: DataFrame, fold: str, folds: Sequence[int], stacked: int | None = None) -> DataFrame:
        """Every row of ``folds`` with the prediction of the network trained on the other folds' rows, stacked in so many partitions."""
        # With one fold only the rows outside it are read.
        train = df.filter(F.col(fold) != folds[0]) if len(folds) == 1 else df
        trained = self.weights(train, fold, folds, stacked)
        parts = [self.model(df, trained[f]).transform(df.filter(F.col(fold) == f)) for f in folds]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
