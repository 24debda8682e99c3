"""Kernel SVC by Nyström features (M7).

The RBF kernel is approximated on ``width`` landmark rows: features are k(x, landmarks) K^(-1/2), and a linear SVC on them is
the kernel SVC whose solution lies in the landmarks' span. Landmarks are drawn by ridge leverage: a pilot set (rows
of least md5) gives each row's leverage, the share of the pilot's feature space that the row itself takes up, and
the landmarks are the winners of a seeded race with these shares as speeds. Only landmarks, their kernel matrix
and sums of its size reach the driver; rows are featurised in one narrow pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.columns import hex_prefix_int, seeded_hash
from casebook.operators import neighbours  # noqa: F401  (registers the package for by-value pickling)
from casebook.session import stage

WIDTH, PILOT = 256, 128


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2.0 * x @ y.T
    return np.exp(-gamma * np.maximum(apart, 0.0))


def whitening(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """K^(-1/2) of the landmarks; directions that they do not span are left out."""
    values, vectors = np.linalg.eigh(rbf(landmarks, landmarks, gamma))
    keep = values > 1e-10 * max(values.max(initial=0.0), 1e-300)
    return vectors[:, keep] / np.sqrt(values[keep])


def scale_of(df: DataFrame, x: str) -> float:
    """sklearn's gamma = 'scale': 1 / (features * variance of all values)."""
    r = df.select(F.size(x).alias("d"), F.explode(F.col(x).cast("array<double>")).alias("v")).agg(F.max("d").alias("d"), F.var_pop("v").alias("v")).first()
    return 1.0 / ((r["d"] or 1) * (r["v"] or 1.0))


def _values(batch: pa.RecordBatch, x: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(x)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)


def landmarks(df: DataFrame, id_col: str, x: str, gamma: float, width: int = WIDTH, pilot: int = PILOT, seed: int = 0) -> np.ndarray:
    """At most ``width`` rows of ``df`` (distinct vectors), drawn by ridge leverage."""
    rows = df.filter(F.col(x).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(x).cast("array<double>").alias("x"))
    few = np.array([r["x"] for r in rows.orderBy(seeded_hash(seed, F.col("id")), "id").limit(pilot).collect()], dtype=float)
    if not len(few):
        return few
    first = np.unique(few, axis=0)
    root = whitening(first, gamma)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((root.shape[1], root.shape[1])), 0
        for batch in filter(len, batches):
            features = rbf(_values(batch, "x"), first, gamma) @ root
            total += features.T @ features
            n += batch.num_rows
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "sums": pa.array([total.reshape(-1)], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(gram, "n long, sums array<double>").select(F.posexplode("sums").alias("j", "v")).groupBy("j").agg(F.sum("v").alias("v"))
    total = np.zeros(root.shape[1] ** 2)
    for r in parts.collect():  # pilot x pilot numbers
        total[r["j"]] = r["v"]
    total = total.reshape(root.shape[1], -1)
    ridge = np.linalg.inv(total + max(np.trace(total) / (10.0 * width), 1e-9) * np.eye(len(total)))

    def leverage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            near = rbf(_values(batch, "x"), first, gamma)
            features = near @ root
            # What the pilot does not explain of a row counts in full.
            rest = np.maximum(1.0 - (features * features).sum(axis=1), 0.0)
            share = np.einsum("ij,jk,ik->i", features, ridge, features) + rest / max(len(first), 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.maximum(share, 1e-12))], names=["id", "x", "share"])

    u = (hex_prefix_int(F.md5(F.concat(F.lit(f"{seed}:landmark:"), F.col("id"))), 12) + 1) / F.lit(float(1 << 48) + 1)
    race = rows.mapInArrow(leverage, "id string, x array<double>, share double").withColumn("t", -F.log(u) / F.col("share"))
    won = race.orderBy("t", "id").limit(width).collect()  # a documented number of landmarks
    return np.unique(np.array([r["x"] for r in won], dtype=float), axis=0)


def nystroem(df: DataFrame, id_col: str, x: str, out: str = "features", width: int = WIDTH, seed: int = 0, fit: DataFrame | None = None) -> DataFrame:
    """``df`` (staged) with the vector ``out`` of Nyström features; landmarks and scale come from ``fit`` (default: the
    frame itself; no label is used). Rows with a null vector are dropped."""
    fit = df if fit is None else fit
    gamma = scale_of(fit, x)
    marks = landmarks(fit, id_col, x, gamma, width, seed=seed)
    rows = df.filter(F.col(x).isNotNull()).drop(out)
    if not len(marks):
        return rows.withColumn(out, array_to_vector(F.array(F.lit(0.0))))
    root = whitening(marks, gamma)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            features = rbf(_values(batch, x), marks, gamma) @ root
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(features) + 1) * features.shape[1], pa.int32()), pa.array(features.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], names=[*batch.schema.names, "_f"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return stage(rows.mapInArrow(run, f"{kinds}, _f array<double>")).withColumn(out, array_to_vector("_f")).drop("_f")
