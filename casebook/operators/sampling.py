"""Seeded sampling, splits and folds.

Every random step is an md5 order of ``seed ':' id``: reproducible, independent of partitioning
and input order, and equal to ``ORDER BY md5(...)`` in SQL. Global ranks use the bucketed rank of
``cohort.rank_by_hash`` (no single-task window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.columns import hex_prefix_int, seeded_hash
from casebook.operators.cohort import rank_by_hash


def _ranked(df: DataFrame, id_col: str, seed: int, group: list[str] | None = None, out: str = "_rank") -> DataFrame:
    g = group or []
    h = df.withColumn("_h", seeded_hash(seed, F.col(id_col)))
    if not g:
        h = h.withColumn("_all", F.lit(1))
    return rank_by_hash(h, g or ["_all"], "_h", out).drop("_h", "_all")


def undersample(df: DataFrame, n: int, seed: int, id_col: str, label: str, negative=0) -> DataFrame:
    """E5: drop ``n`` random rows of the negative class (the reference removes, not keeps, n)."""
    neg = _ranked(df.filter(F.col(label) == negative), id_col, seed)
    kept_neg = neg.filter(F.col("_rank") > n).drop("_rank")
    return df.filter(F.col(label) != negative).unionByName(kept_neg)


def train_test(df: DataFrame, id_col: str, test: float = 0.25, seed: int = 0) -> DataFrame:
    """Adds ``split`` ('train'/'test'); exactly ceil(test·n) rows are test, chosen by md5 rank."""
    n = df.agg(F.count(F.lit(1))).scalar()  # scalar subquery
    ranked = _ranked(df, id_col, seed)
    return ranked.withColumn("split", F.when(F.col("_rank") <= F.ceil(n * F.lit(test)), "test")
                             .otherwise("train")).drop("_rank")


def add_folds(df: DataFrame, id_col: str, k: int, seed: int = 0, stratify: str | None = None,
              repeats: int = 1) -> DataFrame:
    """Fold ids 0..k-1. Shuffled k-fold: fold = (md5 rank − 1) mod k (sizes differ by ≤ 1).
    Stratified: the rank is taken within the class, so every fold keeps the class ratio ±1.
    Repeated: ``repeats`` copies with seeds seed, seed+1, ... and a ``repeat`` column."""
    outs = []
    for r in range(repeats):
        ranked = _ranked(df, id_col, seed + r, [stratify] if stratify else None)
        outs.append(ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int"))
                    .withColumn("repeat", F.lit(r)).drop("_rank"))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def resample(df: DataFrame, label: str, id_col: str, mode: str = "over", seed: int = 0) -> DataFrame:
    """Random over-sampling (minority drawn with replacement up to the majority size; draw i
    takes minority index hex(md5(seed ':' i)) mod n) or under-sampling (majority cut to the
    minority size by md5 rank). Two-class labels."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    # One row (two classes): read on the driver and used as literals.
    b = counts.agg(F.min_by(label, F.struct("_n", label)).alias("minor"), F.max_by(label, F.struct("_n", label)).alias("major"),
                   F.min("_n").alias("nmin"), F.max("_n").alias("nmax")).first()
    if mode == "under":
        major = _ranked(df.filter(F.col(label) == F.lit(b["major"])), id_col, seed)
        keep = major.filter(F.col("_rank") <= F.lit(int(b["nmin"]))).drop("_rank")
        return df.filter(F.col(label) != F.lit(b["major"])).unionByName(keep)
    minor = _ranked(df.filter(F.col(label) == F.lit(b["minor"])), id_col, seed, out="_idx")
    # The draws are a distributed ``range`` so no single task generates them; they are counted per index
    # (map-side) before the join, so that few minority rows do not gather all draws.
    extra = int(b["nmax"]) - int(b["nmin"])
    times = (df.sparkSession.range(extra)
             .select((F.pmod(hex_prefix_int(seeded_hash(seed, F.col("id")), 12), F.lit(int(b["nmin"]))) + 1).alias("_idx"))
             .groupBy("_idx").agg(F.count(F.lit(1)).alias("_times")))
    added = minor.join(times, "_idx").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return df.unionByName(added.select(*df.columns))
