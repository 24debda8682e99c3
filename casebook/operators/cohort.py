"""Cohorts: cases, seeded control samples, membership filters.

Randomness is a seeded md5 order (``md5(seed ':' patient)``), so a draw is reproducible, independent
of row order and partitioning, and equal to the oracle's ``ORDER BY md5(...)``.

Scale: ranking a whole site (or the whole pool) in one window would put every patient of that
site into one task. Instead ranks are computed inside hash-prefix buckets (4096 per group), and a
tiny per-(group, bucket) count table — at most groups x 4096 rows — supplies each bucket's offset.
The result is the exact global rank with bounded task sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import hex_prefix_int, seeded_hash
from casebook.schema import PATIENT, SITE

BUCKET_DIGITS = 3  # 16**3 = 4096 buckets per group


def rank_by_hash(df: DataFrame, group: list[str], hash_col: str, out: str = "rank") -> DataFrame:
    """Exact 1-based rank of each row by ``hash_col`` (ties by the row's other key columns are not
    expected: hashes of distinct keys) within ``group``, without a whole-group window."""
    b = df.withColumn("_bucket", hex_prefix_int(F.col(hash_col), BUCKET_DIGITS))
    counts = b.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    inner = Window.partitionBy(*group, "_bucket").orderBy(hash_col)
    return (b.join(offsets, [*group, "_bucket"])
            .withColumn(out, F.row_number().over(inner) + F.col("_offset"))
            .drop("_bucket", "_offset"))


def _per_patient(df: DataFrame, flag: str, by: str) -> DataFrame:
    return df.groupBy(by, PATIENT).agg(F.min(F.col(flag)).alias("_min"), F.max(F.col(flag)).alias("_max"))


def _controls_from(per: DataFrame, seed: int, pool: str, by: str) -> DataFrame:
    n_cases = per.groupBy(by).agg(F.count_if(F.col("_max") != 0).alias("_want"))
    cond = (F.col("_min") == 0) if pool == "rows" else (F.col("_max") == 0)
    candidates = per.filter(cond).select(by, PATIENT).withColumn("_h", seeded_hash(seed, F.col(PATIENT)))
    ranked = rank_by_hash(candidates, [by], "_h", "_rank")
    return ranked.join(n_cases, by).filter(F.col("_rank") <= F.col("_want")).select(by, PATIENT)


def sample_controls(df: DataFrame, seed: int = 0, flag: str = "is_disease", pool: str = "rows",
                    by: str = SITE) -> DataFrame:
    """Per site, as many controls as the site has cases, drawn without replacement.

    Returns (site, PATIENT_HASH). A pool smaller than the case count saturates (the reference raises)."""
    return _controls_from(_per_patient(df, flag, by), seed, pool, by)


def bootstrap_controls(df: DataFrame, exclude: DataFrame, k: int, seed: int = 0,
                       flag: str | None = None) -> DataFrame:
    """``k`` draws with replacement from patients not in ``exclude``; returns the distinct set.

    Pool patients get an exact global index (bucketed rank); draw i picks index
    ``hex(md5(seed ':' i))[0:12] mod n``. ``flag`` (J4): the pool keeps only rows with flag 0."""
    return control_draws(df, exclude, k, seed, flag).select(PATIENT)


def control_draws(df: DataFrame, exclude: DataFrame, k: int, seed: int = 0, flag: str | None = None) -> DataFrame:
    """``bootstrap_controls`` with ``first_draw``, the draw that first picks the patient. Draws do not depend on k,
    so the sample of a smaller k is the patients with ``first_draw`` below it."""
    rows = df if flag is None else df.filter(F.col(flag) == 0)
    pool = (rows.select(PATIENT).distinct().join(exclude.select(PATIENT), PATIENT, "left_anti")
            .withColumn("_h", F.md5(F.col(PATIENT))).withColumn("_all", F.lit(1)))
    indexed = rank_by_hash(pool, ["_all"], "_h", "_idx")
    n = indexed.agg(F.count(F.lit(1))).scalar()  # the pool size, a scalar subquery
    draws = (df.sparkSession.range(k).withColumn("_dh", seeded_hash(seed, F.col("id")))
             .withColumn("_idx", F.pmod(hex_prefix_int(F.col("_dh"), 12), n) + 1)
             .groupBy("_idx").agg(F.min("id").alias("first_draw")))
    return indexed.join(draws, "_idx").select(PATIENT, "first_draw")


def keep_patients(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the given patients (semi join — no duplication, no columns added)."""
    return df.join(ids.select(PATIENT).distinct(), PATIENT, "left_semi")


def drop_patients(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of all other patients."""
    return df.join(ids.select(PATIENT), PATIENT, "left_anti")


def label_membership(df: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """1 if the patient is in ``ids`` else 0."""
    marked = ids.select(PATIENT).distinct().withColumn("_m", F.lit(1))
    return df.join(marked, PATIENT, "left").withColumn(name, F.coalesce("_m", F.lit(0))).drop("_m")


def diagnosed_cases(df: DataFrame, code: str = "E75.22", source: str = "label") -> DataFrame:
    """J8 (``label``: diagnosis_<code> confirmed/suspicious) or J9 (``certain``: SICHERHEIT G and ICD10=code)."""
    if source == "label":
        c = f"diagnosis_{code.replace('.', '_')}"
        cond = F.col(c).isin("confirmed", "suspicious")
    else:
        cond = (F.col("SICHERHEIT") == "G") & (F.col("ICD10") == code)
    return df.filter(cond).select(PATIENT).distinct()


def cohort(flagged: DataFrame, seed: int = 0, pool: str = "rows", flag: str = "is_disease") -> DataFrame:
    """Extraction (entry 1): rows of flagged patients plus an equal-sized control sample per site.
    Cases and the control pool come from one (site, patient) aggregate (its exchange is reused)."""
    per = _per_patient(flagged, flag, SITE)
    ids = per.filter(F.col("_max") != 0).select(PATIENT).unionByName(
        _controls_from(per, seed, pool, SITE).select(PATIENT))
    return keep_patients(flagged, ids)
