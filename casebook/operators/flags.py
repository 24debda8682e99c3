"""Disease flags (F1-F6), cases (J1) and prevalence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.columns import has_all
from casebook.functions.rules import DISEASES_MODULE, DISEASES_NOTEBOOK
from casebook.schema import PATIENT, SITE

REGISTRIES = {"module": DISEASES_MODULE, "notebook": DISEASES_NOTEBOOK}


def disease_flags(df: DataFrame, registry: dict | None = None, variant: str = "module") -> DataFrame:
    """Add one int score column per disease and ``is_disease`` (their sum).

    A score counts the (column, term) pairs that hit; a term is a tuple of fragments that must all
    occur. "any" registries (one spelling suffices) give 0/1. Pure narrow projection: no shuffle.
    """
    reg = registry or REGISTRIES[variant]
    cols = {}
    for name, spec in reg.items():
        hits = [has_all(c, frags).cast("int") for c, frags in spec["terms"]]
        if spec["any"]:
            score = F.greatest(*hits) if len(hits) > 1 else hits[0]
        else:
            score = hits[0]
            for h in hits[1:]:
                score = score + h
        cols[name] = score
    out = df.withColumns(cols)
    total = None
    for name in reg:
        total = F.col(name) if total is None else total + F.col(name)
    return out.withColumn("is_disease", total)


def cases(df: DataFrame, flag: str = "is_disease", by: list[str] | None = None) -> DataFrame:
    """Distinct patients with at least one flagged row (optionally per ``by`` columns)."""
    keys = (by or []) + [PATIENT]
    return df.filter(F.col(flag) != 0).select(*keys).distinct()


def prevalence_by_site(flagged: DataFrame, flags: list[str]) -> DataFrame:
    """Per site and disease: distinct flagged patients, distinct patients, percentage.

    Two-level aggregate instead of several COUNT DISTINCTs (which Spark would expand into one
    copy of the data per distinct expression): first one row per (site, patient) with the max of
    each flag — partial aggregation on the map side — then a tiny per-site count."""
    per_patient = flagged.groupBy(SITE, PATIENT).agg(*[F.max(f).alias(f) for f in flags])
    aggs = [F.count(F.lit(1)).alias("patients")]
    aggs += [F.count_if(F.col(f) > 0).alias(f"cases__{f}") for f in flags]
    wide = per_patient.groupBy(SITE).agg(*aggs)
    stack = ", ".join(f"'{f}', cases__{f}" for f in flags)
    long = wide.selectExpr(SITE, "patients", f"stack({len(flags)}, {stack}) as (disease, cases)")
    return long.withColumn("prevalence_pct", F.bround(F.col("cases") / F.col("patients"), 5) * 100)


def prevalence(df: DataFrame, code: str = "E75.22", certainty: str = "G") -> DataFrame:
    """Per site 100·round(distinct certain cases of ``code`` / distinct patients, 5)."""
    hit = ((F.col("SICHERHEIT") == certainty) & (F.col("ICD10") == code)).cast("int")
    per_patient = df.groupBy(SITE, PATIENT).agg(F.max(hit).alias("hit"))
    return per_patient.groupBy(SITE).agg(
        F.coalesce(F.sum("hit"), F.lit(0)).cast("bigint").alias("cases"),
        F.count(F.lit(1)).alias("patients"),
    ).withColumn("prevalence_pct", F.bround(F.col("cases") / F.col("patients"), 5) * 100)
