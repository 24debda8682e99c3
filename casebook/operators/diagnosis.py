"""Diagnosis rules (D7-D10), reimbursement filter (F8), exclusion mark (F14), preprocessing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import has, has_all, has_any
from casebook.functions.rules import (CERTAINTY_SUFFIXES, CERTAINTY_TEXT_RULES, COMORBIDITY_RULES,
                                      E78_SPELLINGS, FLAG_CODES, LABEL_CODES, REIMBURSEMENT_MARKERS)
from casebook.operators.dates import add_age
from casebook.operators.flags import disease_flags
from casebook.schema import ENTRY_ID, PATIENT, SITE

ICD_PATTERN = r"([A-Za-z][0-9]{2}\.[0-9]+)[A-Za-z]"


def _is_diag(typ: str = "TYP") -> Column:
    return F.coalesce(F.col(typ).isin("*", "D"), F.lit(False))


def repair_icd(df: DataFrame) -> DataFrame:
    """Trailing '-' cut (any entry kind); diagnosis rows without a code take the first flagged
    disease (E75.22, E78.01, E78.3, E71.3), else the first code-like text match minus its final
    letter; ``E75.2`` with a Gaucher flag becomes ``E75.22``."""
    icd = F.col("ICD10")
    from_flags = None
    for flag, code in FLAG_CODES:
        cond = F.col(flag) > 0
        from_flags = F.when(cond, code) if from_flags is None else from_flags.when(cond, code)
    text_code = F.nullif(F.regexp_extract(F.coalesce(F.col("TEXT"), F.lit("")), ICD_PATTERN, 1), F.lit(""))
    repaired = (
        F.when(icd.endswith("-"), F.expr("substring(ICD10, 1, length(ICD10) - 1)"))
        .when(_is_diag() & icd.isNull(), from_flags.otherwise(text_code))
        .when(_is_diag() & (icd == "E75.2") & (F.col("is_E75_22") > 0), F.lit("E75.22"))
        .otherwise(icd)
    )
    return df.withColumn("ICD10", repaired)


def repair_certainty(df: DataFrame) -> DataFrame:
    """On diagnosis rows text marks override (usschlu→A, V.a.→V, Z.a.→Z), a coded row without
    certainty is G; then any row without certainty takes the letter written right after its code."""
    cert, icd, text = F.col("SICHERHEIT"), F.col("ICD10"), F.col("TEXT")
    out = None
    for frag, mark in CERTAINTY_TEXT_RULES:
        cond = _is_diag() & has(text, frag)
        out = F.when(cond, mark) if out is None else out.when(cond, mark)
    out = out.when(_is_diag() & icd.isNotNull() & cert.isNull(), "G")
    for s in CERTAINTY_SUFFIXES:
        out = out.when(cert.isNull() & F.coalesce(text.contains(F.concat(icd, F.lit(s))), F.lit(False)), s)
    return df.withColumn("SICHERHEIT", out.otherwise(cert))


def impute_comorbidity_icd(df: DataFrame) -> DataFrame:
    """Diagnosis rows without a code get a co-morbidity code from ordered text rules."""
    out = None
    for frags, code in COMORBIDITY_RULES:
        cond = has_all("TEXT", frags)
        out = F.when(cond, code) if out is None else out.when(cond, code)
    return df.withColumn("ICD10", F.when(_is_diag() & F.col("ICD10").isNull(), out.otherwise(F.col("ICD10")))
                         .otherwise(F.col("ICD10")))


def dedup_diagnoses(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """D7d: diagnosis rows keep the earliest entry per (patient, site, kind, code, certainty); anamnesis
    and lab rows stay; other kinds vanish.

    Anamnesis and lab rows (most of a journal, with its text) pass without an exchange. Diagnosis rows
    are ranked by the five keys; Spark drops all but the first of a key before the shuffle already
    (WindowGroupLimit), so a very active patient is reduced on the map side. Unknown dates sort last
    (pandas puts NaT last); ties on the date break by the content hash."""
    keys = [PATIENT, SITE, "TYP", "ICD10", "SICHERHEIT"]
    ordering = [F.col(c) for c in order] if order else [
        F.col("entry_date").isNull(), F.col("entry_date"), F.col(ENTRY_ID)]
    first = Window.partitionBy(*keys).orderBy(*ordering)
    single = df.filter(_is_diag()).withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") == 1).drop("_rn")
    return df.filter(F.col("TYP").isin("A", "Y")).unionByName(single)


def drop_reimbursement(df: DataFrame) -> DataFrame:
    """F8: drop rows whose text has a reimbursement marker (null text is kept)."""
    return df.filter(~has_any("TEXT", REIMBURSEMENT_MARKERS))


def label_diagnosis(df: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """Per patient and code: excluded (any row code+A) > confirmed (any '*' row code+G/Z) >
    suspicious (any row with the code) > null.

    One per-patient aggregate for all codes (3 flags each). Only patients with one of the codes are
    joined back: they are few, so AQE may broadcast the labels by their measured size; beyond that the
    join on the patient key splits a hot patient's rows across tasks (skew join)."""
    codes = codes or LABEL_CODES
    aggs = []
    for c in codes:
        k = c.replace(".", "_")
        is_c = F.col("ICD10") == c
        aggs += [
            F.max((is_c & (F.col("SICHERHEIT") == "A")).cast("int")).alias(f"_x_{k}"),
            F.max((is_c & (F.col("TYP") == "*") & F.col("SICHERHEIT").isin("G", "Z")).cast("int")).alias(f"_c_{k}"),
            F.max(is_c.cast("int")).alias(f"_s_{k}"),
        ]
    per = df.groupBy(PATIENT).agg(*aggs).filter(" + ".join(f"coalesce(_s_{c.replace('.', '_')}, 0)" for c in codes) + " > 0")
    labels = []
    for c in codes:
        k = c.replace(".", "_")
        labels.append(F.when(F.col(f"_x_{k}") == 1, "excluded").when(F.col(f"_c_{k}") == 1, "confirmed")
                      .when(F.col(f"_s_{k}") == 1, "suspicious").alias(f"diagnosis_{k}"))
    return df.join(per.select(PATIENT, *labels), PATIENT, "left")


WORK_COLUMNS = ["PAT_GEBDATUM", "TYP_EXT", "is_E75_22", "is_E78_01", "is_E78_3", "is_E71_3", "is_disease",
                "birth_date"]


def preprocess(df: DataFrame, keep_flags: bool = False, typo_scope: str | None = "all",
               strict: bool = False, between: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Flags (if absent) → dates and age → code repair → certainty repair → de-dup →
    drop working columns → drop reimbursement rows → per-patient labels.

    ``entry_date`` and ``entry_id`` are kept as the order keys of later steps (the reference keeps
    its rows sorted by patient and date instead). ``between`` (such as ``session.stage``) is applied to the rows before
    their labels, which read them a second time: without it all steps run for the rows and again for the labels."""
    if "is_disease" not in df.columns:
        df = disease_flags(df)
    out = add_age(df, typo_scope=typo_scope, strict=strict)
    out = repair_certainty(repair_icd(out))
    out = dedup_diagnoses(out)
    if not keep_flags:
        out = out.drop(*WORK_COLUMNS)
    out = drop_reimbursement(out)
    return label_diagnosis(out if between is None else between(out))


def mark_excluded(df: DataFrame) -> DataFrame:
    """certainty becomes A where the text mentions an exclusion (``usschl``)."""
    return df.withColumn("SICHERHEIT", F.when(has("TEXT", "usschl"), "A").otherwise(F.col("SICHERHEIT")))


def label_status(df: DataFrame) -> DataFrame:
    """A familial-hypercholesterolaemia spelling sets ICD10 to E78.01; Status = 1 on '*' rows
    with certainty G/Z and code E78.01, else 0."""
    out = df.withColumn("ICD10", F.when(has_any("TEXT", E78_SPELLINGS), "E78.01").otherwise(F.col("ICD10")))
    st = (F.col("SICHERHEIT").isin("G", "Z") & (F.col("ICD10") == "E78.01") & (F.col("TYP") == "*"))
    return out.withColumn("Status", F.when(F.coalesce(st, F.lit(False)), 1).otherwise(0))
