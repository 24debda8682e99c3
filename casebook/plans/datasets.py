"""Model datasets (E3, E4): one row per patient, features joined on the patient key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import rules as R
from casebook.operators import cohort as C
from casebook.operators import diagnosis as DG
from casebook.operators import features as FT
from casebook.operators import labs as LB
from casebook.schema import PATIENT, SITE
from casebook.session import stage

E75_CATEGORIES = [*R.MAJORITY_CATEGORIES, R.NO_TEST]
E75_FEATURES = (["PAT_GESCHLECHT", "age"]
                + [f"{t}_{c.replace(' ', '_')}" for t in R.E75_TESTS for c in E75_CATEGORIES]
                + [FT.safe_name(c) for c in R.COMORBIDITY_CODES] + [g[0] for g in R.SYMPTOM_GROUPS])


def gaucher_subset(pre: DataFrame, k: int, seed: int, source: str = "label", flag: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Cases (J8 ``label``: diagnosis_E75_22 confirmed/suspicious; J9 ``certain``) and a bootstrap of ``k``
    other patients (J4: from rows with ``flag`` 0, if one is given)."""
    cases = stage(C.diagnosed_cases(pre, "E75.22", source=source))
    controls = C.bootstrap_controls(pre, cases, k=k, seed=seed, flag=flag)
    return C.keep_patients(pre, cases.unionByName(controls)), cases


def gaucher_dataset(pre: DataFrame, k: int = 1800, seed: int = 0, source: str = "label", flag: str | None = None) -> DataFrame:
    """Sex, label ``gaucher``, mean age, one-hot lab majorities for 20 tests, 5 co-morbidity
    codes, 11 symptom groups — one row per (patient, sex), nulls → 0. The subset is staged: every
    group of features reads it."""
    subset, cases = gaucher_subset(pre, k, seed, source, flag)
    return gaucher_features(subset, cases)


def gaucher_sweep(pre: DataFrame, ks: list[int], seed: int, source: str = "label", flag: str | None = None) -> DataFrame:
    """The dataset of the largest k of ``ks`` with ``first_draw`` (null for cases), staged. Features are each
    patient's own, so the dataset of a smaller k is its cases and the patients drawn before k."""
    cases = stage(C.diagnosed_cases(pre, "E75.22", source=source))
    draws = stage(C.control_draws(pre, cases, k=max(ks), seed=seed, flag=flag))
    subset = C.keep_patients(pre, cases.unionByName(draws.select(PATIENT)))
    return stage(gaucher_features(subset, cases).join(draws, PATIENT, "left"))


def gaucher_features(subset: DataFrame, cases: DataFrame) -> DataFrame:
    """The rows of E3 for the patients of ``subset``."""
    subset = stage(subset)
    wide = LB.interpret_tests(subset, R.E75_TESTS)
    joined = LB.join_labs(subset, wide)
    majority = LB.lab_majority(joined, R.E75_TESTS)
    tests = LB.one_hot(majority, R.E75_TESTS, E75_CATEGORIES)
    imputed = DG.impute_comorbidity_icd(subset)
    como = FT.comorbidity(imputed, R.COMORBIDITY_CODES)
    symp = FT.symptoms(subset, R.SYMPTOM_GROUPS)
    age = subset.groupBy(PATIENT).agg(F.avg("age").alias("age"))
    base = subset.select(PATIENT, FT.sex_code().alias("PAT_GESCHLECHT")).distinct()
    base = C.label_membership(base, cases, "gaucher")
    out = (base.join(age, PATIENT, "left").join(tests, PATIENT, "left")
           .join(como, PATIENT, "left").join(symp, PATIENT, "left"))
    return out.fillna(0).select(PATIENT, "gaucher", *E75_FEATURES)


E78_SUM_COLUMNS = ["is_E75_22", "is_E78_01", "is_E78_3", "is_E71_3", "is_disease", *R.E78_TESTS,
                   "ICD_mean_encode", "Status"]
E78_FEATURES = ([*R.E78_TESTS, "ICD_mean_encode", "clusters", "is_E71_3", "is_E75_22", "is_E78_01", "is_E78_3",
                 "is_disease"] + [f"{SITE}_{s}" for s in sorted(R.SITES)[1:]] + ["PAT_GESCHLECHT_W"])


def hyperchol_entries(pre_full: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """L17 + D10 + J13: entries with text, exclusion marks, masked 'Y' cells, the mean-ordinal lab
    pivot of the top-20 abnormal tests, Status and cluster ids."""
    labs = LB.explode_labs(pre_full, ("eq", "range"), dedup=False)
    findata = DG.mark_excluded(pre_full.dropna(subset=["TEXT"]))
    nolab = FT.mask_value(findata, "Y")
    top = LB.top_abnormal_tests(labs, nolab, R.E78_PHRASE, 20).select("Lab_test")
    pivot = LB.lab_pivot(labs.join(top, "Lab_test", "left_semi"), R.E78_TESTS)
    final = nolab.join(pivot, [PATIENT, "DATUM"], "left")
    final = final.fillna({"ICD10": "none"}).dropna(subset=["SICHERHEIT"]).fillna(0, subset=R.E78_TESTS)
    final = DG.label_status(final)
    if clusters is not None:
        final = final.join(clusters.select(PATIENT, "clusters"), PATIENT, "left")
    else:
        final = final.withColumn("clusters", F.lit(None).cast("int"))
    return final


def hyperchol_dataset(pre_full: DataFrame, clusters: DataFrame | None = None, binarise: bool = False) -> DataFrame:
    """Per patient sums of flags, 20 lab ordinals, code frequency and Status; last cluster, sex
    and site; missing cluster = 100; Status 2 → 1 (``binarise`` maps every positive to 1); site and
    sex dummies (first level dropped)."""
    final = hyperchol_entries(pre_full, clusters)
    model = FT.frequency_encode(final.drop("TYP", "SICHERHEIT"), "ICD10", "ICD_mean_encode")
    sums = FT.patient_sums(model, E78_SUM_COLUMNS)
    last = FT.last_values(model, ["clusters", "PAT_GESCHLECHT", SITE, "PATIENT_ID"])
    out = sums.join(last, PATIENT, "left").fillna({"clusters": 100})
    status = F.least(F.col("Status"), F.lit(1)) if binarise else F.when(F.col("Status") == 2, 1).otherwise(F.col("Status"))
    out = out.withColumn("Status", status.cast("bigint"))
    out = FT.dummies(out, SITE, R.SITES)
    out = FT.dummies(out, "PAT_GESCHLECHT", ["M", "W"])
    return out.select(PATIENT, "Status", *E78_FEATURES)
