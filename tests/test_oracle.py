"""Spark plans against the DuckDB oracle SQL on the sf0.001 tables (same check as the driver)."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import digest, duck

from .conftest import SF_SMALL

SAMPLE = ["disease_flags", "prevalence_by_site", "cohort_controls", "cohort_bootstrap", "age_years", "repair_icd",
          "repair_certainty", "dedup_diagnoses", "preprocess", "labs_map", "lab_majority", "symptoms",
          "frequency_encode", "dataset_e78", "word_count", "tfidf", "patient_tfidf", "stratified_folds", "roc_auc",
          "classification_report", "gaussian_nb", "discriminative_tests", "relevant_test_score", "dataset_e75",
          "control_sweep", "age_bands", "top_abnormal_tests", "lab_ordinal_pivot"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = [tuple(r) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "diagnosis_E75_22" in df.columns
