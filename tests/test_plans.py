"""Plan shape: no Python UDF in the hot path, filters reach the Parquet scan."""

import __spark_entry__ as E
from casebook.operators import diagnosis as DG
from casebook.plans import queries as Q
from casebook.session import compiled_parts, stage

from .conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs(spark):
    for name in ["preprocess", "labs_wide", "dataset_e75", "dataset_e78", "tfidf", "word_count", "stem_notes"]:
        p = plan(E.queries()[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_filter_pushed_to_scan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/labels.parquet").filter("toxic = 1").select("doc_id")
    p = plan(df)
    assert "EqualTo(toxic,1)" in p.split("PushedFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<doc_id:bigint,toxic:int>" in p


def test_no_cartesian_or_nested_loop_joins(spark):
    names = ["cohort_rows", "cohort_bootstrap", "preprocess", "frequency_encode", "lab_majority", "tfidf",
             "patient_tfidf", "cluster_assign", "train_test_split", "oversample", "classification_report",
             "gaussian_nb", "roc_auc"]
    for name in names:
        p = plan(E.queries()[name](spark, SF_SMALL))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in p, (name, bad)


def test_labels_read_the_staged_rows(spark):
    """The steps before the labels run once: all that the labelled rows read is the stage of the unlabelled ones."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(key), []

    def between(rows):
        seen.append((spark.conf.get(key), stage(rows)))
        return seen[-1][1]

    with compiled_parts(spark):
        rows = DG.preprocess(Q.J(spark, SF_SMALL), keep_flags=True, between=between)
        files = set(rows.inputFiles())
    assert [k for k, _ in seen] == ["8000"] and spark.conf.get(key) == before
    assert files == set(seen[0][1].inputFiles())
    plain = Q.pre(spark, SF_SMALL, keep_flags=True)
    assert rows.columns == plain.columns and rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
