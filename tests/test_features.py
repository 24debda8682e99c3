"""Hand goldens for per-patient feature operators."""

from pyspark.sql import functions as F

from casebook.operators import features as FT
from casebook.operators import joins as JN
from casebook.operators import labs as LB


def test_dummies_drop_first_and_null(spark):
    df = spark.createDataFrame([("p1", "BER01"), ("p2", "HAM08"), ("p3", None)], "PATIENT_HASH string, ZENTRUM_ID string")
    out = FT.dummies(df, "ZENTRUM_ID", ["BER01", "FRA01", "HAM08", "STR01"]).orderBy("PATIENT_HASH").collect()
    assert [tuple(r) for r in out] == [("p1", 0, 0, 0), ("p2", 0, 1, 0), ("p3", 0, 0, 0)]


def test_frequency_encode(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("none",)], "ICD10 string")
    got = sorted((r[0], r[1]) for r in FT.frequency_encode(df, "ICD10", "enc").collect())
    assert got == [("a", 0.5), ("a", 0.5), ("b", 0.25), ("none", 0.25)]


def test_last_values_null_dates_last(spark):
    df = spark.createDataFrame(
        [("p", "2001-01-01", "a", "x1"), ("p", None, "b", "x2"), ("p", "2005-01-01", "c", None)],
        "PATIENT_HASH string, d string, entry_id string, v string").withColumn("entry_date", F.to_date("d"))
    assert FT.last_values(df, ["v"]).first()["v"] == "x2"


def test_discriminative_argmax_order(spark):
    rows = []
    for i in range(6):  # six patients whose majority is High for T1
        rows += [(f"p{i}", "T1", "High", 1), (f"p{i}", "T1", "Low", 1), (f"p{i}", "T1", "High", 1)]
    rows += [("q", "T1", "Low", 1), ("q", "T1", "High", 1)]  # tie → Low (Low comes first)
    rows += [("r", "T1", "High", 1), ("r", "T1", "Low", 2)]  # one value found in two entries decides
    df = spark.createDataFrame(rows, "PATIENT_HASH string, Lab_test string, Inference string, n long")
    out = LB.discriminative_tests(df, min_n=5, min_share=0.6).collect()
    assert [(r.Lab_test, r.High, r.Low, r.n, r.Dominant) for r in out] == [("T1", 6, 2, 8, "High")]


def test_rare_test_filter_does_not_gather_a_test_in_one_task(spark, monkeypatch):
    rows = [(f"p{i}", f"e{i}", i % 3, "HKT" if i % 50 else f"T{i}") for i in range(400)] + [("p", "e", 0, None)]
    labs = spark.createDataFrame(rows, "PATIENT_HASH string, entry_id string, pos int, Lab_test string").repartition(4)
    want = sorted(r for r in rows if r[3] == "HKT")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on tables of many tests
    try:
        for limit in (JN.BROADCAST_ROWS, 0):
            monkeypatch.setattr(JN, "BROADCAST_ROWS", limit)
            kept = LB.filter_rare_tests(labs)
            assert sorted(tuple(r) for r in kept.select("PATIENT_HASH", "entry_id", "pos", "Lab_test").collect()) == want
            plan = kept.groupBy("PATIENT_HASH", "Lab_test").count()._jdf.queryExecution().executedPlan().toString()
            assert all("hashpartitioning(PATIENT_HASH" in line or "_salt" in line for line in plan.split("\n") if "hashpartitioning" in line), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def _lab_entries(spark):
    rows = [("a", "p1", "S", 1, "W", "01.01.20", "Y", "Hb=1+; Hb=2; CHOL=3- x"), ("a", "p1", "S", 1, "W", "01.01.20", "Y", "Hb=1+; Hb=2; CHOL=3- x"),
            ("b", "p2", "S", 2, "M", "01.01.20", "Y", "Hb=9++"), ("c", "p1", "S", 1, "W", "01.01.20", "Y", "Hb=1+; Hb=2; CHOL=3- x"),
            ("d", "p3", "S", 3, None, "02.01.20", "Y", "Hb=4"), ("e", "p3", "S", 3, "W", "02.01.20", "A", None), ("f", "p2", "S", 2, "M", "03.01.20", "Y", "LDL=5"),
            ("f", "p2", "S", 2, "M", "03.01.20", "Y", "LDL=5")]
    return spark.createDataFrame(rows, "entry_id string, PATIENT_HASH string, ZENTRUM_ID string, PATIENT_ID int, PAT_GESCHLECHT string, DATUM string, TYP string, TEXT string")


def test_lab_values_of_entries_that_repeat(spark):
    """CHOL stands in two entries, LDL in one that repeats; the last Hb of a text counts."""
    df = _lab_entries(spark)
    m = LB.lab_map(LB.filter_rare_tests(LB.explode_labs(df, ("eq",), dedup=False)))
    got = {(r["PATIENT_HASH"], r["i"], r["r"]) for r in m.select("PATIENT_HASH", LB.map_text("inference").alias("i"), LB.map_text("result").alias("r")).collect()}
    assert got == {("p1", "CHOL:Low;Hb:Normal", "CHOL:3- x;Hb:2"), ("p2", "Hb:Very high", "Hb:9++")}
    joined = LB.join_labs(df, LB.interpret_tests(df, ["Hb", "CHOL", "LDL"]))
    assert joined.columns == [*LB.WIDE_KEYS, "entry_id", "PATIENT_ID", "PAT_GESCHLECHT", "Hb", "CHOL", "LDL"]
    got = sorted((r["entry_id"], r["Hb"], r["CHOL"], r["LDL"]) for r in joined.collect())
    assert got == [("a", "Normal", "Low", None), ("a", "Normal", "Low", None), ("b", "Very high", None, None), ("c", "Normal", "Low", None),
                   ("d", None, None, None), ("e", None, None, None), ("f", None, None, None), ("f", None, None, None)]


def test_a_lab_text_is_sent_once(spark):
    """Neither once a piece, nor again for the join, nor to drop repeats."""
    df = _lab_entries(spark)
    plan = lambda f: [x for x in f._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    maps = plan(LB.lab_map(LB.filter_rare_tests(LB.explode_labs(df, ("eq",), dedup=False))))
    assert len(maps) == 1 and "TEXT" in maps[0]
    wide = LB.interpret_tests(df, ["Hb", "CHOL"])
    joined = plan(LB.join_labs(df, wide).select("entry_id", "Hb", "CHOL"))
    assert [("TEXT" in x, "_entry" in x) for x in joined].count((True, False)) == 1 and all("_entry" in x or "TEXT" in x for x in joined)
