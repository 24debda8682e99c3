"""Hand goldens: every branch of the row rules, nulls and rule order."""

from pyspark.sql import functions as F

from casebook.operators import dates as DT
from casebook.operators import diagnosis as DG
from casebook.operators import flags as FL
from casebook.operators import labs as LB
from casebook.operators import text as TX
from casebook.schema import RAW_COLUMNS


def rows(spark, data, cols):
    return spark.createDataFrame(data, cols)


def raw(spark, recs):
    """Raw journal rows from dicts (missing columns null)."""
    data = [tuple(r.get(c) for c in RAW_COLUMNS) for r in recs]
    schema = ", ".join(f"{c} {'bigint' if c == 'PATIENT_ID' else 'string'}" for c in RAW_COLUMNS)
    df = spark.createDataFrame(data, schema)
    return df.withColumn("entry_id", F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in RAW_COLUMNS])))


def test_infer_result(spark):
    cases = [("4.5--", "Very low"), ("4.5-", "Low"), ("4.5++", "Very high"), ("4.5+", "High"),
             ("NEGATIV", "Negative"), ("Positiv", "Positive"), ("4.5 (1-5)", "Normal"), ("3 (1--5)", "Normal"),
             ("-- (x)", "Very low"), (None, None)]
    df = rows(spark, [(c,) for c, _ in cases], "Result string")
    got = [r[0] for r in df.select(LB.infer_result("Result")).collect()]
    assert got == [e for _, e in cases]


def test_flags_literal_and_null(spark):
    df = raw(spark, [{"TEXT": "M. Gaucher E75.22G gaucher", "ICD10": "E75.22"},
                     {"TEXT": None, "ICD10": "E75.22"},
                     {"TEXT": "E75x22 amiliäre hyperchol"}])
    got = FL.disease_flags(df).select("is_E75_22", "is_E78_01", "is_disease").collect()
    assert [tuple(r) for r in got] == [(4, 0, 4), (1, 0, 1), (0, 1, 1)]


def test_dates_century_and_typos(spark):
    df = raw(spark, [{"DATUM": "01.02.20", "PAT_GEBDATUM": "03.04.25"},
                     {"DATUM": "01.02.21", "PAT_GEBDATUM": "03.04.05"},
                     {"DATUM": "01.02.50", "PAT_GEBDATUM": "03.04.10"},
                     {"DATUM": "29.02.90", "PAT_GEBDATUM": "03.04.01"}])
    out = DT.add_age(df).select("entry_date", "birth_date", "age").collect()
    assert str(out[0].entry_date) == "2020-02-01" and str(out[0].birth_date) == "1925-04-03"
    assert str(out[1].entry_date) == "1921-02-01" and str(out[1].birth_date) == "1905-04-03"
    assert str(out[2].entry_date) == "2005-02-01" and str(out[2].birth_date) == "1910-04-03"
    assert out[3].entry_date is None  # 29.02.2009 after the typo repair: lenient → null
    off = DT.add_entry_date(df, typo_scope=None).select("entry_date").collect()
    assert str(off[2].entry_date) == "1950-02-01"


def test_repair_icd_order(spark):
    df = raw(spark, [{"TYP": "A", "ICD10": "E55.-"},
                     {"TYP": "*", "TEXT": "M. Gaucher Familiäre Hypercholesterinämie"},
                     {"TYP": "D", "TEXT": "Struma E04.9G"},
                     {"TYP": "*", "ICD10": "E75.2", "TEXT": "Gaucher"},
                     {"TYP": "Y", "TEXT": "E04.9G"}])
    got = [r[0] for r in DG.repair_icd(FL.disease_flags(df)).select("ICD10").collect()]
    assert got == ["E55.", "E75.22", "E04.9", "E75.22", None]


def test_repair_certainty(spark):
    df = raw(spark, [{"TYP": "*", "TEXT": "Ausschluss V.a. x", "SICHERHEIT": "G"},
                     {"TYP": "D", "TEXT": "V.a. Anämie"},
                     {"TYP": "*", "ICD10": "I10.90"},
                     {"TYP": "A", "ICD10": "E04.9", "TEXT": "Struma E04.9Z"},
                     {"TYP": "A", "TEXT": "nanG"}])
    got = [r[0] for r in DG.repair_certainty(df).select("SICHERHEIT").collect()]
    assert got == ["A", "V", "G", "Z", None]


def test_labels_priority(spark):
    df = rows(spark, [("p1", "E75.22", "*", "G"), ("p1", "E75.22", "D", "A"), ("p2", "E75.22", "*", "Z"),
                      ("p3", "E75.22", "D", "G"), ("p4", "I10.90", "*", "G")],
              "PATIENT_HASH string, ICD10 string, TYP string, SICHERHEIT string")
    got = {r[0]: r[1] for r in DG.label_diagnosis(df, ["E75.22"]).select("PATIENT_HASH", "diagnosis_E75_22").collect()}
    assert got == {"p1": "excluded", "p2": "confirmed", "p3": "suspicious", "p4": None}


def test_explode_labs_formats(spark):
    df = raw(spark, [{"TYP": "Y", "TEXT": "HKT=43- %;  CHOL=5+ mg (1-5); a=b=c; kein Wert; Eos 3+ % (2 - 4)"}])
    eq = LB.explode_labs(df, ("eq",)).select("Lab_test", "Result", "Inference").collect()
    assert [tuple(r) for r in eq] == [("HKT", "43- %", "Low"), ("CHOL", "5+ mg (1-5)", "High"), ("a", "b=c", "Normal")]
    rg = LB.explode_labs(df, ("range",)).select("Lab_test", "Result").collect()
    assert [tuple(r) for r in rg] == [("CHOL=5+", "mg (1-5)"), ("Eos", "3+ % (2 - 4)")]


def test_majority_ties(spark):
    df = rows(spark, [("p1", "Y", "Low"), ("p1", "Y", "High"), ("p2", "Y", "Positive"), ("p3", "Y", None),
                      ("p4", "Y", "Very high"), ("p4", "Y", "Very high"), ("p4", "Y", "Normal")],
              "PATIENT_HASH string, TYP string, HB string")
    got = {r[0]: r[1] for r in LB.lab_majority(df, ["HB"]).collect()}
    assert got == {"p1": "Low", "p2": "Low", "p3": "no_test", "p4": "Very high"}


def test_word_count_matches_join(spark):
    texts = [["a b", "c d"], [" x", "y "], ["one", "two", "three"], ["p ", " q"]]
    data = []
    for i, ts in enumerate(texts):
        for k, t in enumerate(ts):
            data.append((f"p{i}", "A", t, f"2000-01-{k + 1:02d}", f"{k}"))
    df = rows(spark, data, "PATIENT_HASH string, TYP string, TEXT string, d string, entry_id string") \
        .withColumn("entry_date", F.to_date("d"))
    got = {r[0]: r[1] for r in TX.patient_word_count(df).select("PATIENT_HASH", "notes_word_count").collect()}
    want = {f"p{i}": len(",".join(ts).strip().split()) for i, ts in enumerate(texts)}
    assert got == want


# Word → stem pairs of the published Snowball German sample, and of its rules one by one.
STEMS = {"häuser": "haus", "katzen": "katz", "kategorie": "kategori", "kategorien": "kategori", "kategorisch": "kategor",
         "kategorischen": "kategor", "kater": "kat", "katers": "kat", "kätzchen": "katzch", "aufeinander": "aufeinand",
         "aufeinanderfolgenden": "aufeinanderfolg", "aufeinanderbiss": "aufeinanderbiss", "abhängigkeit": "abhang",
         "bauern": "bau", "freundlichkeit": "freundlich", "verlässlichkeit": "verlass", "kenntnisse": "kenntnis",
         "lustige": "lustig", "beleidigung": "beleid", "laufende": "laufend", "weiß": "weiss", "a": "a", "": ""}


def test_stemmer_examples(spark):
    df = rows(spark, [(w,) for w in STEMS], "w string")
    got = {r[0]: r[1] for r in df.select("w", TX.german_stem(F.col("w"))).collect()}
    assert got == STEMS


def test_single_letters_are_removed(spark):
    df = rows(spark, [("a b Wort <br> c é 7 x. in-y",)], "t string")
    row = df.select(TX.clean_tokens("t").alias("a"), TX.clean_tokens("t", for_embedding=True).alias("b")).first()
    assert row["a"] == ["wort", "7"] and row["b"] == ["Wort", "7", ".", "in"]


def test_entry_ids_tell_shifted_nulls_and_separators_apart(spark):
    from casebook.schema import RAW_COLUMNS, RAW_SCHEMA
    from casebook.sources.fixtures import add_entry_id

    def row(**kw):
        return tuple(kw.get(c) for c in RAW_COLUMNS)

    data = [row(ICD10="G"), row(SICHERHEIT="G"), row(TEXT="a|b"), row(TEXT="a", ICD10="b"), row(TEXT="1:x"), row(TEXT=""), row()]
    df = spark.createDataFrame(data, RAW_SCHEMA)
    assert add_entry_id(df).select("entry_id").distinct().count() == len(data)


def lab_fixture(spark):
    """Two patients; p1 has an entry twice (same day, same text), in which HB stands twice."""
    cols = ["entry_id", "pos", "PATIENT_HASH", "ZENTRUM_ID", "PATIENT_ID", "PAT_GESCHLECHT", "DATUM", "TYP", "TEXT", "Lab_test", "Inference", "Result"]
    entry = ("p1", "S", 1, "W", "01.01.10", "Y", "HB=1+; HB=1-")
    labs = [("e1", 0, *entry, "HB", "High", "1+"), ("e1", 1, *entry, "HB", "Low", "1-")]
    rows_ = [("e1", *entry), ("e1", *entry), ("e2", "p2", "S", 2, "W", "01.01.10", "A", "note")]
    types = "entry_id string, pos int, PATIENT_HASH string, ZENTRUM_ID string, PATIENT_ID long, PAT_GESCHLECHT string, DATUM string, TYP string, TEXT string"
    labs = spark.createDataFrame(labs, types + ", Lab_test string, Inference string, Result string")
    entries = spark.createDataFrame(rows_, types.replace("pos int, ", ""))
    assert labs.columns == cols
    return labs, entries


def test_last_value_of_an_entry_counts_once_per_row(spark):
    values = LB.entry_values(*lab_fixture(spark)).collect()
    assert [(r["PATIENT_HASH"], r["Lab_test"], r["Inference"], r["n"]) for r in values] == [("p1", "HB", "Low", 2)]


def test_patients_without_a_relevant_value_score_zero(spark):
    labs, entries = lab_fixture(spark)
    dominant = spark.createDataFrame([("HB", "Low")], "Lab_test string, Dominant string")
    got = LB.relevant_test_score(LB.entry_values(labs, entries), dominant, entries.select("PATIENT_HASH").distinct())
    assert {r[0]: r[1] for r in got.collect()} == {"p1": 2, "p2": 0}
