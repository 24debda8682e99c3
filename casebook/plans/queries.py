"""Named queries: each is a Spark plan over the driver tables plus its oracle SQL.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, sql or None)``. Every query reads whole tables
(through the journal view or the document/embedding tables); nothing is capped or sampled except
where sampling is the operator itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions import rules as R
from casebook.operators import cohort as C
from casebook.operators import flags as FL
from casebook.plans import oracle as O
from casebook.schema import FLAG_COLUMNS, PATIENT, SITE
from casebook.session import apply_plan_settings, compiled_parts, stage
from casebook.sources import journal as IO
from casebook.sources.fixtures import journal_view

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, sql)
        return fn

    return deco


def J(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_plan_settings(spark)
    return journal_view(spark, sf_dir)


def flagged(spark: SparkSession, sf_dir: str, variant: str = "module") -> DataFrame:
    return FL.disease_flags(J(spark, sf_dir), variant=variant)


NB_FLAGS = list(R.DISEASES_NOTEBOOK)

# ---------------------------------------------------------------- step 1: sources, flags, cases


@query("disease_flags", O.sql(
    f"SELECT entry_id, PATIENT_HASH, ZENTRUM_ID, {', '.join(FLAG_COLUMNS)}, is_disease FROM flags", "flags"))
def q_disease_flags(spark, sf_dir):
    return flagged(spark, sf_dir).select("entry_id", PATIENT, SITE, *FLAG_COLUMNS, "is_disease")


@query("disease_flags_notebook", O.sql(
    f"SELECT entry_id, PATIENT_HASH, {', '.join(NB_FLAGS)}, is_disease FROM flags_nb", "flags_nb"))
def q_disease_flags_nb(spark, sf_dir):
    return flagged(spark, sf_dir, "notebook").select("entry_id", PATIENT, *NB_FLAGS, "is_disease")


@query("is_disease_cases", O.sql(
    "SELECT DISTINCT ZENTRUM_ID, PATIENT_HASH FROM flags WHERE is_disease <> 0", "flags"))
def q_cases(spark, sf_dir):
    return FL.cases(flagged(spark, sf_dir), by=[SITE])


_PREV_SQL = O.sql(
    "SELECT ZENTRUM_ID, patients, disease, cases, round_even(cases / patients, 5) * 100 AS prevalence_pct FROM ("
    " SELECT ZENTRUM_ID, count(*) AS patients, "
    + ", ".join(f"count_if({f} > 0) AS c_{f}" for f in FLAG_COLUMNS)
    + " FROM (SELECT ZENTRUM_ID, PATIENT_HASH, "
    + ", ".join(f"max({f}) AS {f}" for f in FLAG_COLUMNS)
    + " FROM flags GROUP BY ALL) p GROUP BY ZENTRUM_ID) w, LATERAL (VALUES "
    + ", ".join(f"('{f}', c_{f})" for f in FLAG_COLUMNS)
    + ") v(disease, cases)", "flags")


@query("prevalence_by_site", _PREV_SQL)
def q_prevalence(spark, sf_dir):
    return FL.prevalence_by_site(flagged(spark, sf_dir), FLAG_COLUMNS)


@query("journal_profile", O.sql(
    "SELECT ZENTRUM_ID, count(*) AS n_rows, count(DISTINCT PATIENT_HASH) AS n_patients, "
    "round(count(*) / count(DISTINCT PATIENT_HASH), 6) AS rows_per_patient, "
    "count(DISTINCT CASE WHEN PAT_GESCHLECHT = 'W' THEN PATIENT_HASH END) AS n_women, "
    "count_if(TEXT IS NULL) AS null_text, count(DISTINCT TYP) AS n_typ "
    "FROM journal GROUP BY ZENTRUM_ID", "journal"))
def q_profile(spark, sf_dir):
    return IO.profile_journal(J(spark, sf_dir))


@query("null_tokens", O.sql(
    "SELECT " + ", ".join(
        f"count_if({c} IS NULL OR trim({c}) IN ({', '.join(O.q(t) for t in R.NA_TOKENS)})) AS null_{c}"
        for c in ["PAT_GESCHLECHT", "TYP_EXT", "TEXT", "ICD10", "SICHERHEIT"]) + " FROM journal", "journal"))
def q_null_tokens(spark, sf_dir):
    cols = ["PAT_GESCHLECHT", "TYP_EXT", "TEXT", "ICD10", "SICHERHEIT"]
    df = IO.normalise_nulls(J(spark, sf_dir), cols)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


@query("union_sites", O.sql(
    "SELECT ZENTRUM_ID, count(*) AS n_rows FROM ("
    + " UNION ALL ".join(f"SELECT * FROM journal WHERE ZENTRUM_ID = '{s}'" for s in R.SITES)
    + ") u GROUP BY ZENTRUM_ID", "journal"))
def q_union_sites(spark, sf_dir):
    j = J(spark, sf_dir)
    return IO.union_frames(IO.split_sites(j, R.SITES)).groupBy(SITE).agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- step 2: cohort sampling

SEED = 7

_POOL = ("SELECT ZENTRUM_ID, PATIENT_HASH, min(is_disease) AS mn, max(is_disease) AS mx "
         "FROM flags GROUP BY ZENTRUM_ID, PATIENT_HASH")


def _controls_sql(pool_cond: str) -> str:
    return (
        f"SELECT ZENTRUM_ID, PATIENT_HASH FROM (SELECT p.ZENTRUM_ID, p.PATIENT_HASH, "
        f"row_number() OVER (PARTITION BY p.ZENTRUM_ID ORDER BY md5('{SEED}:' || p.PATIENT_HASH)) AS rk, c.want "
        f"FROM ({_POOL}) p JOIN (SELECT ZENTRUM_ID, count_if(mx <> 0) AS want FROM ({_POOL}) x GROUP BY ZENTRUM_ID) c "
        f"USING (ZENTRUM_ID) WHERE {pool_cond}) r WHERE rk <= want")


@query("cohort_controls", O.sql(_controls_sql("p.mn = 0"), "flags"))
def q_controls(spark, sf_dir):
    return C.sample_controls(flagged(spark, sf_dir), seed=SEED)


@query("cohort_controls_clean", O.sql(_controls_sql("p.mx = 0"), "flags"))
def q_controls_clean(spark, sf_dir):
    return C.sample_controls(flagged(spark, sf_dir), seed=SEED, pool="clean")


BOOT_K = 300

_BOOT_SQL = O.sql(
    "SELECT PATIENT_HASH FROM ("
    " SELECT PATIENT_HASH, row_number() OVER (ORDER BY md5(PATIENT_HASH)) AS idx FROM ("
    "  SELECT DISTINCT PATIENT_HASH FROM flags WHERE PATIENT_HASH NOT IN "
    "  (SELECT PATIENT_HASH FROM flags WHERE is_disease <> 0)) pool) ix "
    "WHERE idx IN (SELECT (CAST('0x' || substr(md5('" + str(SEED) + ":' || CAST(range AS VARCHAR)), 1, 12) AS BIGINT) "
    f" % (SELECT count(DISTINCT PATIENT_HASH) FROM flags WHERE PATIENT_HASH NOT IN "
    "  (SELECT PATIENT_HASH FROM flags WHERE is_disease <> 0))) + 1 FROM range(" + str(BOOT_K) + "))", "flags")


@query("cohort_bootstrap", _BOOT_SQL)
def q_bootstrap(spark, sf_dir):
    fl = flagged(spark, sf_dir)
    return C.bootstrap_controls(fl, FL.cases(fl), k=BOOT_K, seed=SEED)


_COHORT_IDS = (
    "(SELECT PATIENT_HASH FROM flags WHERE is_disease <> 0 UNION SELECT PATIENT_HASH FROM ("
    + _controls_sql("p.mn = 0") + ") ctl)")


@query("cohort_rows", O.sql(
    "SELECT entry_id, PATIENT_HASH, ZENTRUM_ID, TYP, is_disease FROM flags WHERE PATIENT_HASH IN " + _COHORT_IDS,
    "flags"))
def q_cohort_rows(spark, sf_dir):
    return C.cohort(flagged(spark, sf_dir), seed=SEED).select("entry_id", PATIENT, SITE, "TYP", "is_disease")


@query("non_cohort_rows", O.sql(
    "SELECT ZENTRUM_ID, count(*) AS n_rows, count(DISTINCT PATIENT_HASH) AS n_patients FROM flags "
    "WHERE PATIENT_HASH NOT IN " + _COHORT_IDS + " GROUP BY ZENTRUM_ID", "flags"))
def q_non_cohort(spark, sf_dir):
    fl = flagged(spark, sf_dir)
    ids = FL.cases(fl).unionByName(C.sample_controls(fl, seed=SEED).select(PATIENT))
    rest = C.drop_patients(fl, ids)
    return rest.groupBy(SITE).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(PATIENT).alias("n_patients"))


# ---------------------------------------------------------------- step 3: dates, diagnosis rules

from casebook.operators import dates as DT  # noqa: E402
from casebook.operators import diagnosis as DG  # noqa: E402


def aged(spark, sf_dir):
    return DT.add_age(flagged(spark, sf_dir))


def repaired(spark, sf_dir):
    return DG.repair_certainty(DG.repair_icd(aged(spark, sf_dir)))


def pre(spark, sf_dir, keep_flags=False):
    return DG.preprocess(J(spark, sf_dir), keep_flags=keep_flags)


@query("entry_date", O.sql("SELECT entry_id, entry_date FROM dates", "dates"))
def q_entry_date(spark, sf_dir):
    return DT.add_entry_date(J(spark, sf_dir)).select("entry_id", "entry_date")


@query("birth_date", O.sql("SELECT entry_id, birth_date FROM dates", "dates"))
def q_birth_date(spark, sf_dir):
    return DT.add_birth_date(DT.add_entry_date(J(spark, sf_dir))).select("entry_id", "birth_date")


@query("age_years", O.sql("SELECT entry_id, age FROM aged", "aged"))
def q_age(spark, sf_dir):
    return aged(spark, sf_dir).select("entry_id", "age")


@query("mean_age", O.sql(
    "SELECT PATIENT_HASH, round(avg(age), 6) AS mean_age FROM pre GROUP BY PATIENT_HASH", "pre"))
def q_mean_age(spark, sf_dir):
    from casebook.operators import features as FT
    return FT.mean_age(pre(spark, sf_dir))


@query("repair_icd", O.sql("SELECT entry_id, TYP, ICD10 FROM icd", "icd"))
def q_repair_icd(spark, sf_dir):
    return DG.repair_icd(aged(spark, sf_dir)).select("entry_id", "TYP", "ICD10")


@query("repair_certainty", O.sql("SELECT entry_id, ICD10, SICHERHEIT FROM cert", "cert"))
def q_repair_cert(spark, sf_dir):
    return repaired(spark, sf_dir).select("entry_id", "ICD10", "SICHERHEIT")


def _impute_sql(src: str) -> str:
    chain = " ".join(f"WHEN {O.has_all('TEXT', frags)} THEN '{code}'" for frags, code in R.COMORBIDITY_RULES)
    return (f"SELECT * REPLACE (CASE WHEN TYP IN ('*', 'D') AND ICD10 IS NULL THEN CASE {chain} ELSE ICD10 END "
            f"ELSE ICD10 END AS ICD10) FROM {src}")


O.cte("pre_imputed", ["pre"], _impute_sql("pre"))


@query("impute_comorbidity", O.sql("SELECT entry_id, TYP, ICD10 FROM pre_imputed", "pre_imputed"))
def q_impute(spark, sf_dir):
    return DG.impute_comorbidity_icd(pre(spark, sf_dir)).select("entry_id", "TYP", "ICD10")


@query("dedup_diagnoses", O.sql("SELECT entry_id, TYP, ICD10, SICHERHEIT, entry_date FROM dedup", "dedup"))
def q_dedup(spark, sf_dir):
    return DG.dedup_diagnoses(repaired(spark, sf_dir)).select("entry_id", "TYP", "ICD10", "SICHERHEIT",
                                                              "entry_date")


@query("drop_reimbursement", O.sql(
    "SELECT entry_id, TYP FROM journal WHERE NOT (" + O.has("TEXT", "AL:") + " OR " + O.has("TEXT", "|END") + ")",
    "journal"))
def q_drop_reimb(spark, sf_dir):
    return DG.drop_reimbursement(J(spark, sf_dir)).select("entry_id", "TYP")


_LABEL_COLS = [f"diagnosis_{c.replace('.', '_')}" for c in R.LABEL_CODES]


@query("diagnosis_labels", O.sql(f"SELECT DISTINCT PATIENT_HASH, {', '.join(_LABEL_COLS)} FROM pre", "pre"))
def q_labels(spark, sf_dir):
    return pre(spark, sf_dir).select(PATIENT, *_LABEL_COLS).distinct()


@query("mark_excluded", O.sql(
    "SELECT entry_id, CASE WHEN " + O.has("TEXT", "usschl") + " THEN 'A' ELSE SICHERHEIT END AS SICHERHEIT "
    "FROM journal WHERE TEXT IS NOT NULL", "journal"))
def q_mark_excluded(spark, sf_dir):
    return DG.mark_excluded(J(spark, sf_dir).dropna(subset=["TEXT"])).select("entry_id", "SICHERHEIT")


_STATUS_SQL = O.sql(
    "SELECT entry_id, ICD10, CASE WHEN SICHERHEIT IN ('G', 'Z') AND ICD10 = 'E78.01' AND TYP = '*' THEN 1 ELSE 0 END "
    "AS Status FROM (SELECT * REPLACE (CASE WHEN " + O.has_any("TEXT", R.E78_SPELLINGS)
    + " THEN 'E78.01' ELSE ICD10 END AS ICD10) FROM cert) s", "cert")


@query("status_label", _STATUS_SQL)
def q_status(spark, sf_dir):
    return DG.label_status(repaired(spark, sf_dir)).select("entry_id", "ICD10", "Status")


_PRE_COLS = ["entry_id", "PATIENT_HASH", "ZENTRUM_ID", "PATIENT_ID", "PAT_GESCHLECHT", "DATUM", "TYP", "TEXT",
             "ICD10", "SICHERHEIT", "entry_date", "age", *_LABEL_COLS]


@query("preprocess", O.sql(f"SELECT {', '.join(_PRE_COLS)} FROM pre", "pre"))
def q_preprocess(spark, sf_dir):
    return pre(spark, sf_dir).select(*_PRE_COLS)


# ---------------------------------------------------------------- step 4: labs

from casebook.operators import labs as LB  # noqa: E402

_LONG = ["entry_id", "pos", "test_text", "Lab_test", "Result", "Inference"]


def labs_eq(spark, sf_dir):
    return LB.explode_labs(J(spark, sf_dir), ("eq",))


@query("labs_long", O.sql(f"SELECT {', '.join(_LONG)} FROM labs_eq", "labs_eq"))
def q_labs_long(spark, sf_dir):
    return labs_eq(spark, sf_dir).select(*_LONG)


@query("labs_range_format", O.sql(f"SELECT fmt, {', '.join(_LONG)} FROM labs_both", "labs_both"))
def q_labs_range(spark, sf_dir):
    return LB.explode_labs(J(spark, sf_dir), ("eq", "range"), dedup=False).select("fmt", *_LONG)


@query("infer_result", O.sql(
    "SELECT fmt, Inference, count(*) AS n FROM labs_both GROUP BY fmt, Inference", "labs_both"))
def q_infer(spark, sf_dir):
    labs = LB.explode_labs(J(spark, sf_dir), ("eq", "range"), dedup=False)
    return labs.groupBy("fmt", "Inference").agg(F.count(F.lit(1)).alias("n"))


@query("rare_test_filter", O.sql("SELECT entry_id, pos, Lab_test FROM labs_common", "labs_common"))
def q_rare(spark, sf_dir):
    return LB.filter_rare_tests(labs_eq(spark, sf_dir)).select("entry_id", "pos", "Lab_test")


_MAP_SQL = O.sql(
    f"SELECT {O.MAP_KEYS_SQL}, string_agg(Lab_test || ':' || Inference, ';' ORDER BY Lab_test || ':' || Inference) "
    "AS inference_text, string_agg(Lab_test || ':' || Result, ';' ORDER BY Lab_test || ':' || Result) AS result_text "
    f"FROM labs_last GROUP BY {O.MAP_KEYS_SQL}", "labs_last")


@query("labs_map", _MAP_SQL)
def q_labs_map(spark, sf_dir):
    m = LB.lab_map(LB.filter_rare_tests(LB.explode_labs(J(spark, sf_dir), ("eq",), dedup=False)))  # repeats add nothing to a map
    return m.select(*LB.MAP_KEYS, LB.map_text("inference").alias("inference_text"),
                    LB.map_text("result").alias("result_text"))


def labs_wide(spark, sf_dir):
    return LB.interpret_tests(J(spark, sf_dir), R.E75_TESTS)


@query("labs_wide", O.sql("SELECT * FROM labs_wide", "labs_wide"))
def q_labs_wide(spark, sf_dir):
    return labs_wide(spark, sf_dir)


def labs_joined(spark, sf_dir, keep=None):
    return LB.join_labs(J(spark, sf_dir), labs_wide(spark, sf_dir), keep)


@query("labs_joined", O.sql(f"SELECT entry_id, {', '.join(R.E75_TESTS)} FROM labs_joined", "labs_joined"))
def q_labs_joined(spark, sf_dir):
    return labs_joined(spark, sf_dir).select("entry_id", *R.E75_TESTS)


@query("lab_majority", O.sql(O.majority_sql("labs_joined", R.E75_TESTS), "labs_joined"))
def q_majority(spark, sf_dir):
    return LB.lab_majority(labs_joined(spark, sf_dir), R.E75_TESTS)


def _disc_sql(src: str) -> str:
    cats7 = R.MAJORITY7_CATEGORIES
    cnt = [f"count_if(Inference = {O.q(c)})" for c in cats7]
    major = "CASE " + " ".join(f"WHEN {cnt[i]} >= greatest({', '.join(cnt)}) THEN {O.q(c)}"
                               for i, c in enumerate(cats7)) + " END"
    d4 = R.DOMINANT_CATEGORIES
    cols4 = ", ".join(f"count_if(major = {O.q(c)}) AS \"{c}\"" for c in d4)
    n = " + ".join(f"\"{c}\"" for c in d4)
    mx = f"greatest({', '.join(chr(34) + c + chr(34) for c in d4)})"
    dom = "CASE " + " ".join(f"WHEN \"{c}\" = {mx} THEN {O.q(c)}" for c in d4) + " END"
    return (f"SELECT *, round({mx} / n, 6) AS share, {dom} AS Dominant FROM ("
            f"SELECT *, {n} AS n FROM (SELECT Lab_test, {cols4} FROM ("
            f"SELECT PATIENT_HASH, Lab_test, {major} AS major FROM {src} WHERE Inference <> 'Normal' "
            f"GROUP BY PATIENT_HASH, Lab_test) m GROUP BY Lab_test) a) b")


O.cte("certain_e75", ["pre"], "SELECT * FROM pre WHERE PATIENT_HASH IN "
                              "(SELECT PATIENT_HASH FROM pre WHERE SICHERHEIT = 'G' AND ICD10 = 'E75.22')")
O.cte("certain_src", ["certain_e75"], "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
                                      "(PARTITION BY entry_id) AS rn FROM certain_e75 WHERE TYP = 'Y' AND TEXT IS NOT NULL) d "
                                      "WHERE rn = 1")
O.cte("certain_eq", ["certain_src"], O.with_inference(O.eq_sql("certain_src")))
O.cte("certain_labs", ["certain_eq"],
      "SELECT * FROM certain_eq WHERE (ZENTRUM_ID, Lab_test) IN "
      "(SELECT (ZENTRUM_ID, Lab_test) FROM certain_eq GROUP BY ZENTRUM_ID, Lab_test HAVING count(*) >= 2)")
O.cte("certain_last", ["certain_labs"], f"SELECT {O.MAP_KEYS_SQL}, Lab_test, arg_max(Inference, entry_id || ':' || "
      "lpad(CAST(pos AS VARCHAR), 10, '0')) AS Inference FROM certain_labs WHERE "
      + " AND ".join(f"{k.strip()} IS NOT NULL" for k in O.MAP_KEYS_SQL.split(",")) + " GROUP BY ALL")
O.cte("certain_values", ["certain_last", "certain_e75"],
      "SELECT e.PATIENT_HASH, l.Lab_test, l.Inference FROM certain_e75 e JOIN certain_last l "
      "USING (PATIENT_HASH, ZENTRUM_ID, DATUM, TYP, TEXT) WHERE e.TYP = 'Y'")
O.cte("disc", ["certain_values"], _disc_sql("certain_values"))


def pre_stage(spark, sf_dir, keep_flags=False):
    """The preprocessed journal as a materialised stage (composite queries reuse it twice). The labels read its rows
    staged before, instead of making them a second time."""
    with compiled_parts(spark):
        return stage(DG.preprocess(J(spark, sf_dir), keep_flags=keep_flags, between=stage))


def certain_values(spark, sf_dir):
    """(rows of the patients with a certain E75.22 diagnosis, their lab values per entry)."""
    p = pre_stage(spark, sf_dir)
    rows = stage(C.keep_patients(p, C.diagnosed_cases(p, "E75.22", source="certain")))
    labs = LB.filter_rare_tests(LB.explode_labs(rows, ("eq",)), by=[SITE])
    return rows, LB.entry_values(labs, rows)


_DISC_COLS = ["Lab_test", *R.DOMINANT_CATEGORIES, "n", "share", "Dominant"]


@query("discriminative_tests", O.sql(
    "SELECT " + ", ".join(f'"{c}"' for c in _DISC_COLS) + " FROM disc WHERE n > 5 AND share > 0.6", "disc"))
def q_disc(spark, sf_dir):
    return LB.discriminative_tests(certain_values(spark, sf_dir)[1]).select(*_DISC_COLS)


@query("relevant_test_score", O.sql(
    "SELECT p.PATIENT_HASH, count(d.Lab_test) AS relevant_tests FROM (SELECT DISTINCT PATIENT_HASH FROM certain_e75) p "
    "LEFT JOIN certain_values l USING (PATIENT_HASH) LEFT JOIN (SELECT Lab_test, Dominant FROM disc WHERE n > 5 AND "
    "share > 0.6) d ON d.Lab_test = l.Lab_test AND d.Dominant = l.Inference GROUP BY p.PATIENT_HASH",
    "certain_values", "certain_e75", "disc"))
def q_relevant(spark, sf_dir):
    rows, values = certain_values(spark, sf_dir)
    values = stage(values)
    return LB.relevant_test_score(values, LB.discriminative_tests(values), rows.select(PATIENT).distinct())


O.cte("e78_entries", ["cert"], "SELECT * FROM cert WHERE TEXT IS NOT NULL")
O.cte("top20", ["labs_both", "e78_entries"],
      "SELECT Lab_test, count(*) AS count FROM labs_both WHERE Inference <> 'Normal' AND PATIENT_HASH IN "
      "(SELECT PATIENT_HASH FROM e78_entries GROUP BY PATIENT_HASH HAVING bool_or("
      + O.has("TEXT", R.E78_PHRASE) + ")) GROUP BY Lab_test ORDER BY count DESC, Lab_test LIMIT 20")


@query("top_abnormal_tests", O.sql("SELECT Lab_test, count FROM top20", "top20"))
def q_top20(spark, sf_dir):
    labs = LB.explode_labs(J(spark, sf_dir), ("eq", "range"), dedup=False)
    entries = repaired(spark, sf_dir).filter(F.col("TEXT").isNotNull())
    return LB.top_abnormal_tests(labs, entries, R.E78_PHRASE, 20)


def _ordinal_sql(c: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} = {O.q(k)} THEN {v}" for k, v in R.INFERENCE_ORDINAL.items()) + " END"


@query("lab_ordinal_pivot", O.sql(
    "SELECT PATIENT_HASH, DATUM, " + ", ".join(
        f"avg(CASE WHEN Lab_test = {O.q(t)} THEN {_ordinal_sql('Inference')} END) AS {t}" for t in R.E78_TESTS)
    + " FROM labs_both WHERE Lab_test IN (SELECT Lab_test FROM top20) AND Lab_test IN ("
    + ", ".join(O.q(t) for t in R.E78_TESTS) + ") GROUP BY PATIENT_HASH, DATUM", "top20", "labs_both"))
def q_lab_pivot(spark, sf_dir):
    labs = LB.explode_labs(J(spark, sf_dir), ("eq", "range"), dedup=False)
    entries = repaired(spark, sf_dir).filter(F.col("TEXT").isNotNull())
    top = LB.top_abnormal_tests(labs, entries, R.E78_PHRASE, 20).select("Lab_test")
    return LB.lab_pivot(labs.join(top, "Lab_test", "left_semi"), R.E78_TESTS)


# ---------------------------------------------------------------- step 5: patient features, datasets

from casebook.operators import features as FT  # noqa: E402
from casebook.plans import datasets as DS  # noqa: E402

_COMO_COLS = [FT.safe_name(c) for c in R.COMORBIDITY_CODES]
_SYMP_COLS = [g[0] for g in R.SYMPTOM_GROUPS]


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


@query("comorbidity", O.sql(O.comorbidity_sql("pre_imputed"), "pre_imputed"))
def q_comorbidity(spark, sf_dir):
    return FT.comorbidity(DG.impute_comorbidity_icd(pre(spark, sf_dir)), R.COMORBIDITY_CODES)


@query("symptoms", O.sql(O.symptoms_sql("pre"), "pre"))
def q_symptoms(spark, sf_dir):
    return FT.symptoms(pre(spark, sf_dir), R.SYMPTOM_GROUPS)


@query("symptom_score", O.sql(
    "SELECT PATIENT_HASH, sum(s) AS is_symptom FROM (SELECT PATIENT_HASH, "
    + " + ".join(O.i(O.has("TEXT", t)) for t in R.SYMPTOM_TERMS) + " AS s FROM pre) x WHERE s > 0 GROUP BY PATIENT_HASH",
    "pre"))
def q_symptom_score(spark, sf_dir):
    return FT.symptom_score(pre(spark, sf_dir), R.SYMPTOM_TERMS)


@query("code_frequency", O.sql(
    "SELECT ICD10, count(PATIENT_HASH) AS n FROM pre_imputed WHERE TYP IN ('*', 'D') AND ICD10 IS NOT NULL "
    "GROUP BY ICD10 HAVING count(PATIENT_HASH) > 3", "pre_imputed"))
def q_code_frequency(spark, sf_dir):
    return FT.code_frequency(DG.impute_comorbidity_icd(pre(spark, sf_dir)))


@query("frequency_encode", O.sql(
    "SELECT entry_id, round(count(*) OVER (PARTITION BY ICD10) / count(*) OVER (), 6) AS ICD_mean_encode "
    "FROM (SELECT entry_id, coalesce(ICD10, 'none') AS ICD10 FROM cert) c", "cert"))
def q_frequency_encode(spark, sf_dir):
    df = repaired(spark, sf_dir).fillna({"ICD10": "none"})
    return FT.frequency_encode(df, "ICD10", "ICD_mean_encode").select("entry_id", _r6("ICD_mean_encode"))


_LAST_COLS = ["PAT_GESCHLECHT", "ZENTRUM_ID", "PATIENT_ID", "ICD10", "SICHERHEIT"]


@query("patient_last", O.sql(
    "SELECT PATIENT_HASH, " + ", ".join(
        f"arg_max({c}, coalesce(CAST(entry_date AS VARCHAR), '9999-12-31~') || entry_id) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in _LAST_COLS) + " FROM pre GROUP BY PATIENT_HASH", "pre"))
def q_patient_last(spark, sf_dir):
    return FT.last_values(pre(spark, sf_dir), _LAST_COLS)


_SUM_COLS = [*FLAG_COLUMNS, "is_disease"]


@query("patient_sums", O.sql(
    "SELECT PATIENT_HASH, " + ", ".join(f"sum({c}) AS {c}" for c in _SUM_COLS) + " FROM pre_full GROUP BY PATIENT_HASH",
    "pre_full"))
def q_patient_sums(spark, sf_dir):
    return FT.patient_sums(pre(spark, sf_dir, keep_flags=True), _SUM_COLS)


_CATS6 = [*R.MAJORITY_CATEGORIES, R.NO_TEST]
O.cte("majority", ["labs_joined"], O.majority_sql("labs_joined", R.E75_TESTS))


@query("one_hot_labs", O.sql(O.one_hot_sql("majority", R.E75_TESTS, _CATS6), "majority"))
def q_one_hot(spark, sf_dir):
    return LB.one_hot(LB.lab_majority(labs_joined(spark, sf_dir), R.E75_TESTS), R.E75_TESTS, _CATS6)


@query("site_sex_dummies", O.sql(
    "SELECT PATIENT_HASH, " + ", ".join(f"CASE WHEN ZENTRUM_ID = '{s}' THEN 1 ELSE 0 END AS ZENTRUM_ID_{s}"
                                        for s in sorted(R.SITES)[1:])
    + ", CASE WHEN PAT_GESCHLECHT = 'W' THEN 1 ELSE 0 END AS PAT_GESCHLECHT_W FROM (SELECT PATIENT_HASH, "
    + ", ".join(f"arg_max({c}, coalesce(CAST(entry_date AS VARCHAR), '9999-12-31~') || entry_id) FILTER (WHERE {c} IS NOT NULL) AS {c}"
                for c in ["PAT_GESCHLECHT", "ZENTRUM_ID"]) + " FROM pre GROUP BY PATIENT_HASH) l", "pre"))
def q_dummies(spark, sf_dir):
    last = FT.last_values(pre(spark, sf_dir), ["PAT_GESCHLECHT", SITE])
    return FT.dummies(FT.dummies(last, SITE, R.SITES), "PAT_GESCHLECHT", ["M", "W"])


_EMPTY_SRC = ["entry_id", "PATIENT_HASH", "TEXT", "ICD10", "SICHERHEIT", "TYP_EXT", *R.E75_TESTS]


@query("drop_empty_columns", O.sql(
    "SELECT column_name, non_null FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null FROM labs_joined" for c in _EMPTY_SRC)
    + ") c WHERE non_null > 0", "labs_joined"))
def q_drop_empty(spark, sf_dir):
    # Of the entries' cells only whether they are null is sent through the join.
    there = [F.when(F.col(c).isNotNull(), 1).alias(c) for c in _EMPTY_SRC if c not in R.E75_TESTS]
    src = labs_joined(spark, sf_dir, there).select(*_EMPTY_SRC)
    return FT.empty_column_counts(src).filter(F.col("non_null") > 0)


@query("mask_value", O.sql("SELECT entry_id, nullif(TYP, 'Y') AS TYP, nullif(TEXT, 'Y') AS TEXT FROM journal",
                           "journal"))
def q_mask(spark, sf_dir):
    return FT.mask_value(J(spark, sf_dir), "Y", ["TYP", "TEXT"]).select("entry_id", "TYP", "TEXT")


GAUCHER_K = 1800

O.cte("e75_cases", ["pre"], "SELECT DISTINCT PATIENT_HASH FROM pre WHERE diagnosis_E75_22 IN ('confirmed', 'suspicious')")
O.cte("e75_ids", ["e75_cases"], "SELECT PATIENT_HASH FROM e75_cases UNION "
      + O.bootstrap_sql("pre", "e75_cases", GAUCHER_K, SEED))
O.cte("e75_subset", ["e75_ids"], "SELECT * FROM pre WHERE PATIENT_HASH IN (SELECT PATIENT_HASH FROM e75_ids)")
O.lab_chain("e75", "e75_subset", "e75_subset", R.E75_TESTS)
O.cte("e75_major", ["e75_joined"], O.majority_sql("e75_joined", R.E75_TESTS))
O.cte("e75_onehot", ["e75_major"], O.one_hot_sql("e75_major", R.E75_TESTS, _CATS6))
O.cte("e75_imputed", ["e75_subset"], O.impute_sql("e75_subset"))
O.cte("e75_como", ["e75_imputed"], O.comorbidity_sql("e75_imputed"))
O.cte("e75_symp", ["e75_subset"], O.symptoms_sql("e75_subset"))
O.cte("e75_age", ["e75_subset"], "SELECT PATIENT_HASH, avg(age) AS age FROM e75_subset GROUP BY PATIENT_HASH")
O.cte("e75_base", ["e75_subset", "e75_cases"],
      "SELECT DISTINCT PATIENT_HASH, CASE PAT_GESCHLECHT WHEN 'W' THEN 1 WHEN 'M' THEN 0 END AS PAT_GESCHLECHT, "
      "CASE WHEN PATIENT_HASH IN (SELECT PATIENT_HASH FROM e75_cases) THEN 1 ELSE 0 END AS gaucher FROM e75_subset")
_E75_OUT = ["PATIENT_HASH", "gaucher", *DS.E75_FEATURES]
_E75_SQL = O.sql(
    "SELECT PATIENT_HASH, gaucher, " + ", ".join((f"round(coalesce(\"{c}\", 0), 6) AS \"{c}\"" if c == "age" else f"coalesce(\"{c}\", 0) AS \"{c}\"") for c in DS.E75_FEATURES)
    + " FROM e75_base LEFT JOIN e75_age USING (PATIENT_HASH) LEFT JOIN e75_onehot USING (PATIENT_HASH) "
    "LEFT JOIN e75_como USING (PATIENT_HASH) LEFT JOIN e75_symp USING (PATIENT_HASH)",
    "e75_base", "e75_age", "e75_onehot", "e75_como", "e75_symp")


def dataset_e75(spark, sf_dir):
    return DS.gaucher_dataset(pre_stage(spark, sf_dir), k=GAUCHER_K, seed=SEED)


@query("dataset_e75", _E75_SQL)
def q_dataset_e75(spark, sf_dir):
    return dataset_e75(spark, sf_dir).withColumn("age", F.round("age", 6))

_STR_PRE_FULL = ["PATIENT_HASH", "ZENTRUM_ID", "PAT_GEBDATUM", "PAT_GESCHLECHT", "DATUM", "TYP", "TYP_EXT", "TEXT",
                 "ICD10", "SICHERHEIT", "entry_id", *_LABEL_COLS]
O.cte("e78_ysrc", ["pre_full"], "SELECT * FROM pre_full WHERE TYP = 'Y' AND TEXT IS NOT NULL")
O.cte("e78_labs", ["e78_ysrc"], O.with_inference(O.eq_sql("e78_ysrc") + " UNION ALL " + O.range_sql("e78_ysrc")))
O.cte("e78_find", ["pre_full"],
      "SELECT * REPLACE (" + ", ".join(
          (f"nullif(CASE WHEN {O.has('TEXT', 'usschl')} THEN 'A' ELSE SICHERHEIT END, 'Y') AS SICHERHEIT"
           if c == "SICHERHEIT" else f"nullif({c}, 'Y') AS {c}") for c in _STR_PRE_FULL)
      + ") FROM pre_full WHERE TEXT IS NOT NULL")
O.cte("e78_top20", ["e78_labs", "e78_find"],
      "SELECT Lab_test FROM e78_labs WHERE Inference <> 'Normal' AND PATIENT_HASH IN "
      "(SELECT PATIENT_HASH FROM e78_find GROUP BY PATIENT_HASH HAVING bool_or(" + O.has("TEXT", R.E78_PHRASE)
      + ")) GROUP BY Lab_test ORDER BY count(*) DESC, Lab_test LIMIT 20")
O.cte("e78_pivot", ["e78_labs", "e78_top20"],
      "SELECT PATIENT_HASH, DATUM, " + ", ".join(
          f"avg(CASE WHEN Lab_test = {O.q(t)} THEN {_ordinal_sql('Inference')} END) AS {t}" for t in R.E78_TESTS)
      + " FROM e78_labs WHERE Lab_test IN (SELECT Lab_test FROM e78_top20) AND Lab_test IN ("
      + ", ".join(O.q(t) for t in R.E78_TESTS) + ") GROUP BY PATIENT_HASH, DATUM")
O.cte("e78_final", ["e78_find", "e78_pivot"],
      "SELECT f.* REPLACE (CASE WHEN " + O.has_any("f.TEXT", R.E78_SPELLINGS) + " THEN 'E78.01' ELSE "
      "coalesce(f.ICD10, 'none') END AS ICD10), " + ", ".join(f"coalesce(p.{t}, 0) AS {t}" for t in R.E78_TESTS)
      + " FROM e78_find f LEFT JOIN e78_pivot p USING (PATIENT_HASH, DATUM) WHERE f.SICHERHEIT IS NOT NULL")
O.cte("e78_model", ["e78_final"],
      "SELECT *, CASE WHEN SICHERHEIT IN ('G', 'Z') AND ICD10 = 'E78.01' AND TYP = '*' THEN 1 ELSE 0 END AS Status, "
      "count(*) OVER (PARTITION BY ICD10) / count(*) OVER () AS ICD_mean_encode, CAST(NULL AS INTEGER) AS clusters "
      "FROM e78_final")
_LASTK = "coalesce(CAST(entry_date AS VARCHAR), '9999-12-31~') || entry_id"
O.cte("e78_patients", ["e78_model"],
      "SELECT PATIENT_HASH, " + ", ".join(f"sum({c}) AS {c}" for c in DS.E78_SUM_COLUMNS) + ", "
      + ", ".join(f"arg_max({c}, {_LASTK}) FILTER (WHERE {c} IS NOT NULL) AS {c}"
                  for c in ["clusters", "PAT_GESCHLECHT", "ZENTRUM_ID"]) + " FROM e78_model GROUP BY PATIENT_HASH")
_E78_SQL = O.sql(
    "SELECT PATIENT_HASH, CAST(CASE WHEN Status = 2 THEN 1 ELSE Status END AS BIGINT) AS Status, "
    + ", ".join(f"round({t}, 6) AS {t}" for t in R.E78_TESTS) + ", round(ICD_mean_encode, 6) AS ICD_mean_encode, "
    "coalesce(clusters, 100) AS clusters, is_E71_3, is_E75_22, is_E78_01, is_E78_3, is_disease, "
    + ", ".join(f"CASE WHEN ZENTRUM_ID = '{s}' THEN 1 ELSE 0 END AS ZENTRUM_ID_{s}" for s in sorted(R.SITES)[1:])
    + ", CASE WHEN PAT_GESCHLECHT = 'W' THEN 1 ELSE 0 END AS PAT_GESCHLECHT_W FROM e78_patients", "e78_patients")


def dataset_e78(spark, sf_dir, clusters=None):
    return DS.hyperchol_dataset(pre_stage(spark, sf_dir, keep_flags=True), clusters)


@query("dataset_e78", _E78_SQL)
def q_dataset_e78(spark, sf_dir):
    out = dataset_e78(spark, sf_dir)
    return out.select(*[_r6(c) if c in (*R.E78_TESTS, "ICD_mean_encode") else F.col(c) for c in out.columns])


# ---------------------------------------------------------------- step 6: samplers, folds, metrics

from casebook.operators import metrics as MT  # noqa: E402
from casebook.operators import sampling as SP  # noqa: E402


def labels(spark, sf_dir):
    apply_plan_settings(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")


def _md5r(part: str = "", seed: int = SEED) -> str:
    return f"row_number() OVER ({part} ORDER BY md5('{seed}:' || CAST(doc_id AS VARCHAR)))"


UNDER_N = 100


@query("undersample", O.sql(
    f"SELECT doc_id, toxic FROM labels WHERE toxic <> 0 UNION ALL SELECT doc_id, toxic FROM "
    f"(SELECT doc_id, toxic, {_md5r()} AS rk FROM labels WHERE toxic = 0) n WHERE rk > {UNDER_N}"))
def q_undersample(spark, sf_dir):
    return SP.undersample(labels(spark, sf_dir), UNDER_N, SEED, "doc_id", "toxic")


@query("train_test_split", O.sql(
    f"SELECT doc_id, toxic, CASE WHEN {_md5r()} <= ceil(count(*) OVER () * 0.25) THEN 'test' ELSE 'train' END AS split "
    "FROM labels"))
def q_split(spark, sf_dir):
    return SP.train_test(labels(spark, sf_dir), "doc_id", 0.25, SEED)


@query("kfold", O.sql(f"SELECT doc_id, toxic, CAST(({_md5r()} - 1) % 5 AS INTEGER) AS fold, 0 AS repeat FROM labels"))
def q_kfold(spark, sf_dir):
    return SP.add_folds(labels(spark, sf_dir), "doc_id", 5, SEED)


@query("stratified_folds", O.sql(
    f"SELECT doc_id, toxic, CAST(({_md5r('PARTITION BY toxic')} - 1) % 10 AS INTEGER) AS fold, 0 AS repeat FROM labels"))
def q_strat(spark, sf_dir):
    return SP.add_folds(labels(spark, sf_dir), "doc_id", 10, SEED, stratify="toxic")


@query("repeated_folds", O.sql(" UNION ALL ".join(
    f"SELECT doc_id, toxic, CAST(({_md5r('PARTITION BY toxic', SEED + r)} - 1) % 10 AS INTEGER) AS fold, "
    f"{r} AS repeat FROM labels" for r in range(3))))
def q_repeated(spark, sf_dir):
    return SP.add_folds(labels(spark, sf_dir), "doc_id", 10, SEED, stratify="toxic", repeats=3)


_OVER_SQL = O.sql(
    "WITH c AS (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic), "
    "b AS (SELECT arg_min(toxic, (n, toxic)) AS minor, min(n) AS nmin, max(n) AS nmax FROM c), "
    f"m AS (SELECT doc_id, toxic, {_md5r()} AS idx FROM labels WHERE toxic = (SELECT minor FROM b)), "
    "d AS (SELECT (CAST('0x' || substr(md5('" + str(SEED) + ":' || CAST(range AS VARCHAR)), 1, 12) AS BIGINT) "
    "% (SELECT nmin FROM b)) + 1 AS idx FROM range((SELECT nmax - nmin FROM b))) "
    "SELECT doc_id, toxic FROM labels UNION ALL SELECT m.doc_id, m.toxic FROM d JOIN m USING (idx)")


@query("balance_under", O.sql(
    "WITH c AS (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic), b AS (SELECT arg_max(toxic, (n, toxic)) AS major, "
    f"min(n) AS nmin FROM c), r AS (SELECT doc_id, toxic, {_md5r('PARTITION BY toxic')} AS rk FROM labels) "
    "SELECT doc_id, toxic FROM r WHERE toxic <> (SELECT major FROM b) OR rk <= (SELECT nmin FROM b)"))
def q_balance_under(spark, sf_dir):
    """The larger class cut to the size of the smaller."""
    return SP.resample(labels(spark, sf_dir), "toxic", "doc_id", "under", SEED).select("doc_id", "toxic")


@query("oversample", _OVER_SQL)
def q_oversample(spark, sf_dir):
    return SP.resample(labels(spark, sf_dir), "toxic", "doc_id", "over", SEED).select("doc_id", "toxic")


N_FOLDS = 10
O.cte("emb", [], "SELECT vec_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y, CAST(embedding AS DOUBLE[]) AS x FROM embeddings")
O.cte("emb_folds", ["emb"], f"SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY md5('{SEED}:' || CAST(vec_id AS VARCHAR))) - 1) "
                            f"% {N_FOLDS} AS INTEGER) AS fold FROM emb")


def nb_ctes(prefix: str, src: str, key: str) -> None:
    """Out-of-fold Gaussian naive Bayes over a (key, y, x list, fold) relation → {prefix}_nb (key, fold, y,
    prediction, score)."""
    O.cte(f"{prefix}_long", [src], f"SELECT {key}, fold, y, unnest(x) AS v, unnest(range(0, len(x))) AS j FROM {src}")
    O.cte(f"{prefix}_train", [f"{prefix}_long"], f"SELECT f.fold AS held, l.y, l.j, l.v FROM {prefix}_long l JOIN (SELECT DISTINCT fold FROM "
                                                 f"{prefix}_long) f ON l.fold <> f.fold")
    O.cte(f"{prefix}_eps", [f"{prefix}_train"], f"SELECT held, max(vj) * 1e-9 AS eps FROM (SELECT held, var_pop(v) AS vj FROM {prefix}_train "
                                                "GROUP BY held, j) q GROUP BY held")
    O.cte(f"{prefix}_stats", [f"{prefix}_train", f"{prefix}_eps"],
          f"SELECT s.held, y, j, mu, var + eps AS var FROM (SELECT held, y, j, avg(v) AS mu, var_pop(v) AS var FROM {prefix}_train "
          f"GROUP BY held, y, j) s JOIN {prefix}_eps USING (held)")
    O.cte(f"{prefix}_prior", [src], f"SELECT f.fold AS held, s.y, ln(count(*) / max(n)) AS lp FROM {src} s JOIN (SELECT fold, (SELECT count(*) "
                                    f"FROM {src}) - count(*) AS n FROM {src} GROUP BY fold) f ON s.fold <> f.fold GROUP BY ALL")
    O.cte(f"{prefix}_ll", [f"{prefix}_long", f"{prefix}_stats", f"{prefix}_prior"],
          f"SELECT t.{key}, t.fold, t.y, s.y AS c, round(sum(-0.5 * (ln(2 * pi() * s.var) + (t.v - s.mu) * (t.v - s.mu) / s.var)) + max(p.lp), 9) "
          f"AS ll FROM {prefix}_long t JOIN {prefix}_stats s ON s.held = t.fold AND s.j = t.j JOIN {prefix}_prior p ON p.held = t.fold "
          f"AND p.y = s.y GROUP BY t.{key}, t.fold, t.y, s.y")
    O.cte(f"{prefix}_nb", [f"{prefix}_ll"], f"SELECT {key}, fold, y AS label, CAST(arg_max(c, (ll, -c)) AS INTEGER) AS prediction "
                                            f"FROM {prefix}_ll GROUP BY {key}, fold, y")


nb_ctes("emb", "emb_folds", "vec_id")


def scored_embeddings(spark, sf_dir):
    """Out-of-fold naive Bayes predictions of a rare class (label 0 of the embeddings): the input of the
    metric queries."""
    df = embedding_set(spark, sf_dir)
    return stage(MD.nb_out_of_fold(df, "vec_id", "embedding").select("vec_id", "label", "score", "prediction"))


O.cte("scored", ["emb_ll"], "SELECT vec_id, y AS label, max(ll) FILTER (WHERE c = 1) - max(ll) FILTER (WHERE c = 0) AS score, "
                            "CAST(arg_max(c, (ll, -c)) AS INTEGER) AS prediction FROM emb_ll GROUP BY vec_id, y")
O.cte("tfpn", ["scored"], "SELECT count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 0) AS tn, "
                          "count_if(label = 0 AND prediction = 1) AS fp, count_if(label = 1 AND prediction = 0) AS fn FROM scored")


@query("confusion", O.sql(
    "SELECT a.label, b.prediction, (SELECT count(*) FROM scored s WHERE s.label = a.label AND s.prediction = b.prediction) "
    "AS n FROM (VALUES (0), (1)) a(label), (VALUES (0), (1)) b(prediction)", "scored"))
def q_confusion(spark, sf_dir):
    return MT.confusion(scored_embeddings(spark, sf_dir))


@query("misclassification", O.sql(
    "SELECT tp, tn, fp, fn, round(fn / (tp + fn), 2) * 100 AS pos_misclassified_pct, "
    "round(fp / (tn + fp), 2) * 100 AS neg_misclassified_pct FROM tfpn", "tfpn"))
def q_miscls(spark, sf_dir):
    return MT.misclassification(scored_embeddings(spark, sf_dir))


_REPORT_SQL = O.sql("""
, per AS (
  SELECT '0' AS "row", CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS precision,
         CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS recall, tn + fp AS support FROM tfpn
  UNION ALL
  SELECT '1', CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, tp + fn FROM tfpn),
per2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
         FROM per)
SELECT "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per2
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support) FROM per2
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), sum(support) FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / (tp + tn + fp + fn), 6), tp + tn + fp + fn FROM tfpn
""", "tfpn").replace("\n\n, per AS", "\n, per AS").replace(")\n\n, per AS", "), per AS")


@query("classification_report", _REPORT_SQL)
def q_report(spark, sf_dir):
    return MT.report(scored_embeddings(spark, sf_dir))


@query("roc_auc", O.sql(
    "SELECT round((sum(CASE WHEN label = 1 THEN r END) - P * (P + 1) / 2) / (P * N), 6) AS auc, P AS positives, "
    "N AS negatives FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 "
    "AS r, count_if(label = 1) OVER () AS P, count_if(label = 0) OVER () AS N FROM scored) x GROUP BY P, N", "scored"))
def q_auc(spark, sf_dir):
    return MT.auc(scored_embeddings(spark, sf_dir))


# ---------------------------------------------------------------- step 7: notes, TF-IDF, clusters

from casebook.operators import text as TX  # noqa: E402


def documents(spark, sf_dir):
    apply_plan_settings(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


_WS = "[\\s]"


@query("word_count", O.sql(
    "SELECT PATIENT_HASH, CAST(sum(r) + sum(e) + sum(s) - arg_max(e, k) - arg_min(s, k) - count(*) + 1 AS BIGINT) "
    "AS notes_word_count, count(*) AS n_notes FROM (SELECT PATIENT_HASH, len(regexp_extract_all(TEXT, '\\S+')) AS r, "
    f"CASE WHEN regexp_matches(TEXT, '{_WS}$') THEN 1 ELSE 0 END AS e, "
    f"CASE WHEN regexp_matches(TEXT, '^{_WS}') THEN 1 ELSE 0 END AS s, "
    "coalesce(CAST(entry_date AS VARCHAR), '9999-12-31~') || entry_id AS k FROM pre WHERE TYP = 'A' AND TEXT IS NOT NULL AND length(TEXT) > 0) x "
    "GROUP BY PATIENT_HASH", "pre"))
def q_word_count(spark, sf_dir):
    return TX.patient_word_count(pre(spark, sf_dir))


_STOPS = "[" + ", ".join(O.q(w) for w in TX.german_stop_words()) + "]"
_TOKS = ("list_filter(regexp_extract_all(lower(regexp_replace(coalesce(text, ''), '<[^>]+>', ' ', 'g')), "
         f"'[\\p{{L}}\\p{{N}}_]+'), lambda x: NOT list_contains({_STOPS}, x) AND NOT regexp_matches(x, '^{R.SINGLE_LETTER}$'))")
O.cte("d_raw", [], f"SELECT doc_id, {_TOKS} AS raw FROM documents")
O.stem_ctes("d", "d_raw", "raw")  # d_stem(word, stem)
O.cte("d_pos", ["d_raw"], "SELECT doc_id, unnest(raw) AS word, unnest(range(0, len(raw))) AS pos FROM d_raw")
O.cte("d_tok", ["d_raw", "d_pos", "d_stem"],
      "SELECT r.doc_id, coalesce(t.toks, CAST([] AS VARCHAR[])) AS toks FROM d_raw r LEFT JOIN (SELECT doc_id, "
      "list(stem ORDER BY pos) AS toks FROM d_pos JOIN d_stem USING (word) GROUP BY doc_id) t USING (doc_id)")
O.cte("d_long", ["d_tok"], "SELECT doc_id, toks, list_filter(toks, lambda x: length(x) >= 9) AS lt FROM d_tok")
O.cte("d_terms", ["d_long"], "SELECT doc_id, unnest(list_concat(lt, list_transform(range(1, len(lt)), "
                             "lambda i: lt[i] || ' ' || lt[i + 1]))) AS term FROM d_long")
O.cte("d_tf", ["d_terms"], "SELECT doc_id, term, count(*) AS tf FROM d_terms GROUP BY ALL")
O.cte("d_vocab", ["d_tf"], "SELECT term, ln((n + 1) / (df + 1)) + 1 AS idf FROM (SELECT term, count(*) AS df FROM d_tf "
                           "GROUP BY term) t, (SELECT count(*) AS n FROM documents) c WHERE df >= 10 AND df <= n * 0.3")
O.cte("d_w", ["d_tf", "d_vocab"], "SELECT doc_id, term, tf * idf AS w FROM d_tf JOIN d_vocab USING (term)")
O.cte("d_vec", ["d_w"], "SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM d_w")


def doc_notes(spark, sf_dir, stem=True):
    return TX.notes(documents(spark, sf_dir), "doc_id", "text", stem=stem)


@query("clean_notes", O.sql("SELECT doc_id, len(toks) AS n_tokens, array_to_string(lt, ' ') AS comment_clean "
                            "FROM d_long", "d_long"))
def q_clean_notes(spark, sf_dir):
    return doc_notes(spark, sf_dir).select("doc_id", F.size("tokens").alias("n_tokens"), "comment_clean")


@query("long_tokens", O.sql("SELECT doc_id, len(lt) AS n_long, len(list_distinct(lt)) AS n_distinct FROM d_long",
                            "d_long"))
def q_long_tokens(spark, sf_dir):
    return doc_notes(spark, sf_dir).select("doc_id", F.size("long_tokens").alias("n_long"),
                                           F.size(F.array_distinct("long_tokens")).alias("n_distinct"))


def doc_vectors(spark, sf_dir, stem=True):
    """Documents are hashed by id once: term frequencies and norms per document then need no further
    exchange, instead of one of all (document, term) rows."""
    notes = TX.notes(documents(spark, sf_dir).repartition("doc_id"), "doc_id", "text", stem=stem)
    return TX.tfidf(notes, "doc_id", "long_tokens", min_df=10, max_df=0.3)


@query("tfidf", O.sql("SELECT doc_id, term, round(weight, 6) AS weight FROM d_vec", "d_vec"))
def q_tfidf(spark, sf_dir):
    return doc_vectors(spark, sf_dir).withColumn("weight", F.round("weight", 6))


@query("stem_notes", O.sql("SELECT doc_id, array_to_string(lt, ' ') AS comment_clean FROM d_long", "d_long"))
def q_stem(spark, sf_dir):
    return doc_notes(spark, sf_dir, stem=True).select("doc_id", "comment_clean")


K_CLUSTERS = 15


O.cte("c_init", ["d_vec"], f"SELECT doc_id, cluster FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('{SEED}:' || "
                           f"CAST(doc_id AS VARCHAR))) - 1 AS cluster FROM (SELECT DISTINCT doc_id FROM d_vec) u) r "
                           f"WHERE cluster < {K_CLUSTERS}")
O.cte("c_vec", ["c_init"], "SELECT c.cluster, v.term, v.weight FROM c_init c JOIN d_vec v USING (doc_id)")
O.cte("c_norm", ["c_vec"], "SELECT cluster, sum(weight * weight) AS cn FROM c_vec GROUP BY cluster")
O.cte("c_dot", ["c_vec"], "SELECT v.doc_id, c.cluster, sum(v.weight * c.weight) AS dot FROM d_vec v "
                          "JOIN c_vec c USING (term) GROUP BY ALL")


@query("cluster_assign", O.sql(
    f"""SELECT doc_id, cluster FROM (
  SELECT d.doc_id, n.cluster, row_number() OVER (PARTITION BY d.doc_id ORDER BY
         round(n.cn - 2 * coalesce(x.dot, 0), 9), n.cluster) AS rk
  FROM documents d CROSS JOIN c_norm n LEFT JOIN c_dot x ON x.doc_id = d.doc_id AND x.cluster = n.cluster) s
WHERE rk = 1""", "c_norm", "c_dot"))
def q_cluster_assign(spark, sf_dir):
    vec = stage(doc_vectors(spark, sf_dir))  # read by three branches: centres, dot products, fallback
    centres = stage(TX.initial_centres(vec, "doc_id", K_CLUSTERS, SEED))
    return TX.assign(vec, documents(spark, sf_dir), centres, "doc_id")


@query("cluster_notes")
def q_cluster_notes(spark, sf_dir):
    vec = doc_vectors(spark, sf_dir)
    return TX.cluster_notes(vec, documents(spark, sf_dir), "doc_id", k=K_CLUSTERS, max_iter=100, seed=SEED)


# ---------------------------------------------------------------- step 8: models

from casebook.operators import boosting as BO  # noqa: E402
from casebook.operators import models as MD  # noqa: E402
from casebook.operators import neighbours as NN  # noqa: E402

def embedding_set(spark, sf_dir, folds: int = N_FOLDS):
    """Embeddings with a rare binary class (label 0), ML features and seeded stratified folds, staged
    once: every fit reads it again."""
    apply_plan_settings(spark)
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    e = e.select("vec_id", "embedding", (F.col("label") == 0).cast("int").alias("label"))
    e = SP.add_folds(e, "vec_id", folds, SEED, stratify="label").drop("repeat")
    return MD.with_features(stage(e), "embedding")


def embedding_width(df) -> int:
    return len(df.select("embedding").first()[0])


_TFPN = ("SELECT count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 0) AS tn, "
         "count_if(label = 0 AND prediction = 1) AS fp, count_if(label = 1 AND prediction = 0) AS fn FROM ")


@query("gaussian_nb", O.sql("SELECT vec_id, fold, label, prediction FROM emb_nb", "emb_nb"))
def q_gnb(spark, sf_dir):
    """M6 + M10: out-of-fold naive Bayes."""
    df = embedding_set(spark, sf_dir)
    return MD.nb_out_of_fold(df, "vec_id", "embedding").select("vec_id", "fold", "label", "prediction")


def _pairs(t: str, s: str, where: str) -> str:
    return (f"SELECT t.vec_id, t.y AS label, t.fold, s.vec_id AS other, s.y, row_number() OVER (PARTITION BY t.vec_id ORDER BY "
            f"round(list_sum(list_transform(list_zip(t.x, s.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6), s.vec_id) AS rk "
            f"FROM {t} t JOIN {s} s ON {where}")


@query("knn_classify", O.sql(
    "SELECT vec_id, fold, label, CAST(avg(y) > 0.5 AS INTEGER) AS prediction, round(avg(y), 6) AS score FROM ("
    + _pairs("emb_folds", "emb_folds", "t.fold <> s.fold") + ") p WHERE rk <= 3 GROUP BY ALL", "emb_folds"))
def q_knn(spark, sf_dir):
    """M3: three nearest neighbours, out of fold."""
    df = embedding_set(spark, sf_dir)
    out = NN.knn_classify(df, df, "vec_id", "embedding", k=3, fold="fold")
    return out.select("vec_id", "fold", "label", "prediction", F.round("score", 6).alias("score"))


@query("enn", O.sql(
    "SELECT vec_id, label FROM (" + _pairs("emb_folds", "emb_folds", "t.vec_id <> s.vec_id")
    + ") p WHERE rk <= 3 GROUP BY vec_id, label HAVING bool_and(y = label)", "emb_folds"))
def q_enn(spark, sf_dir):
    """Edited nearest neighbours."""
    return NN.edited(embedding_set(spark, sf_dir), "vec_id", "embedding").select("vec_id", "label")


def _hex(name: str) -> str:
    return f"('0x' || substr(md5('{SEED}:{name}:' || CAST(draw AS VARCHAR)), 1, 12))::BIGINT"


O.cte("sm_base", ["emb_folds"], "SELECT vec_id, x, fold, y, row_number() OVER (ORDER BY md5('" + str(SEED) + ":' || CAST(vec_id AS VARCHAR))) AS idx "
                                "FROM emb_folds WHERE y = 1")
O.cte("sm_near", ["sm_base"], "SELECT vec_id, other, rk, count(*) OVER (PARTITION BY vec_id) AS n FROM (SELECT * FROM ("
      + _pairs("sm_base", "sm_base", "t.vec_id <> s.vec_id") + ") p WHERE rk <= 5) q")
O.cte("sm_draws", ["emb_folds"], f"SELECT draw, {_hex('base')} % low + 1 AS idx, {_hex('near')} AS pick, round(({_hex('step')} % 1000000) / 1000000, 6) AS u "
      "FROM (SELECT low, unnest(range(0, high - low)) AS draw FROM (SELECT count_if(y = 1)::BIGINT AS low, count_if(y = 0)::BIGINT AS high FROM emb_folds) c) d")
O.cte("sm_rows", ["sm_base", "sm_near", "sm_draws"],
      "SELECT draw, b.vec_id AS base_id, o.vec_id AS neighbour_id, u, list_transform(list_zip(b.x, o.x), lambda p: p[1] + u * (p[2] - p[1])) AS x "
      "FROM sm_draws d JOIN sm_base b USING (idx) JOIN sm_near n ON n.vec_id = b.vec_id AND n.rk = d.pick % n.n + 1 JOIN sm_base o ON o.vec_id = n.other")
O.cte("sm_all", ["emb_folds", "sm_rows"], "SELECT vec_id, x, y, fold FROM emb_folds UNION ALL SELECT -1 - draw, x, 1, -1 FROM sm_rows")


@query("smote", O.sql("SELECT draw, base_id, neighbour_id, u, x FROM sm_rows", "sm_rows"))
def q_smote(spark, sf_dir):
    """The synthetic rows of SMOTE."""
    return NN.smote_rows(embedding_set(spark, sf_dir), "vec_id", "embedding", seed=SEED)


@query("smote_enn", O.sql(
    "SELECT vec_id, label FROM (" + _pairs("sm_all", "sm_all", "t.vec_id <> s.vec_id")
    + ") p WHERE rk <= 3 GROUP BY vec_id, label HAVING bool_and(y = label)", "sm_all"))
def q_smote_enn(spark, sf_dir):
    return NN.smote_enn(embedding_set(spark, sf_dir), "vec_id", "embedding", seed=SEED).select("vec_id", "label")


def _oof(name):
    def fn(spark, sf_dir):
        df = embedding_set(spark, sf_dir)
        pred = MD.line_up(df, "vec_id", "embedding", embedding_width(df), [name], SEED)
        return pred.select(F.col("id").cast("long").alias("vec_id"), "fold", "label", "prediction")
    return fn


for _name in ["logreg", "tree", "forest", "mlp", "adaboost", "svc", "svm", "gbt", "xgb"]:
    query(_name)(_oof(_name))


@query("cross_validate")
def q_cross_validate(spark, sf_dir):
    """M9 + M15: logistic regression, training folds over-sampled (resampling inside training only)."""
    df = embedding_set(spark, sf_dir)
    over = lambda d: SP.resample(d, "label", "vec_id", "over", SEED)
    make = MD.classifiers(embedding_width(df), df.count(), SEED)["logreg"]
    return MD.cross_validate(stage(MD.scored(MD.out_of_fold(make, df, resample=over), "logreg+oversample", "vec_id")))


@query("out_of_fold")
def q_out_of_fold(spark, sf_dir):
    df = embedding_set(spark, sf_dir)
    make = MD.classifiers(embedding_width(df), df.count(), SEED)["forest"]
    return MD.probability_of_one(MD.out_of_fold(make, df)).select("vec_id", "fold", "label", "prediction", "score")


GRID_RATES, GRID_ROUNDS = (0.001, 0.01, 0.1, 0.2), (200, 500, 1000, 2000)


@query("grid_search")
def q_grid(spark, sf_dir):
    """4 rates x 4 numbers of estimators, 10 folds; one boosting run per rate and fold."""
    pred = BO.boosted_folds(embedding_set(spark, sf_dir), "vec_id", "embedding", rates=GRID_RATES, rounds=GRID_ROUNDS, seed=SEED)
    return MD.grid_search(stage(pred), ["rate", "rounds"])


@query("grid_search_resampled")
def q_grid_resampled(spark, sf_dir):
    """M14 + M15: the grid over SMOTEENN → AdaBoost, scored by recall of the rare class; each fold's training rows are
    resampled once, in one plan, for all rates and rounds."""
    df = embedding_set(spark, sf_dir)
    train = stage(NN.smote_enn_folds(df, "vec_id", "embedding", seed=SEED))
    pred = BO.boosted_folds(df, "vec_id", "embedding", rates=GRID_RATES, rounds=GRID_ROUNDS, seed=SEED, train=train)
    return MD.grid_search(stage(pred), ["rate", "rounds"], metric="recall")


E75_MODELS = ["knn", "logreg", "tree", "forest", "mlp", "adaboost", "nb"]
E78_MODELS = ["logreg", "forest", "knn", "svm", "nb", "xgb"]


@query("bake_off")
def q_bake_off(spark, sf_dir):
    """Every model of both line-ups, cross-validated on the same ten folds."""
    df = embedding_set(spark, sf_dir)
    names = list(dict.fromkeys(E75_MODELS + E78_MODELS))
    return MD.cross_validate(MD.line_up(df, "vec_id", "embedding", embedding_width(df), names, SEED))


@query("feature_importance")
def q_importance(spark, sf_dir):
    df = embedding_set(spark, sf_dir).withColumn("label", F.col("label").cast("double"))
    n = embedding_width(df)
    model = MD.classifiers(n, df.count(), SEED)["forest"]().fit(df)
    return MD.feature_scores(model, [f"e{i}" for i in range(n)], spark)


# ---------------------------------------------------------------- models on the two datasets


def as_model_set(df, label: str, features: list[str], folds: int):
    """(PATIENT_HASH, label, x, features, fold), staged."""
    rows = df.select(PATIENT, F.col(label).cast("int").alias("label"), F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    return MD.with_features(stage(SP.add_folds(rows, PATIENT, folds, SEED, stratify="label").drop("repeat")), "x")


O.cte("e75_data", ["e75_base", "e75_age", "e75_onehot", "e75_como", "e75_symp"],
      "SELECT PATIENT_HASH, gaucher AS y, [" + ", ".join(f"CAST(coalesce(\"{c}\", 0) AS DOUBLE)" for c in DS.E75_FEATURES) + "] AS x "
      "FROM e75_base LEFT JOIN e75_age USING (PATIENT_HASH) LEFT JOIN e75_onehot USING (PATIENT_HASH) "
      "LEFT JOIN e75_como USING (PATIENT_HASH) LEFT JOIN e75_symp USING (PATIENT_HASH)")
O.cte("e75_folds", ["e75_data"], f"SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY md5('{SEED}:' || PATIENT_HASH)) - 1) "
                                 f"% {N_FOLDS} AS INTEGER) AS fold FROM e75_data")
nb_ctes("e75", "e75_folds", "PATIENT_HASH")
O.cte("e75_tfpn", ["e75_nb"], _TFPN + "e75_nb")


def e75_set(spark, sf_dir):
    return as_model_set(dataset_e75(spark, sf_dir), "gaucher", DS.E75_FEATURES, N_FOLDS)


@query("model_e75_nb", O.sql(
    "SELECT tp, tn, fp, fn, round(fn / (tp + fn), 2) * 100 AS pos_misclassified_pct, round(fp / (tn + fp), 2) * 100 AS neg_misclassified_pct "
    "FROM e75_tfpn", "e75_tfpn"))
def q_model_e75_nb(spark, sf_dir):
    """Naive Bayes on the Gaucher dataset, out of ten folds: confusion counts and misclassification."""
    return MT.misclassification(stage(MD.nb_out_of_fold(e75_set(spark, sf_dir), PATIENT, "x")))


@query("model_e75")
def q_model_e75(spark, sf_dir):
    """The seven classifiers of the E75 line-up on the Gaucher dataset, ten folds: metrics per fold."""
    return MD.cross_validate(MD.line_up(e75_set(spark, sf_dir), PATIENT, "x", len(DS.E75_FEATURES), E75_MODELS, SEED, k=3))


@query("model_e75_resampled")
def q_model_e75_resampled(spark, sf_dir):
    """M15 on the Gaucher dataset: SMOTEENN → AdaBoost (200 rounds, rate 0.001), out of ten folds: confusion counts and
    misclassification."""
    data = e75_set(spark, sf_dir)
    train = stage(NN.smote_enn_folds(data, PATIENT, "x", seed=SEED))
    pred = BO.boosted_folds(data, PATIENT, "x", rates=(0.001,), rounds=(200,), seed=SEED, train=train)
    return MT.misclassification(stage(pred))


E78_DROP = 1000


@query("model_e78")
def q_model_e78(spark, sf_dir):
    """E78 end to end: dataset → drop 1000 random negatives → 75/25 split → the six classifiers of its
    line-up fitted on the train part → report on the test part."""
    data = dataset_e78(spark, sf_dir).withColumn("Status", F.least(F.col("Status"), F.lit(1)))
    kept = SP.undersample(data, E78_DROP, SEED, PATIENT, "Status")
    split = SP.train_test(kept, PATIENT, 0.25, SEED)
    rows = split.select(PATIENT, F.col("Status").cast("int").alias("label"), F.array(*[F.col(c).cast("double") for c in DS.E78_FEATURES]).alias("x"),
                        (F.col("split") == "test").cast("int").alias("fold"))
    pred = MD.line_up(MD.with_features(stage(rows), "x"), PATIENT, "x", len(DS.E78_FEATURES), E78_MODELS, SEED, k=5, only_fold=1)
    outs = [MT.report(pred.filter(F.col("model") == m)).withColumn("model", F.lit(m)) for m in E78_MODELS]
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


@query("prevalence_certain", O.sql(
    "SELECT ZENTRUM_ID, sum(hit) AS cases, count(*) AS patients, round_even(sum(hit) / count(*), 5) * 100 AS prevalence_pct FROM (SELECT ZENTRUM_ID, "
    "PATIENT_HASH, max(CASE WHEN SICHERHEIT = 'G' AND ICD10 = 'E75.22' THEN 1 ELSE 0 END) AS hit FROM pre GROUP BY ALL) p GROUP BY ZENTRUM_ID", "pre"))
def q_prevalence_certain(spark, sf_dir):
    """Certain cases of E75.22 per site."""
    return FL.prevalence(pre(spark, sf_dir))


# ---------------------------------------------------------------- M18: control-size sweep

SWEEP_K = [32, 64, 96, 128, 160, 1880]
#: Control draw counts whose line-ups are fitted at a time.
SWEEPS_AT_A_TIME = 3


O.cte("certain_ids", ["pre_full"], "SELECT DISTINCT PATIENT_HASH FROM pre_full WHERE SICHERHEIT = 'G' AND ICD10 = 'E75.22'")
O.cte("unflagged", ["pre_full"], "SELECT * FROM pre_full WHERE is_E75_22 = 0")


@query("control_sweep", O.sql(" UNION ALL ".join(
    f"SELECT {k} AS k, count(*) AS n_patients, count_if(PATIENT_HASH IN (SELECT PATIENT_HASH FROM certain_ids)) "
    f"AS n_cases FROM (SELECT PATIENT_HASH FROM certain_ids UNION {O.bootstrap_sql('unflagged', 'certain_ids', k, SEED)}) s{k}"
    for k in SWEEP_K), "certain_ids", "unflagged"))
def q_sweep(spark, sf_dir):
    """Cohort sizes for each control draw count of the notebook's sweep: certain cases (J9) and
    controls drawn from the rows without the E75.22 flag (J4)."""
    p = pre_stage(spark, sf_dir, keep_flags=True)
    cases = stage(C.diagnosed_cases(p, "E75.22", source="certain"))
    marked = cases.withColumn("_c", F.lit(1))
    outs = []
    for k in SWEEP_K:
        ids = cases.unionByName(C.bootstrap_controls(p, cases, k=k, seed=SEED, flag="is_E75_22")).distinct()
        outs.append(ids.join(marked, PATIENT, "left").agg(
            F.lit(k).alias("k"), F.count(F.lit(1)).alias("n_patients"), F.count("_c").alias("n_cases")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


@query("sweep_models")
def q_sweep_models(spark, sf_dir):
    """M18's model step: naive Bayes out of ten folds on the dataset of each control draw count. The cohorts are
    nested, so the journal is preprocessed and the features are made once, for the largest."""
    outs = []
    for k, rows in sweep_sets(spark, sf_dir):
        pred = MD.nb_out_of_fold(rows, PATIENT, "x")
        outs.append(MT.misclassification(stage(pred)).withColumn("k", F.lit(k)))
    return IO.union_frames(outs)


def sweep_sets(spark, sf_dir):
    """(k, model rows) for every control draw count."""
    data = DS.gaucher_sweep(pre_stage(spark, sf_dir, keep_flags=True), SWEEP_K, SEED, source="certain", flag="is_E75_22")
    for k in SWEEP_K:
        drawn = data.filter(F.col("first_draw").isNull() | (F.col("first_draw") < k))
        yield k, as_model_set(drawn, "gaucher", DS.E75_FEATURES, N_FOLDS)


@query("sweep_line_up")
def q_sweep_line_up(spark, sf_dir):
    """The seven classifiers of the E75 line-up for every control draw count, ten folds, on the nested cohorts'
    one feature table: mean metrics over the folds."""
    def one(item):
        k, rows = item
        pred = MD.line_up(rows, PATIENT, "x", len(DS.E75_FEATURES), E75_MODELS, SEED, k=3)
        means = MD.cross_validate(pred).groupBy("model", "metric").agg(F.round(F.avg("value"), 6).alias("mean"))
        return stage(means.withColumn("k", F.lit(k)))

    return IO.union_frames(MD.side_by_side(spark, one, list(sweep_sets(spark, sf_dir)), SWEEPS_AT_A_TIME))


# ---------------------------------------------------------------- T4/T5 on patient notes

_PTOKS = _TOKS.replace("coalesce(text, '')", "coalesce(TEXT, '')")
O.cte("p_raw", ["pre"], f"SELECT row_number() OVER () AS r, PATIENT_HASH, entry_date, entry_id, {_PTOKS} AS raw "
                        "FROM pre WHERE TYP = 'A' AND TEXT IS NOT NULL")
O.stem_ctes("p", "p_raw", "raw")
O.cte("p_pos", ["p_raw"], "SELECT r, unnest(raw) AS word, unnest(range(0, len(raw))) AS pos FROM p_raw")
O.cte("p_rows", ["p_raw", "p_pos", "p_stem"],
      "SELECT PATIENT_HASH, entry_date, entry_id, coalesce(t.lt, CAST([] AS VARCHAR[])) AS lt FROM p_raw LEFT JOIN (SELECT r, "
      "list(stem ORDER BY pos) FILTER (WHERE length(stem) >= 9) AS lt FROM p_pos JOIN p_stem USING (word) GROUP BY r) t USING (r)")
O.cte("p_ne", ["p_rows"], "SELECT *, lag(lt[len(lt)]) OVER (PARTITION BY PATIENT_HASH ORDER BY entry_date NULLS LAST, "
                          "entry_id) AS prev FROM p_rows WHERE len(lt) > 0")
O.cte("p_terms", ["p_ne"], "SELECT PATIENT_HASH, unnest(list_concat(lt, list_transform(range(1, len(lt)), "
                           "lambda i: lt[i] || ' ' || lt[i + 1]), CASE WHEN prev IS NULL THEN CAST([] AS VARCHAR[]) "
                           "ELSE [prev || ' ' || lt[1]] END)) AS term FROM p_ne")
O.cte("p_tf", ["p_terms"], "SELECT PATIENT_HASH, term, count(*) AS tf FROM p_terms GROUP BY ALL")
O.cte("p_vocab", ["p_tf", "p_rows"],
      "SELECT term, ln((n + 1) / (df + 1)) + 1 AS idf FROM (SELECT term, count(*) AS df FROM p_tf GROUP BY term) t, "
      "(SELECT count(DISTINCT PATIENT_HASH) AS n FROM p_rows) c WHERE df >= 10 AND df <= n * 0.3")
O.cte("p_w", ["p_tf", "p_vocab"], "SELECT PATIENT_HASH, term, tf * idf AS w FROM p_tf JOIN p_vocab USING (term)")


def patient_vectors(rows):
    terms, n = TX.patient_terms(rows)
    return TX.weigh_terms(terms, PATIENT, n, min_df=10, max_df=0.3)


@query("patient_tfidf", O.sql("SELECT PATIENT_HASH, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY PATIENT_HASH)), 6) "
                              "AS weight FROM p_w", "p_w"))
def q_patient_tfidf(spark, sf_dir):
    """T1-T4 on the journal: one document per patient (anamnesis notes in entry order)."""
    return patient_vectors(pre(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


@query("patient_clusters")
def q_patient_clusters(spark, sf_dir):
    """T5 on the journal: k-means (k = 15) over the patients' note vectors; patients without a
    surviving term get the nearest (smallest-norm) centre."""
    return patient_clusters(pre(spark, sf_dir))


def patient_clusters(rows):
    notes = stage(rows.filter((F.col("TYP") == "A") & F.col("TEXT").isNotNull()).select(PATIENT, "TYP", "TEXT", "entry_date", "entry_id"))
    docs = notes.select(PATIENT).distinct()
    return TX.cluster_notes(patient_vectors(notes), docs, PATIENT, k=K_CLUSTERS, max_iter=100, seed=SEED)


@query("dataset_e78_clustered")
def q_dataset_e78_clustered(spark, sf_dir):
    """E4 with J13: the E78 dataset with each patient's note cluster (missing → 100), both from one preprocessed journal."""
    rows = pre_stage(spark, sf_dir, keep_flags=True)
    return DS.hyperchol_dataset(rows, patient_clusters(rows).withColumnRenamed("cluster", "clusters"))


@query("age_bands", O.sql(
    "SELECT ZENTRUM_ID, CAST(floor(a / 10) * 10 AS INTEGER) AS age_band, count(*) AS patients FROM "
    "(SELECT ZENTRUM_ID, PATIENT_HASH, avg(age) AS a FROM pre GROUP BY ALL) p GROUP BY ALL", "pre"))
def q_age_bands(spark, sf_dir):
    return IO.age_bands(pre(spark, sf_dir))
