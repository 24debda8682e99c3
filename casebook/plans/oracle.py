"""DuckDB oracle SQL: named CTEs with their dependencies, assembled per query.

The SQL restates each rule independently of the Spark code (set logic, CASE chains, window
ranks); both draw their literal rule values from ``casebook.functions.rules``.
"""

from __future__ import annotations

from casebook.functions import rules as R
from casebook.sources.fixtures import JOURNAL_ENTRY_SQL


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def has(col: str, term: str) -> str:
    return f"coalesce(strpos({col}, {q(term)}) > 0, false)"


def has_all(col: str, terms) -> str:
    return "(" + " AND ".join(has(col, t) for t in terms) + ")"


def has_any(col: str, terms) -> str:
    return "(" + " OR ".join(has(col, t) for t in terms) + ")"


def i(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def _flags_select(registry) -> str:
    parts = []
    for name, spec in registry.items():
        hits = [i(has_all(c, frags)) for c, frags in spec["terms"]]
        parts.append((f"greatest({', '.join(hits)})" if spec["any"] else " + ".join(hits)) + f" AS {name}")
    total = " + ".join(registry)
    return "SELECT *, " + ", ".join(parts) + f" FROM {{src}}", total


def flags_cte(src: str, registry) -> str:
    body, total = _flags_select(registry)
    return f"SELECT *, {total} AS is_disease FROM ({body.format(src=src)}) f0"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("journal", [], JOURNAL_ENTRY_SQL)
cte("flags", ["journal"], flags_cte("journal", R.DISEASES_MODULE))
cte("flags_nb", ["journal"], flags_cte("journal", R.DISEASES_NOTEBOOK))


def sql(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body


# ---- dates and age (D1-D6) on top of the module flags
cte("dates", ["flags"], """
SELECT *, CAST(try_strptime(substr(PAT_GEBDATUM, 1, 6) || birth_year, '%d.%m.%Y') AS DATE) AS birth_date
FROM (
  SELECT *, CASE WHEN by2 > '20' THEN '19' WHEN entry_year < '2000' THEN '19'
                 WHEN CAST(substr(entry_year, 3, 2) AS INTEGER) - CAST(by2 AS INTEGER) < 0 THEN '19'
                 ELSE '20' END || by2 AS birth_year,
    CAST(try_strptime(substr(DATUM, 1, 6) || entry_year, '%d.%m.%Y') AS DATE) AS entry_date
  FROM (
    SELECT *, CASE WHEN yy < '21' THEN '20' ELSE '19' END || yy AS entry_year, substr(PAT_GEBDATUM, 7) AS by2
    FROM (SELECT *, CASE substr(DATUM, 7) WHEN '50' THEN '05' WHEN '90' THEN '09' ELSE substr(DATUM, 7) END AS yy
          FROM flags) a
  ) b
) c
""")
cte("aged", ["dates"],
    "SELECT * EXCLUDE (yy, entry_year, by2, birth_year), "
    "round(datediff('day', birth_date, entry_date) / 365.2425, 1) + 0.0 AS age FROM dates")

_DIAG = "TYP IN ('*', 'D')"
cte("icd", ["aged"], f"""
SELECT * REPLACE (
  CASE WHEN ICD10 LIKE '%-' THEN substr(ICD10, 1, length(ICD10) - 1)
       WHEN {_DIAG} AND ICD10 IS NULL THEN
         CASE WHEN is_E75_22 > 0 THEN 'E75.22' WHEN is_E78_01 > 0 THEN 'E78.01'
              WHEN is_E78_3 > 0 THEN 'E78.3' WHEN is_E71_3 > 0 THEN 'E71.3'
              ELSE nullif(regexp_extract(coalesce(TEXT, ''), '([A-Za-z][0-9]{{2}}\\.[0-9]+)[A-Za-z]', 1), '') END
       WHEN {_DIAG} AND ICD10 = 'E75.2' AND is_E75_22 > 0 THEN 'E75.22'
       ELSE ICD10 END AS ICD10)
FROM aged
""")
cte("cert", ["icd"], f"""
SELECT * REPLACE (
  CASE WHEN {_DIAG} AND {has('TEXT', 'usschlu')} THEN 'A'
       WHEN {_DIAG} AND {has('TEXT', 'V.a.')} THEN 'V'
       WHEN {_DIAG} AND {has('TEXT', 'Z.a.')} THEN 'Z'
       WHEN {_DIAG} AND ICD10 IS NOT NULL AND SICHERHEIT IS NULL THEN 'G'
       WHEN SICHERHEIT IS NULL AND coalesce(strpos(TEXT, ICD10 || 'G') > 0, false) THEN 'G'
       WHEN SICHERHEIT IS NULL AND coalesce(strpos(TEXT, ICD10 || 'A') > 0, false) THEN 'A'
       WHEN SICHERHEIT IS NULL AND coalesce(strpos(TEXT, ICD10 || 'V') > 0, false) THEN 'V'
       WHEN SICHERHEIT IS NULL AND coalesce(strpos(TEXT, ICD10 || 'Z') > 0, false) THEN 'Z'
       ELSE SICHERHEIT END AS SICHERHEIT)
FROM icd
""")
cte("dedup", ["cert"], """
SELECT * FROM cert WHERE TYP IN ('A', 'Y')
UNION ALL
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY PATIENT_HASH, ZENTRUM_ID, TYP, ICD10, SICHERHEIT
                               ORDER BY entry_date NULLS LAST, entry_id) AS rn
  FROM cert WHERE TYP IN ('*', 'D')) d WHERE rn = 1
""")
cte("kept", ["dedup"],
    "SELECT * FROM dedup WHERE NOT (" + has("TEXT", "AL:") + " OR " + has("TEXT", "|END") + ")")


def _label_sql(src: str) -> str:
    aggs, labels = [], []
    for c in R.LABEL_CODES:
        k = c.replace(".", "_")
        aggs.append(f"bool_or(ICD10 = '{c}' AND SICHERHEIT = 'A') AS x_{k}, "
                    f"bool_or(ICD10 = '{c}' AND TYP = '*' AND SICHERHEIT IN ('G', 'Z')) AS c_{k}, "
                    f"bool_or(ICD10 = '{c}') AS s_{k}")
        labels.append(f"CASE WHEN x_{k} THEN 'excluded' WHEN c_{k} THEN 'confirmed' "
                      f"WHEN s_{k} THEN 'suspicious' END AS diagnosis_{k}")
    return (f"SELECT t.*, {', '.join(labels)} FROM {src} t LEFT JOIN "
            f"(SELECT PATIENT_HASH, {', '.join(aggs)} FROM {src} GROUP BY PATIENT_HASH) l USING (PATIENT_HASH)")


PRE_WORK = "PAT_GEBDATUM, TYP_EXT, is_E75_22, is_E78_01, is_E78_3, is_E71_3, is_disease, birth_date"
cte("pre_full", ["kept"], _label_sql("kept"))
cte("pre", ["pre_full"], f"SELECT * EXCLUDE ({PRE_WORK}) FROM pre_full")


# ---- labs
def inference_sql(result: str) -> str:
    h = f"split_part({result}, '(', 1)"
    chain = " ".join(
        f"WHEN strpos({'lower(' + h + ')' if blind else h}, {q(frag)}) > 0 THEN {q(label)}"
        for frag, label, blind in R.INFERENCE_RULES)
    return f"CASE WHEN {result} IS NULL THEN NULL ELSE CASE {chain} ELSE {q(R.INFERENCE_DEFAULT)} END END"


def pieces_sql(src: str) -> str:
    return (f"SELECT *, regexp_replace(piece, '^\\s+', '') AS test_text FROM ("
            f"SELECT *, unnest(string_split(TEXT, ';')) AS piece, "
            f"unnest(range(0, len(string_split(TEXT, ';')))) AS pos FROM {src}) p0")


def eq_sql(src: str) -> str:
    return (f"SELECT * EXCLUDE (piece), split_part(test_text, '=', 1) AS Lab_test, "
            f"substr(test_text, strpos(test_text, '=') + 1) AS Result, 'eq' AS fmt FROM ({pieces_sql(src)}) p1 "
            f"WHERE regexp_matches(test_text, '[a-zA-Z0-9\\s]+=[a-zA-Z0-9\\s]+')")


def range_sql(src: str) -> str:
    return (f"SELECT * EXCLUDE (piece, ws), substr(test_text, 1, ws - 1) AS Lab_test, substr(test_text, ws + 1) "
            f"AS Result, 'range' AS fmt FROM (SELECT *, strpos(regexp_replace(test_text, '\\s', chr(1)), chr(1)) AS ws "
            f"FROM ({pieces_sql(src)}) p1 WHERE regexp_matches(test_text, '\\([.0-9\\s]+-[.0-9\\s]+\\)')) p2 WHERE ws > 0")


def with_inference(src: str) -> str:
    return f"SELECT *, {inference_sql('Result')} AS Inference FROM ({src}) li"


cte("labsrc", ["journal"], "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entry_id) AS rn "
                           "FROM journal WHERE TYP = 'Y' AND TEXT IS NOT NULL) d WHERE rn = 1")
cte("labs_eq", ["labsrc"], with_inference(eq_sql("labsrc")))
cte("labsrc_all", ["journal"], "SELECT * FROM journal WHERE TYP = 'Y' AND TEXT IS NOT NULL")
cte("labs_both", ["labsrc_all"], with_inference(eq_sql("labsrc_all") + " UNION ALL " + range_sql("labsrc_all")))
cte("labs_common", ["labs_eq"], "SELECT * FROM labs_eq WHERE Lab_test IN "
                                "(SELECT Lab_test FROM labs_eq GROUP BY Lab_test HAVING count(*) >= 2)")
MAP_KEYS_SQL = "PATIENT_HASH, ZENTRUM_ID, PATIENT_ID, PAT_GESCHLECHT, DATUM, TYP, TEXT"
cte("labs_last", ["labs_common"], f"""
SELECT {MAP_KEYS_SQL}, Lab_test, arg_max(Inference, entry_id || ':' || lpad(CAST(pos AS VARCHAR), 10, '0')) AS Inference,
       arg_max(Result, entry_id || ':' || lpad(CAST(pos AS VARCHAR), 10, '0')) AS Result
FROM labs_common WHERE PATIENT_HASH IS NOT NULL AND ZENTRUM_ID IS NOT NULL AND PATIENT_ID IS NOT NULL
  AND PAT_GESCHLECHT IS NOT NULL AND DATUM IS NOT NULL AND TYP IS NOT NULL AND TEXT IS NOT NULL
GROUP BY ALL
""")
cte("labs_wide", ["labs_last"],
    "SELECT PATIENT_HASH, ZENTRUM_ID, DATUM, TYP, TEXT, "
    + ", ".join(f"max(CASE WHEN Lab_test = {q(t)} THEN Inference END) AS {t}" for t in R.E75_TESTS)
    + f" FROM labs_last GROUP BY {MAP_KEYS_SQL}")
cte("labs_joined", ["labs_wide"], "SELECT j.*, " + ", ".join(f"w.{t}" for t in R.E75_TESTS)
    + " FROM journal j LEFT JOIN labs_wide w USING (PATIENT_HASH, ZENTRUM_ID, DATUM, TYP, TEXT)")


def majority_sql(src: str, tests) -> str:
    cols = []
    for t in tests:
        cnts = [f"count_if({t} = {q(c)})" for c in R.MAJORITY_CATEGORIES]
        # first maximum in category order
        best = "CASE " + " ".join(
            f"WHEN {cnts[i]} >= greatest({', '.join(cnts)}) THEN {q(c)}" for i, c in enumerate(R.MAJORITY_CATEGORIES)
        ) + " END"
        cols.append(f"CASE WHEN count({t}) = 0 THEN {q(R.NO_TEST)} ELSE {best} END AS {t}")
    return f"SELECT PATIENT_HASH, {', '.join(cols)} FROM {src} WHERE TYP = 'Y' GROUP BY PATIENT_HASH"


def lab_chain(prefix: str, src: str, dep: str, tests) -> None:
    """Register the interpret-tests chain over ``src``: {prefix}_src, _eq, _common, _last, _wide, _joined."""
    cte(f"{prefix}_src", [dep], "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entry_id) "
                                f"AS rn FROM {src} WHERE TYP = 'Y' AND TEXT IS NOT NULL) d WHERE rn = 1")
    cte(f"{prefix}_eq", [f"{prefix}_src"], with_inference(eq_sql(f"{prefix}_src")))
    cte(f"{prefix}_common", [f"{prefix}_eq"], f"SELECT * FROM {prefix}_eq WHERE Lab_test IN "
                                              f"(SELECT Lab_test FROM {prefix}_eq GROUP BY Lab_test HAVING count(*) >= 2)")
    order = "entry_id || ':' || lpad(CAST(pos AS VARCHAR), 10, '0')"
    cte(f"{prefix}_last", [f"{prefix}_common"],
        f"SELECT {MAP_KEYS_SQL}, Lab_test, arg_max(Inference, {order}) AS Inference FROM {prefix}_common "
        "WHERE " + " AND ".join(f"{k.strip()} IS NOT NULL" for k in MAP_KEYS_SQL.split(",")) + " GROUP BY ALL")
    cte(f"{prefix}_wide", [f"{prefix}_last"],
        "SELECT PATIENT_HASH, ZENTRUM_ID, DATUM, TYP, TEXT, "
        + ", ".join(f"max(CASE WHEN Lab_test = {q(t)} THEN Inference END) AS {t}" for t in tests)
        + f" FROM {prefix}_last GROUP BY {MAP_KEYS_SQL}")
    cte(f"{prefix}_joined", [f"{prefix}_wide", dep], "SELECT j.*, " + ", ".join(f"w.{t}" for t in tests)
        + f" FROM {src} j LEFT JOIN {prefix}_wide w USING (PATIENT_HASH, ZENTRUM_ID, DATUM, TYP, TEXT)")


def one_hot_sql(src: str, tests, categories) -> str:
    cols = [f"CASE WHEN {t} = {q(c)} THEN 1 ELSE 0 END AS {t}_{c.replace(' ', '_')}" for t in tests for c in categories]
    return f"SELECT PATIENT_HASH, {', '.join(cols)} FROM {src}"


def impute_sql(src: str) -> str:
    chain = " ".join(f"WHEN {has_all('TEXT', frags)} THEN '{code}'" for frags, code in R.COMORBIDITY_RULES)
    return (f"SELECT * REPLACE (CASE WHEN TYP IN ('*', 'D') AND ICD10 IS NULL THEN CASE {chain} ELSE ICD10 END "
            f"ELSE ICD10 END AS ICD10) FROM {src}")


def comorbidity_sql(src: str) -> str:
    cols = ", ".join(f"max(CASE WHEN ICD10 = {q(c)} THEN 1 ELSE 0 END) AS {c.replace('.', '_')}"
                     for c in R.COMORBIDITY_CODES)
    return f"SELECT PATIENT_HASH, {cols} FROM {src} GROUP BY PATIENT_HASH"


def symptoms_sql(src: str) -> str:
    cols = ", ".join(f"count_if({has_any('TEXT', g)} AND PATIENT_ID IS NOT NULL) AS \"{g[0]}\""
                     for g in R.SYMPTOM_GROUPS)
    return f"SELECT PATIENT_HASH, {cols} FROM {src} GROUP BY PATIENT_HASH"


def bootstrap_sql(src: str, cases: str, k: int, seed: int) -> str:
    pool = f"SELECT DISTINCT PATIENT_HASH FROM {src} WHERE PATIENT_HASH NOT IN (SELECT PATIENT_HASH FROM {cases})"
    return (f"SELECT PATIENT_HASH FROM (SELECT PATIENT_HASH, row_number() OVER (ORDER BY md5(PATIENT_HASH)) AS idx "
            f"FROM ({pool}) p) ix WHERE idx IN (SELECT (CAST('0x' || substr(md5('{seed}:' || CAST(range AS VARCHAR)), "
            f"1, 12) AS BIGINT) % (SELECT count(*) FROM ({pool}) c)) + 1 FROM range({k}))")


def stem_ctes(prefix: str, src: str, tokens: str) -> None:
    """``{prefix}_stem(word, stem)``: Snowball German over the distinct words of a token-list column, one
    CTE a step (w: marked word, r1, r2: where the regions begin, from 0)."""
    v = "[aeiouyäöü]"
    c = "[^aeiouyäöü]"

    def region(w: str) -> str:
        m = f"regexp_extract({w}, '^.*?{v}{c}')"
        return f"CASE WHEN {m} = '' THEN length({w}) ELSE length({m}) END"

    def ends(w: str, suf: str, r: str) -> str:
        return f"({w} LIKE '%{suf}' AND length({w}) - {len(suf)} >= {r})"

    def chop(w: str, k: int) -> str:
        return f"substr({w}, 1, length({w}) - {k})"

    def no_e(w: str, k: int) -> str:
        return f"NOT (length({w}) - {k} - 1 >= r2 AND substr({w}, length({w}) - {k}, 1) = 'e')"

    cte(f"{prefix}_words", [src], f"SELECT DISTINCT unnest({tokens}) AS word FROM {src}")
    # RE2 has no lookahead: the vowel after u or y is put back, twice for neighbours that share it.
    w = "replace(word, 'ß', 'ss')"
    for letter in "uy":
        for _ in range(2):
            w = f"regexp_replace({w}, '({v}){letter}({v})', '\\1{letter.upper()}\\2', 'g')"
    cte(f"{prefix}_w0", [f"{prefix}_words"], f"SELECT word, w, {region('w')} AS r FROM (SELECT word, {w} AS w FROM {prefix}_words) x")
    cte(f"{prefix}_w1", [f"{prefix}_w0"], f"SELECT word, w, greatest(r, 3) AS r1, r + {region('substr(w, r + 1)')} AS r2 FROM {prefix}_w0")
    one = " ".join([*(f"WHEN {ends('w', s, 'r1')} THEN {chop('w', len(s))}" for s in ("ern", "em", "er")),
                    *(f"WHEN {ends('w', s, 'r1')} THEN CASE WHEN w LIKE '%niss{s}' THEN {chop('w', len(s) + 1)} ELSE {chop('w', len(s))} END"
                      for s in ("en", "es", "e")),
                    f"WHEN {ends('w', 's', 'r1')} AND regexp_matches(w, '[bdfghklmnrt]s$') THEN {chop('w', 1)}"])
    cte(f"{prefix}_w2", [f"{prefix}_w1"], f"SELECT word, r1, r2, CASE {one} ELSE w END AS w FROM {prefix}_w1")
    two = " ".join([*(f"WHEN {ends('w', s, 'r1')} THEN {chop('w', len(s))}" for s in ("est", "en", "er")),
                    f"WHEN {ends('w', 'st', 'r1')} AND regexp_matches(w, '[bdfghklmnt]st$') AND length(w) >= 6 THEN {chop('w', 2)}"])
    cte(f"{prefix}_w3", [f"{prefix}_w2"], f"SELECT word, r1, r2, CASE {two} ELSE w END AS w FROM {prefix}_w2")
    three = [f"WHEN {ends('w', 'isch', 'r2')} THEN CASE WHEN {no_e('w', 4)} THEN {chop('w', 4)} ELSE w END"]
    three += [f"WHEN {ends('w', s, 'r2')} THEN CASE WHEN {ends('w', 'er' + s, 'r1')} OR {ends('w', 'en' + s, 'r1')} THEN {chop('w', 6)} "
              f"ELSE {chop('w', 4)} END" for s in ("lich", "heit")]
    three += [f"WHEN {ends('w', 'keit', 'r2')} THEN CASE WHEN {ends('w', 'lichkeit', 'r2')} THEN {chop('w', 8)} "
              f"WHEN {ends('w', 'igkeit', 'r2')} THEN {chop('w', 6)} ELSE {chop('w', 4)} END"]
    three += [f"WHEN {ends('w', s, 'r2')} THEN CASE WHEN {ends('w', 'ig' + s, 'r2')} AND {no_e('w', 5)} THEN {chop('w', 5)} "
              f"ELSE {chop('w', 3)} END" for s in ("end", "ung")]
    three += [f"WHEN {ends('w', s, 'r2')} THEN CASE WHEN {no_e('w', 2)} THEN {chop('w', 2)} ELSE w END" for s in ("ig", "ik")]
    cte(f"{prefix}_stem", [f"{prefix}_w3"], f"SELECT word, translate(CASE {' '.join(three)} ELSE w END, 'äöüUY', 'aouuy') AS stem FROM {prefix}_w3")
