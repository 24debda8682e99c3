"""Journal view over the driver's tables.

The driver ships no clinical journal, so both Spark and the DuckDB oracle project one from
``lineitem ⋈ orders ⋈ customer`` (one journal row per line item). The mapping (FIXTURES.md §3) is
deterministic in the keys, so both engines produce identical rows. Spark side: DataFrame API,
lazy, so the downstream filters and projections of each query still reach the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.schema import ENTRY_ID, RAW_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _case(key: Column, values: list[str | Column], default=None) -> Column:
    """Pick ``values[key]`` (key = 0, 1, ...), else ``default``. Literal lists become one constant
    array lookup, which keeps the generated code small enough for whole-stage codegen."""
    if all(isinstance(v, str) for v in values):
        picked = F.element_at(F.array(*[F.lit(v) for v in values]), (key + 1).cast("int"))
        if default is None:
            return picked
        return F.when(key < len(values), picked).otherwise(default)
    out = None
    for i, v in enumerate(values):
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(key == i, v) if out is None else out.when(key == i, v)
    return out.otherwise(default) if default is not None else out


def journal_view(spark: SparkSession, sf_dir: str, with_entry_id: bool = True) -> DataFrame:
    # Hash by the join key: the exchange that the join with orders needs at scale. Where orders is
    # small enough for AQE to broadcast, it still deals a file of few row groups to all cores.
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate").repartition("l_orderkey")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(cu, F.col("o_custkey") == cu.c_custkey)
    # Helper columns first: each is used many times below, so Catalyst keeps this projection
    # separate and the generated code computes them once.
    j = j.select(
        F.col("c_custkey").alias("pid"), F.col("c_nationkey").alias("nk"), F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"),
        F.floor("l_quantity").cast("bigint").cast("string").alias("q"),
        F.col("l_shipdate").cast("date").alias("d"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_partkey")) % 8).alias("t"),
        ((F.col("l_partkey") + F.col("l_suppkey")) % 16).alias("v"),
    )
    pid, nk, ok, ln, pk, sk, q, d, t, v = (F.col(c) for c in ["pid", "nk", "ok", "ln", "pk", "sk", "q", "d", "t", "v"])

    yy = (F.when(ok % 211 == 0, F.lit("50")).when(ok % 223 == 0, F.lit("90"))
          .otherwise(_two(F.year(d) % 100)))
    datum = F.concat_ws(".", _two(F.dayofmonth(d)), _two(F.month(d)), yy)
    gebdatum = F.concat_ws(".", _two(pid % 28 + 1), _two(pid % 12 + 1), _two((pid * 13 + 25) % 100))
    sex = F.when(pid % 97 == 0, F.lit(None).cast("string")).when(pid % 4 == 0, "M").otherwise("W")
    typ = (F.when((t == 7) & (ln == 7), "X").when(t <= 1, "A").when(t <= 4, "Y")
           .when(t <= 6, "*").otherwise("D"))

    lab_text = F.concat(
        F.lit("HKT="), q, _case(pk % 5, ["+", "-", "++", "--", ""]), F.lit(" %; "),
        _case(sk % 4, ["CHOL", "LDL", "FERR", "THRO"]), F.lit("="), sk.cast("string"),
        _case(ok % 3, ["+ mg", " mg", "- mg"]), F.lit(" (1-5); "),
        _case(pk % 7, ["HBSAG=negativ", "HBSAG=Positiv", F.concat(F.lit("Eosinophile "), q, F.lit("+ % (2 - 4)"))],
              F.lit("kein Wert")),
    )
    anam_text = _case(v, ["<br> Patient müde, Erschöpfung und Schilddrüsenunterfunktion",
                          "Knochenschmerzen a b Vergrößerung", "Splenomegalie und Thrombopenie",
                          "Familienanamnese unauffällig", "AL: Abrechnung", "Text |END"],
                      F.concat(F.lit("Kontrolluntersuchung Stoffwechsel "), (pk % 50).cast("string")))
    diag_text = (
        F.when((pid % 37 == 0) & (v < 4), "M. Gaucher E75.22G")
        .when((pid % 11 == 0) & (v < 4), "Familiäre Hypercholesterinämie")
        .when((pid % 23 == 0) & (v < 3), "Familiäre Chylomikronämie E78.3")
        .when((pid % 29 == 0) & (v < 3), "Betaoxidationsdefekt")
        .when(v == 4, "V.a. Anämie").when(v == 5, "Z.a. Hepatitis C")
        .when((v == 6) & (pid % 37 == 1), "Ausschluss Gaucher")
        .when(v == 7, "Hypertonie art.").when(v == 8, "Vit. D-Mangel").when(v == 9, "Struma E04.9G")
        .when(v == 10, "fatigue Syndrom")
        .otherwise(F.concat(F.lit("Diagnose "), (pk % 20).cast("string")))
    )
    text = (F.when((ok + ln) % 101 == 0, F.lit(None).cast("string"))
            .when(t <= 1, anam_text).when(t <= 4, lab_text).otherwise(diag_text))
    icd = (F.when(t < 5, F.lit(None).cast("string"))
           .when((pid % 37 == 0) & (v < 2), "E75.2").when((pid % 23 == 0) & (v < 2), "E78.3")
           .when(v == 11, "E55.-").when(v == 12, "I10.90").when(v == 13, "R16.1").when(v == 14, "E55.9"))
    certainty = (F.when(t < 5, F.lit(None).cast("string"))
                 .when(v == 12, "G").when(v == 13, "V").when(v == 14, "Z").when(v == 15, "A"))

    out = j.select(
        F.md5(pid.cast("string")).alias("PATIENT_HASH"),
        _case(nk % 4, ["BER01", "FRA01", "HAM08", "STR01"]).alias("ZENTRUM_ID"),
        pid.alias("PATIENT_ID"),
        gebdatum.alias("PAT_GEBDATUM"),
        sex.alias("PAT_GESCHLECHT"),
        datum.alias("DATUM"),
        typ.alias("TYP"),
        F.lit(None).cast("string").alias("TYP_EXT"),
        text.alias("TEXT"),
        icd.alias("ICD10"),
        certainty.alias("SICHERHEIT"),
    )
    return add_entry_id(out) if with_entry_id else out


def add_entry_id(df: DataFrame) -> DataFrame:
    """Content hash of the raw row: a stable, engine-independent tie-break (exact duplicates tie,
    which is harmless because they are interchangeable). Every column enters as ``N`` if null, else
    as its length and value, so rows that differ in any column hash different texts."""
    def part(c: str) -> Column:
        v = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("N"))

    return df.withColumn(ENTRY_ID, F.md5(F.concat(*[part(c) for c in RAW_COLUMNS])))


# The same view for the DuckDB oracle. Written independently of the DataFrame code above; the
# test suite checks that both give identical rows.
JOURNAL_SQL = """
SELECT md5(CAST(pid AS VARCHAR)) AS PATIENT_HASH,
  CASE nk % 4 WHEN 0 THEN 'BER01' WHEN 1 THEN 'FRA01' WHEN 2 THEN 'HAM08' ELSE 'STR01' END AS ZENTRUM_ID,
  pid AS PATIENT_ID,
  lpad(CAST(pid % 28 + 1 AS VARCHAR), 2, '0') || '.' || lpad(CAST(pid % 12 + 1 AS VARCHAR), 2, '0') || '.'
    || lpad(CAST((pid * 13 + 25) % 100 AS VARCHAR), 2, '0') AS PAT_GEBDATUM,
  CASE WHEN pid % 97 = 0 THEN NULL WHEN pid % 4 = 0 THEN 'M' ELSE 'W' END AS PAT_GESCHLECHT,
  lpad(CAST(day(d) AS VARCHAR), 2, '0') || '.' || lpad(CAST(month(d) AS VARCHAR), 2, '0') || '.'
    || CASE WHEN ok % 211 = 0 THEN '50' WHEN ok % 223 = 0 THEN '90'
            ELSE lpad(CAST(year(d) % 100 AS VARCHAR), 2, '0') END AS DATUM,
  CASE WHEN t = 7 AND ln = 7 THEN 'X' WHEN t <= 1 THEN 'A' WHEN t <= 4 THEN 'Y' WHEN t <= 6 THEN '*' ELSE 'D' END AS TYP,
  CAST(NULL AS VARCHAR) AS TYP_EXT,
  CASE WHEN (ok + ln) % 101 = 0 THEN NULL
    WHEN t <= 1 THEN CASE v WHEN 0 THEN '<br> Patient müde, Erschöpfung und Schilddrüsenunterfunktion'
        WHEN 1 THEN 'Knochenschmerzen a b Vergrößerung' WHEN 2 THEN 'Splenomegalie und Thrombopenie'
        WHEN 3 THEN 'Familienanamnese unauffällig' WHEN 4 THEN 'AL: Abrechnung' WHEN 5 THEN 'Text |END'
        ELSE 'Kontrolluntersuchung Stoffwechsel ' || CAST(pk % 50 AS VARCHAR) END
    WHEN t <= 4 THEN 'HKT=' || q
        || CASE pk % 5 WHEN 0 THEN '+' WHEN 1 THEN '-' WHEN 2 THEN '++' WHEN 3 THEN '--' ELSE '' END || ' %; '
        || CASE sk % 4 WHEN 0 THEN 'CHOL' WHEN 1 THEN 'LDL' WHEN 2 THEN 'FERR' ELSE 'THRO' END || '=' || CAST(sk AS VARCHAR)
        || CASE ok % 3 WHEN 0 THEN '+ mg' WHEN 1 THEN ' mg' ELSE '- mg' END || ' (1-5); '
        || CASE pk % 7 WHEN 0 THEN 'HBSAG=negativ' WHEN 1 THEN 'HBSAG=Positiv'
                       WHEN 2 THEN 'Eosinophile ' || q || '+ % (2 - 4)' ELSE 'kein Wert' END
    ELSE CASE WHEN pid % 37 = 0 AND v < 4 THEN 'M. Gaucher E75.22G'
        WHEN pid % 11 = 0 AND v < 4 THEN 'Familiäre Hypercholesterinämie'
        WHEN pid % 23 = 0 AND v < 3 THEN 'Familiäre Chylomikronämie E78.3'
        WHEN pid % 29 = 0 AND v < 3 THEN 'Betaoxidationsdefekt'
        WHEN v = 4 THEN 'V.a. Anämie' WHEN v = 5 THEN 'Z.a. Hepatitis C'
        WHEN v = 6 AND pid % 37 = 1 THEN 'Ausschluss Gaucher'
        WHEN v = 7 THEN 'Hypertonie art.' WHEN v = 8 THEN 'Vit. D-Mangel' WHEN v = 9 THEN 'Struma E04.9G'
        WHEN v = 10 THEN 'fatigue Syndrom'
        ELSE 'Diagnose ' || CAST(pk % 20 AS VARCHAR) END
  END AS TEXT,
  CASE WHEN t < 5 THEN NULL WHEN pid % 37 = 0 AND v < 2 THEN 'E75.2' WHEN pid % 23 = 0 AND v < 2 THEN 'E78.3'
    WHEN v = 11 THEN 'E55.-' WHEN v = 12 THEN 'I10.90' WHEN v = 13 THEN 'R16.1' WHEN v = 14 THEN 'E55.9' END AS ICD10,
  CASE WHEN t < 5 THEN NULL WHEN v = 12 THEN 'G' WHEN v = 13 THEN 'V' WHEN v = 14 THEN 'Z' WHEN v = 15 THEN 'A' END AS SICHERHEIT
FROM (
  SELECT c.c_custkey AS pid, c.c_nationkey AS nk, l.l_orderkey AS ok, l.l_linenumber AS ln,
    CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) AS q, l.l_partkey AS pk, l.l_suppkey AS sk,
    CAST(l.l_shipdate AS DATE) AS d,
    (l.l_orderkey * 7 + l.l_linenumber * 3 + l.l_partkey) % 8 AS t,
    (l.l_partkey + l.l_suppkey) % 16 AS v
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
) src
"""

# Fixed column order of the raw journal, as in ``schema.RAW_COLUMNS``.
JOURNAL_ENTRY_SQL = "SELECT *, md5(" + " || ".join(
    f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), 'N')" for c in RAW_COLUMNS
) + ") AS entry_id FROM (" + JOURNAL_SQL + ") jv"
