"""Per-patient features.

All per-patient work is one grouped aggregate per feature family (conditional aggregates instead
of one merge per code/symptom), keyed by PATIENT_HASH; families are then joined on that key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.functions.columns import has, has_any
from casebook.operators.dates import entry_order
from casebook.schema import PATIENT


def safe_name(s: str) -> str:
    return s.replace(".", "_").replace(" ", "_")


def mean_age(df: DataFrame) -> DataFrame:
    """A1: mean age per patient (rounded to 6 digits for a stable comparison)."""
    return df.groupBy(PATIENT).agg(F.round(F.avg("age"), 6).alias("mean_age"))


def comorbidity(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """A5: per patient 1 if any row carries the code, else 0 (one column per code)."""
    return df.groupBy(PATIENT).agg(
        *[F.coalesce(F.max((F.col("ICD10") == c).cast("int")), F.lit(0)).alias(safe_name(c)) for c in codes])


def symptoms(df: DataFrame, groups: Sequence[Sequence[str]]) -> DataFrame:
    """Per patient and synonym group, rows whose text has any synonym (PATIENT_ID not null)."""
    return df.groupBy(PATIENT).agg(
        *[F.count_if(has_any("TEXT", g) & F.col("PATIENT_ID").isNotNull()).alias(g[0]) for g in groups])


def symptom_count(terms: Sequence[str]) -> Column:
    """Number of the terms present in a row's text."""
    return sum((has("TEXT", t).cast("int") for t in terms[1:]), has("TEXT", terms[0]).cast("int"))


def symptom_score(df: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Per patient the sum over rows of the number of symptom terms in the text (rows with a
    score > 0 only), highest first."""
    scored = df.withColumn("is_symptom", symptom_count(terms)).filter(F.col("is_symptom") > 0)
    return scored.groupBy(PATIENT).agg(F.sum("is_symptom").alias("is_symptom")).orderBy(F.desc("is_symptom"), PATIENT)


def code_frequency(df: DataFrame, min_count: int = 3) -> DataFrame:
    """Diagnosis rows per code, kept when more than ``min_count``, most frequent first."""
    d = df.filter(F.col("TYP").isin("*", "D") & F.col("ICD10").isNotNull())
    return (d.groupBy("ICD10").agg(F.count(PATIENT).alias("n")).filter(F.col("n") > min_count)
            .orderBy(F.desc("n"), "ICD10"))


def frequency_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """A10: share of rows carrying the row's value of ``col``. Per-value counts (one row per distinct
    value, partial aggregation) joined back; the total is a scalar subquery (no global window)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    total = df.agg(F.count(F.lit(1))).scalar()  # scalar subquery
    share = counts.select(col, (F.col("_c") / total).alias(out))
    return df.join(share, col, "left")


def last_values(df: DataFrame, cols: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """A3: per patient the last non-null value of each column in entry order (pandas
    ``groupby.last``). ``max_by`` is a partial aggregate: hot patients are reduced map-side."""
    key = F.struct(*order) if order else entry_order()
    return df.groupBy(PATIENT).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), key)).alias(c) for c in cols])


def patient_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2: per patient sums."""
    return df.groupBy(PATIENT).agg(*[F.sum(c).alias(c) for c in cols])


def dummies(df: DataFrame, col: str, values: Sequence[str], drop_first: bool = True) -> DataFrame:
    """0/1 columns ``<col>_<value>`` for the sorted values, the first dropped; null → all 0."""
    vals = sorted(values)[1:] if drop_first else sorted(values)
    return df.withColumns({f"{col}_{v}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in vals}).drop(col)


def sex_code(c: str = "PAT_GESCHLECHT") -> Column:
    """W → 1, M → 0 (null stays null, filled with 0 later)."""
    return F.when(F.col(c) == "W", 1).when(F.col(c) == "M", 0)


def empty_column_counts(df: DataFrame) -> DataFrame:
    """Non-null count per column as a long table (one aggregate pass, unpivoted JVM-side)."""
    cols = df.columns
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, non_null)")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """drop all-null columns. One aggregate pass; its one-row result (size = number of
    columns) is read on the driver to choose the projection."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if row[f"c{i}"] > 0])


def mask_value(df: DataFrame, value: str = "Y", columns: Sequence[str] | None = None) -> DataFrame:
    """string cells equal to ``value`` become null; no row is removed (``df[df != 'Y']``)."""
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(value)) for c in cols})
