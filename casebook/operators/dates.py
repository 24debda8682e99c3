"""Entry dates, birth dates and age (D1-D6). Narrow projections only — no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.schema import SITE

DAYS_PER_YEAR = 365.2425  # numpy's timedelta64(1, 'Y')


def entry_order() -> Column:
    """Entry order: by date with unknown dates last (pandas sorts NaT last), then content hash."""
    return F.struct(F.col("entry_date").isNull(), F.col("entry_date"), F.col("entry_id"))


def _yy(c: str) -> Column:
    """Text after the second dot of ``dd.mm.yy`` (the reference slices ``str(x)[6:]``)."""
    return F.substring(F.col(c), 7, 1 << 20)


def _parse(ddmm_yyyy: Column, strict: bool) -> Column:
    return F.to_date(ddmm_yyyy, "dd.MM.yyyy") if strict else F.try_to_date(ddmm_yyyy, "dd.MM.yyyy")


def add_entry_date(df: DataFrame, typo_scope: str | None = "all", strict: bool = False) -> DataFrame:
    """``entry_year`` (4 chars) and ``entry_date``.

    Year typos ``50``→``05`` and ``90``→``09`` are repaired on all rows (``typo_scope='all'``, what the
    shipped run does), only on Berlin rows (``'BER01'``) or not at all (``None``). Two-digit years
    below ``21`` are 20xx, others 19xx. A repaired year can make an impossible date (29.02.2009):
    the reference raises there; by default such dates are null, ``strict=True`` raises (ANSI)."""
    yy = _yy("DATUM")
    fixed = F.when(yy == "50", "05").when(yy == "90", "09").otherwise(yy)
    if typo_scope == "all":
        yy = fixed
    elif typo_scope:
        yy = F.when(F.col(SITE) == typo_scope, fixed).otherwise(yy)
    year = F.concat(F.when(yy < "21", "20").otherwise("19"), yy)
    return (df.withColumn("entry_year", year)
            .withColumn("entry_date", _parse(F.concat(F.substring("DATUM", 1, 6), F.col("entry_year")), strict)))


def add_birth_date(df: DataFrame, strict: bool = False) -> DataFrame:
    """Birth century — yy > '20' → 19; entry before 2000 → 19; entry yy − birth yy < 0 → 19;
    else 20. Needs ``entry_year`` (``add_entry_date``)."""
    by = _yy("PAT_GEBDATUM")
    diff = F.substring("entry_year", 3, 2).cast("int") - by.cast("int")
    century = (F.when(by > "20", "19").when(F.col("entry_year") < "2000", "19")
               .when(diff < 0, "19").otherwise("20"))
    return df.withColumn("birth_date", _parse(F.concat(F.substring("PAT_GEBDATUM", 1, 6), century, by), strict))


def add_age(df: DataFrame, typo_scope: str | None = "all", strict: bool = False) -> DataFrame:
    """Age in years (365.2425-day years), one decimal; adds entry_date and birth_date."""
    out = add_birth_date(add_entry_date(df, typo_scope, strict), strict)
    age = F.round(F.datediff("entry_date", "birth_date") / F.lit(DAYS_PER_YEAR), 1)
    return out.withColumn("age", age).drop("entry_year")
