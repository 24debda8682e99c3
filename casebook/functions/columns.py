"""Small Column builders shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has(c: str | Column, term: str) -> Column:
    """Literal substring test; null text counts as no hit (the reference tests ``str(NaN)``)."""
    return F.coalesce(col_or(c).contains(F.lit(term)), F.lit(False))


def has_all(c: str | Column, terms: Iterable[str]) -> Column:
    out = None
    for t in terms:
        out = has(c, t) if out is None else out & has(c, t)
    return out


def has_any(c: str | Column, terms: Iterable[str]) -> Column:
    out = None
    for t in terms:
        out = has(c, t) if out is None else out | has(c, t)
    return out


def seeded_hash(seed: int | str, key: str | Column) -> Column:
    """md5(seed ':' key) — the ordering used by every seeded random step (same text in DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col_or(key).cast("string")))


def hex_prefix_int(h: Column, digits: int) -> Column:
    """Integer value of the first ``digits`` hex characters of an md5 string."""
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("bigint")


def one_of(c: str | Column, values: Iterable[str]) -> Column:
    return col_or(c).isin(list(values))
