"""Joins with a table of few keys that may each stand in a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Copies of the smaller side where few keys hold many rows, and the most rows that are broadcast.
SALT, BROADCAST_ROWS = 8, 200_000


def join_few(many: DataFrame, few: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``many`` joined with the staged ``few`` on ``keys``: broadcast if counted to be few rows, else each key in SALT
    parts by the hash of the row. Neither way leaves the rows partitioned by a key alone, which later groupings by
    more columns would take over, a key's rows in one task."""
    keys = list(keys)
    if few.count() <= BROADCAST_ROWS:
        return many.join(F.broadcast(few), keys, how)
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salt = F.pmod(F.xxhash64(*many.columns), F.lit(SALT)).cast("int")
    return many.withColumn("_salt", salt).join(copies, [*keys, "_salt"], how).drop("_salt")
