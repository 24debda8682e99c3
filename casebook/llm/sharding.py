"""Sharding by jump consistent hashing (operator 10; DataFrame functions only).

A document's shard depends on its id and the number of shards alone: no ring or routing table.
The id's md5 seeds a 64-bit linear congruential generator; each draw jumps to the next shard count
at which the document would move, until the jump passes the number of shards. When a shard is
appended, exactly the documents whose next jump lands on it move, and they move only there.

Nulls: a null id is keyed as the empty string, a null text has no bytes. Repeated rows keep one
slot each. An empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.session import stage

#: Multiplier and modulus of the generator in the published algorithm.
MULTIPLIER = 2862933555777941757
MODULUS = 1 << 64

#: Slots are numbered in so many slices of each shard.
SLICES = 4096


def key_of(id_text: Column) -> Column:
    """60 bits of the id's md5 as a non-negative DECIMAL(20,0)."""
    return F.conv(F.substring(F.md5(F.coalesce(id_text, F.lit(""))), 1, 15), 16, 10).cast("decimal(20,0)")


def jump(key: Column, shards: int) -> Column:
    """struct(b, j): the shard among ``shards``, and the least shard count minus one at which the
    key would next move. Each draw raises j by one at least, so ``shards`` draws are enough; once
    j has passed, the remaining steps return their state untouched."""
    start = F.struct(key.alias("k"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(a: Column, i: Column) -> Column:
        k = ((a["k"] * F.lit(Decimal(MULTIPLIER)) + F.lit(1)) % F.lit(Decimal(MODULUS))).cast("decimal(20,0)")
        high = F.floor(k / F.lit(Decimal(1 << 33))).cast("long")
        nxt = F.floor(((a["j"] + 1) * F.lit(1 << 31)).cast("decimal(20,0)") / (high + 1).cast("decimal(11,0)")).cast("long")
        return F.when(a["j"] >= shards, a).otherwise(F.struct(k.alias("k"), a["j"].alias("b"), nxt.alias("j")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda a: F.struct(a["b"].alias("b"), a["j"].alias("j")))


def assign(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, text_crc32, shard, grown_shard)``: a narrow projection, no shuffle. ``size`` is
    the UTF-8 bytes of the text plus 16; ``grown_shard`` is the shard after one is appended."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    jumped = docs.select(
        F.col(id_col), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        jump(key_of(F.col(id_col).cast("string")), shards).alias("_at"))
    return jumped.select(
        id_col, "size", "text_crc32", F.col("_at.b").cast("int").alias("shard"),
        F.when(F.col("_at.j") == shards, F.lit(shards)).otherwise(F.col("_at.b")).cast("int").alias("grown_shard"))


def with_slots(assigned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard. No shard is sorted as a whole: rows are ranked
    within a slice of their shard, and a slice starts after all rows of the slices before it."""
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("text_crc32"), F.col("size")))
    sliced = stage(assigned.withColumn("_slice", F.conv(F.substring(digest, 1, 3), 16, 10).cast("int") % SLICES))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sliced.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("_n"))
              .select("shard", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    within = Window.partitionBy("shard", "_slice").orderBy(id_col, "text_crc32", "size")
    ranked = sliced.withColumn("_rank", F.row_number().over(within) - 1)
    return (ranked.join(starts, ["shard", "_slice"])
            .withColumn("slot", (F.col("_start") + F.col("_rank")).cast("long")).drop("_slice", "_rank", "_start"))


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Contract rows: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return with_slots(assign(docs, shards)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
