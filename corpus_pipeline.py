"""Corpus pipeline: raw documents to packed training sequences, one operator a stage.

Each stage gets what its predecessor kept, written as Parquet and read again, and all but the last
return the columns of ``documents``.

Rows that share an id (or have none) are documents of their own, told apart by their texts: the near-duplicate
stage keeps one row of each component, that of least id (null last), then text hash. A text that substring dedup
cuts to nothing stays as an empty document (it packs as its end token alone).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm import packing, secrets, simhash, substrings, weakrules
from casebook.llm.common import DOCUMENT_COLUMNS, documents, public_tokenizer
from casebook.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the weighed rules reject go."""
    return weakrules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each component of near duplicates the row of least id and text hash stays, whatever ids
    repeat or are null; of rows equal in both, one."""
    found = simhash.near_duplicates(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = found.groupBy("root").agg(F.min(order).alias("m")).select(F.col("m.doc_id").alias("_id"), F.col("m.text_key").alias("_key"))
    body = docs.select(*DOCUMENT_COLUMNS, simhash.text_key("text"))
    kept = body.join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_semi")
    same = Window.partitionBy("doc_id", "text_key").orderBy("text_key")
    return kept.withColumn("_before", F.lag(F.lit(1)).over(same)).filter(F.col("_before").isNull()).select(*DOCUMENT_COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: sentences of every repeated span but the first are cut."""
    return substrings.dedup_substrings(docs).select(*DOCUMENT_COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: secrets are replaced by a mark."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: pieces of the documents, placed in sequences."""
    return packing.pack(docs, public_tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("secret_scans", secret_scan),
    ("packing", pack),
]

#: Expectation-maximisation, byte-pair encoding and components are beyond SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
