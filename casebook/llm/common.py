"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import casebook
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this package travel to Python workers by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(casebook)

#: Columns of the documents table, in order; pipeline stages but the last return these.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def public_tokenizer(name: str) -> str:
    """JSON text of an installed public tokenizer file, read on the driver: tasks get the text, so the
    executors need no such file."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def text_of(df: DataFrame) -> DataFrame:
    """``doc_id`` and the whole text, null read as empty; other columns do not travel."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def map_texts(df: DataFrame, fn, schema: str, max_chars: int = 2_000_000, per_task: bool = False) -> DataFrame:
    """``mapInArrow`` over frames that hold a ``text`` column: ``fn(batch) -> pa.Table | None``. With
    ``per_task``, ``fn()`` makes that function, once a task, for what is costly to build.

    Arrow batches have a row limit, not a byte limit, so each is cut into slices of about
    ``max_chars`` bytes of text (one longer text makes a slice of its own): memory in the Python
    worker is bounded by that and by the longest single text. The cycle collector rests meanwhile: it would
    walk large tables of strings again and again, and nothing here makes cycles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        try:
            each = fn() if per_task else fn
            for batch in batches:
                for part in slices(batch, max_chars):
                    out = each(part)
                    if out is not None:
                        yield from out.to_batches()
        finally:
            gc.enable()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, max_chars: int) -> Iterator[pa.RecordBatch]:
    import pyarrow.compute as pc

    sizes = pc.binary_length(batch.column(batch.schema.get_field_index("text"))).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + (n or 0) > max_chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < len(sizes):
        yield batch.slice(start)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def hot_keys(counts: DataFrame, total: int, share: int = 1000) -> DataFrame:
    """Keys that hold more than one ``share``-th of ``total`` rows, from a ``(key…, n)`` table. By
    counting, fewer than ``share`` keys can: a proven bound, whatever the input."""
    return counts.filter(F.col("n") * F.lit(share) > F.lit(total))
