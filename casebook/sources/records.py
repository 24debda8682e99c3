"""CSV records with line breaks in quotes, read by many tasks.

Spark reads such files whole (``multiLine``), one task a file. Here a file is read in its splits as lines; a line
break ends a record only where the number of quotes before it in the file is even. One pass counts the quotes of every
split; their running parity says in which state each split begins (a row for each split reaches the driver: one for
every 128 MB by default). A second pass cuts each split into records; what stands before the first and after the last
record end of a split is put together with its neighbours' parts. Only these parts are shuffled.

Every quote must be an enclosing or a doubled one (RFC 4180); a file with an odd number of them raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.operators import neighbours  # noqa: F401  (registers the package for by-value pickling)
from casebook.session import stage

HEAD, TAIL = 0, 1


def split_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str) -> DataFrame:
    """(file, split, line): the lines of each split in their order; ``split`` is its first byte."""
    raw = spark.read.option("lineSep", "\n").text(list(paths) if not isinstance(paths, str) else paths)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                      F.decode(F.col("value").cast("binary"), encoding).alias("line"))


def split_states(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """Whether each split begins within quotes."""
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "split").agg(F.sum(quotes).alias("n")).orderBy("file", "split").collect()  # a row a split
    out: dict[tuple[str, int], bool] = {}
    held: dict[str, int] = {}
    for r in counts:
        out[r["file"], r["split"]] = held.get(r["file"], 0) % 2 == 1
        held[r["file"]] = held.get(r["file"], 0) + r["n"]
    odd = [f for f, n in held.items() if n % 2]
    if odd:
        raise ValueError(f"unbalanced quotes in {odd[:3]}")
    return out


def cut(lines: list[str], quotes: np.ndarray, inside: bool) -> tuple[list[str], list[str], bool]:
    """(what belongs together up to each record end, the lines after the last end, still within quotes)."""
    state = (np.cumsum(quotes) + inside) % 2
    ends = np.flatnonzero(state == 0)
    if len(ends) == len(lines):
        return lines, [], False
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    rest = lines[int(ends[-1]) + 1:] if len(ends) else lines
    return ["\n".join(lines[a:b + 1]) for a, b in zip(starts.tolist(), ends.tolist())], rest, bool(state[-1])


def records(spark: SparkSession, paths: str | Sequence[str], encoding: str = "ISO-8859-1", header: bool = True) -> DataFrame:
    """(record): the text of every record of the files, without their header records and blank lines."""
    lines = split_lines(spark, paths, encoding)
    states = split_states(lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_lines, head, inside, skip = None, [], False, False, False

        def tail() -> list[tuple]:
            # Lines that no record end follows: the rest of a split that began within quotes, or a record's beginning.
            return [(now[0], now[1], HEAD if head else TAIL, "\n".join(open_lines))] if open_lines else []

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({n: pa.array([f[i] for f in found], t) for i, (n, t) in enumerate(
                (("file", pa.string()), ("split", pa.int64()), ("place", pa.int32()), ("record", pa.string())))})

        for batch in filter(len, batches):
            files, splits = batch.column("file"), batch.column("split").to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], (splits[1:] != splits[:-1]) | (
                pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False)))))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(splits)]):
                key, out = (files[a].as_py(), int(splits[a])), []
                if key != now:
                    out += tail() if now else []
                    now, open_lines, inside = key, [], states[key]
                    head, skip = inside, header and key[1] == 0
                part = batch.column("line").slice(a, b - a)
                found, rest, inside = cut(part.to_pylist(), pc.count_substring(part, '"').to_numpy(zero_copy_only=False), inside)
                if found:
                    first = "\n".join([*open_lines, found[0]])
                    open_lines = []
                    whole = found[1:] if head else [first, *found[1:]]
                    if head:
                        out.append((*key, HEAD, first))
                    head = False
                    if skip and whole:
                        whole, skip = whole[1:], False
                    out += [(*key, None, w) for w in whole if w.strip("\r")]
                open_lines = [*open_lines, *rest]
                if out:
                    yield rows(out)
        if now and open_lines:
            yield rows(tail())

    made = stage(lines.mapInArrow(run, "file string, split long, place int, record string"))
    # A record that begins in one split ends in a later one: parts in order, each tail begins a record.
    parts = made.filter("place is not null")
    begun = F.sum(F.when(F.col("place") == TAIL, 1).otherwise(0)).over(
        Window.partitionBy("file").orderBy("split", "place").rowsBetween(Window.unboundedPreceding, 0))
    joined = parts.withColumn("n", begun).groupBy("file", "n").agg(F.sort_array(F.collect_list(F.struct("split", "place", "record"))).alias("p"))
    return made.filter("place is null").select("record").unionByName(
        joined.select(F.array_join(F.transform("p", lambda p: p["record"]), "\n").alias("record")))


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, sep: str = ";", encoding: str = "ISO-8859-1", header: bool = True) -> DataFrame:
    """The files' records with the columns of ``schema``."""
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "FAILFAST", "maxCharsPerColumn": "-1"}
    text = F.rtrim(F.col("record"), F.lit("\r"))
    parsed = records(spark, paths, encoding, header).select(F.from_csv(text, schema.simpleString()[len("struct<"):-1].replace(":", " "), options).alias("r"))
    return parsed.select("r.*")
