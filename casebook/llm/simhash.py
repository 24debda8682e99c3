"""SimHash near-duplicates by segment popcounts (operator 9).

Fingerprints: 64 majority bits over the XXH64 hashes of a text's word shingles. Documents link if
their fingerprints differ in ``max_bits`` bits or fewer; a component is what links reach.

The search works on distinct fingerprints, never on documents:

1. Embedding: a fingerprint becomes the vector of its bit counts in 32 segments of two bits. A
   differing bit changes one count by one, so the Manhattan distance of two vectors is a lower bound
   of the number of differing bits. Segments this fine hardly ever meet by chance, so what passes
   the grid grows with the near duplicates, not with the square of the corpus.
2. Grid range-join: each fingerprint is entered in the grid cell of its vector and of every vector at
   Manhattan distance ``max_bits / 2``: two within ``max_bits`` then meet in a cell (the cells half
   way along a shortest path). Fingerprints that meet no other cannot have a link and drop out. The
   join always shuffles by cell, whatever its size.
3. Exact check: the rest are compared bit by bit through the words half way between them: two
   fingerprints differ in ``max_bits`` bits or fewer if and only if they share a word within
   ``max_bits / 2`` flipped bits of both. At most 1 + 64 fingerprints lie within one flip of a word
   (for ``max_bits`` 2), so each such group is bounded by that, however many copies or near copies
   the corpus holds, and no pairs of a group are made: its members link to the least of them.

Both joins meet on equal keys, so work is proportional to the number of distinct fingerprints.

Nulls: a null text has no words, and its fingerprint is zero, like that of an empty text; such
documents link like any others. A null id takes part and is larger than any id. Repeated rows keep
a row each. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import column, hot_keys, map_texts
from casebook.llm.components import components
from casebook.session import stage

#: The lower bit of each two-bit segment.
_LOW = np.uint64(0x5555555555555555)
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BIT = np.arange(64, dtype=np.uint64)


def simhash(text: bytes, words_per_shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of one UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = WORDS.findall(text.translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words_per_shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in spans), dtype="<u8", count=len(words) - k + 1)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.bitwise_or.reduce(np.where(2 * votes > len(hashes), np.uint64(1) << _BIT, np.uint64(0))))


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """``(doc_id, fp, text_key)``, fp as a signed long of the same bits, text_key a hash that tells texts of one id
    apart; a narrow pass over the texts."""
    def run(batch: pa.RecordBatch) -> pa.Table:
        values = [simhash(t.as_buffer().to_pybytes() if t.is_valid else b"", words_per_shingle) for t in column(batch, "text")]
        return pa.table({"doc_id": column(batch, "doc_id"), "fp": np.array(values, dtype=np.uint64).astype(np.int64), "text_key": column(batch, "text_key")})

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("text"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return map_texts(body, run, "doc_id long, fp long, text_key long")


def text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key")


def counts(fp: np.ndarray) -> np.ndarray:
    """The bit counts of the 32 two-bit segments, each in the place of its segment."""
    a, b = fp & _LOW, (fp >> np.uint64(1)) & _LOW
    return (a ^ b) | (a & b) << np.uint64(1)


def cells(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of all grid cells within Manhattan distance 1 of each fingerprint's counts. Counts run
    from 0 to 2, so there is no cell below or above."""
    vector = counts(fp)
    rows, found = [np.arange(len(fp))], [vector]
    for s in range(32):
        one = np.uint64(1) << np.uint64(2 * s)
        at = vector >> np.uint64(2 * s) & np.uint64(3)
        for can, step in ((at < 2, one), (at > 0, np.uint64(0) - one)):
            rows.append(np.flatnonzero(can))
            found.append(vector[can] + step)
    return np.concatenate(rows), np.concatenate(found)


def entered(distinct: DataFrame) -> DataFrame:
    """(fp, cell) for every grid cell of every fingerprint. The fingerprints are dealt to as many tasks as
    a shuffle has, since each becomes some 49 rows."""
    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fp), 1 << 14):
                part = fp[at:at + (1 << 14)]
                with np.errstate(over="ignore"):
                    row, cell = cells(part)
                yield pa.record_batch({"fp": pa.array(part[row].view(np.int64)), "cell": pa.array(cell.view(np.int64))})

    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return distinct.select("fp").repartition(tasks, "fp").mapInArrow(run, "fp long, cell long")


def near_words(fp: Column) -> Column:
    """The word itself and all at one flipped bit: array<long> of 65."""
    bits = [1 << b for b in range(63)] + [-(1 << 63)]
    return F.array(fp, *[fp.bitwiseXOR(F.lit(b).cast("long")) for b in bits])


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) whose components equal those of all pairs of fingerprints within two bits."""
    grid = entered(distinct)
    shared = (grid.groupBy("cell").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
              .filter(F.col("lo") != F.col("hi")).select("cell"))
    met = stage(grid.join(shared.hint("merge"), "cell", "left_semi").select("fp").distinct())
    between = met.select("fp", F.explode(near_words(F.col("fp"))).alias("word"))
    groups = between.groupBy("word").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a != b").distinct()


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """``(doc_id, fp, text_key, component_id, root)`` for every row; component_id is the smallest doc_id reachable, root
    a fingerprint that names the component (ids may repeat)."""
    marked = stage(fingerprints(docs, words_per_shingle))
    distinct = stage(marked.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")))
    roots = stage(components(links(distinct)))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "n", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = stage(placed.join(least, "root").select("fp", "n", "component_id", "root"))
    total = distinct.agg(F.sum("n")).first()[0] or 0
    # Fingerprints with over a thousandth of all rows (under a thousand of them) are joined by
    # broadcast; for the rest no key of the shuffle holds more than that share.
    hot = hot_keys(groups, total).select("fp", F.struct("component_id", "root").alias("_hot"))
    rest = marked.join(F.broadcast(hot), "fp", "left")
    cold = rest.filter(F.col("_hot").isNull()).drop("_hot").join(groups.select("fp", "component_id", "root"), "fp", "left")
    return rest.filter(F.col("_hot").isNotNull()).select("doc_id", "fp", "text_key", "_hot.component_id", "_hot.root").unionByName(
        cold.select("doc_id", "fp", "text_key", "component_id", "root"))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicate_rows(docs: DataFrame) -> DataFrame:
    """Contract rows: doc_id, fingerprint, component_id."""
    return near_duplicates(docs).select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")
