"""Packing documents into fixed windows by non-negative least squares (operator 8).

1. Tokens: each text is encoded in one narrow pass and cut at multiples of the window; what is kept
   of a piece is its place, length and checksum. Full pieces are sequences of their own.
2. Histogram: the other pieces have lengths 1 to window - 1, so their counts fit in as many numbers,
   whatever the corpus; these, and nothing else, come to the driver.
3. Combinations: all pairs of lengths that fill the window exactly, and triples made of frequent
   lengths. Non-negative least squares finds how often to repeat each so that the repeats match the
   histogram; repeats are rounded down. What is left is packed greedily, longest first into the
   fullest fit, again on the histogram, which repeats each filling as often as its lengths allow.
4. Assignment: the k-th piece of a length takes the k-th place that the plan has for that length.
   Ranks are counted within slices of each length plus the slices before, so no length is gathered
   in one task. The plan has a bounded number of rows (place intervals) and is broadcast.

Nulls: a null text is empty: one piece that holds the end token alone; a null id is kept. Rows that
repeat an id are documents of their own. An empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import column, map_texts
from casebook.llm.wordbpe import WordBpe
from casebook.session import stage

WINDOW, END_ID = 4096, 2
#: Lengths that may take part in triples, and rounds of the solver.
FREQUENT, ROUNDS = 64, 300
SLICES = 1024


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, slice): a row per piece. ``tokenizer`` is the
    JSON text of a tokenizer file."""
    def per_task():
        bpe = WordBpe(tokenizer)

        def run(batch: pa.RecordBatch) -> pa.Table:
            rows, start, length, crc, total = [], [], [], [], []
            for row, ids in enumerate(bpe.encode(column(batch, "text").to_pylist())):
                ids = np.append(ids, END_ID).astype("<u4")
                for at in range(0, len(ids), window):
                    part = ids[at:at + window]
                    rows.append(row)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(ids))
            return pa.table({"doc_id": column(batch, "doc_id").take(pa.array(rows, pa.int64())), "start": pa.array(start, pa.int64()),
                             "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(total, pa.int64())})

        return run

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_texts(body, per_task, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long", per_task=True)


def combinations(histogram: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Pairs that fill the window, and triples with two frequent lengths that do. ``histogram[n]`` is
    the count of length n."""
    held = histogram > 0
    out = [(window - b, b) for b in range(1, window // 2 + 1) if held[b] and held[window - b]]
    common = [int(n) for n in np.argsort(-histogram, kind="stable")[:FREQUENT] if histogram[n]]
    seen = set()
    for i, a in enumerate(common):
        for b in common[i:]:
            c = window - a - b
            if c > 0 and held[c]:
                seen.add(tuple(sorted((a, b, c), reverse=True)))
    return out + sorted(seen)


def solve(histogram: np.ndarray, combos: list[tuple[int, ...]], rounds: int = ROUNDS) -> np.ndarray:
    """Repeats x >= 0 that minimise |A x - histogram|^2, A holding how often a combination uses a length:
    projected gradient steps with Nesterov's momentum."""
    if not combos:
        return np.zeros(0)
    lengths = np.array([n for c in combos for n in c])
    owner = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    goal = histogram.astype(float)
    use = lambda x: np.bincount(lengths, weights=x[owner], minlength=len(goal))
    back = lambda r: np.bincount(owner, weights=r[lengths], minlength=len(combos))
    # Step from the norm of A'A, bounded by its largest row sum.
    step = 1.0 / max(1.0, back(use(np.ones(len(combos)))).max())
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(rounds):
        nxt = np.maximum(0.0, y - step * back(use(y) - goal))
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = nxt + (t - 1) / t_next * (nxt - x)
        x, t = nxt, t_next
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a filling, repeats) that use up the histogram exactly."""
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    combos = combinations(histogram, window)
    repeats = np.floor(solve(histogram, combos) + 1e-9).astype(np.int64)
    for c in np.argsort(-repeats, kind="stable"):
        combo, n = combos[c], int(repeats[c])
        need = np.bincount(combo, minlength=len(left))
        used = np.flatnonzero(need)
        n = min(n, int((left[used] // need[used]).min()))  # roundings may meet in one length
        if n > 0:
            left[used] -= n * need[used]
            out.append((combo, n))
    return out + greedy(left, window)


def greedy(left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Fills a sequence with the longest length left, then always with the longest that still fits,
    trying the last two by the best sum; repeats each filling while its lengths last."""
    left = left.copy()
    out = []
    while left.any():
        room, filling = window, []
        have = left.copy()
        while room > 0:
            fits = np.flatnonzero(have[:room + 1])
            if not len(fits):
                break
            pick = int(fits[-1])
            if filling and pick < room:  # a pair that fills the room beats the longest single one
                small = fits[fits < room]
                rest = room - small
                pair = small[(have[rest] > 0) & ((rest != small) | (have[small] > 1))]
                if len(pair):
                    pick = int(pair[-1])
            filling.append(pick)
            have[pick] -= 1
            room -= pick
        need = np.bincount(filling, minlength=len(left))
        used = np.flatnonzero(need)
        n = int((left[used] // need[used]).min())
        left[used] -= n * need[used]
        out.append((tuple(filling), n))
    return out


def intervals(fillings: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, offset): the k-th piece of a length, counted from
    the first rank, goes to the k-th sequence counted from the first, at the offset."""
    given: dict[int, int] = {}
    out, sequence = [], 0
    for filling, n in fillings:
        at = 0
        for length in filling:
            rank = given.get(length, 0)
            out.append((length, rank, n, sequence, at))
            given[length] = rank + n
            at += length
        sequence += n
    return out


def ranked(made: DataFrame) -> DataFrame:
    """Adds ``rank``: 0, 1, ... among the pieces of a length, by slice and then by id and start."""
    key = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SLICES))
    sliced = made.withColumn("_slice", key)
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sliced.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
              .select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    within = Window.partitionBy("length", "_slice").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    return (sliced.withColumn("_rank", F.row_number().over(within) - 1).join(starts, ["length", "_slice"])
            .withColumn("rank", F.col("_start") + F.col("_rank")).drop("_slice", "_rank", "_start"))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Contract rows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    made = stage(pieces(docs, tokenizer, window))
    counts = made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``window`` rows
    histogram = np.zeros(window + 1, dtype=np.int64)
    for row in counts:
        histogram[row["length"]] = row["n"]
    full, histogram[window] = int(histogram[window]), 0
    places = [(window, 0, full, 0, 0)] if full else []
    places += [(n, rank, k, full + s, at) for n, rank, k, s, at in intervals(plan(histogram, window))]
    by_length: dict[int, list] = {}
    for n, rank, k, sequence, at in places:
        by_length.setdefault(n, []).append((rank, sequence, at))
    # One row a length: its intervals by first rank. Their number is bounded by the combinations.
    table = spark.createDataFrame([(n, [tuple(map(int, p)) for p in sorted(of)]) for n, of in by_length.items()],
                                  "length long, places array<struct<rank:long,sequence:long,at:long>>")
    place = F.element_at(F.filter("places", lambda p: p["rank"] <= F.col("rank")), -1)
    return ranked(made).join(F.broadcast(table), "length").withColumn("_place", place).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_place.sequence") + F.col("rank") - F.col("_place.rank")).alias("sequence_id"), F.col("_place.at").alias("offset"))
