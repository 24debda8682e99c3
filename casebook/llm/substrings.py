"""Substring deduplication by sliding sentence spans (operator 2).

Every run of consecutive parts of sentences is hashed: from each part the shortest run that has at
least ``MIN_SENTENCES`` parts and ``MIN_WORDS`` words. Runs with equal hashes (128 bits over
lower-cased words, wherever parts and lines end between them) are joined over the whole corpus; the
occurrence in the smallest doc_id, and there the leftmost, is the first and stays. Parts covered by any
other are cut from their text.

A sentence ends at a line break, or at final punctuation before white space. Sentences are parted before
their anchors: of each ``ANCHOR_WINDOW`` consecutive words of the text, whatever lines they stand on, the
one of least CRC-32 (of equal ones the last) if no sentence begins among them after punctuation. So parts
depend on the words next to them only, and a passage parts alike wherever it stands, but for a window of
words at either end. A passage of 3 * ``ANCHOR_WINDOW`` + ``MIN_WORDS`` - 2 = 49 words that stands in two
places with its lines broken alike therefore holds an equal run; the words before its first and after its
last equal run stay.

Plan: sentences and hashes are made in one narrow pass, staged as fixed-width rows (one per run and
document). Repeats within a document are settled there. Across documents, counts and least ids come
from a pre-aggregated group-by; runs held by over a thousandth of all rows are joined back by
broadcast (fewer than a thousand can be), the others by shuffle, so no task holds a hot run. Columns
with mostly zero bytes (ids, counts) come last in what is shuffled, where they compress with the next
row's head. Texts are shuffled once, by document, to meet their cuts.

Nulls: a null text stays null and has no sentences; a null id counts as larger than any id. Rows that share an id
count as one document: what they share among them stays, and each row is cut by its own text. An
empty table gives an empty result. Further columns are dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import DOCUMENT_COLUMNS, column, hot_keys, map_texts
from casebook.session import stage

MIN_SENTENCES, MIN_WORDS = 2, 15
ANCHOR_WINDOW = 12

_END = re.compile(r"[.!?。！？…]+[^\w\s]*\s+|\s*\n\s*")
_WORD = re.compile(r"\S+")


def anchors(words: list[str], begins: list[int]) -> list[int]:
    """Places of the words that come first in some ``ANCHOR_WINDOW`` consecutive words: by whether a
    sentence begins there (``begins``), by CRC-32, the last of equal ones."""
    n = len(words)
    if n < ANCHOR_WINDOW:
        return []
    codes = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.int64, n) | 1 << 32
    codes[begins] &= 0xFFFFFFFF
    least, width = codes << 30 | np.arange(n - 1, -1, -1), 1
    while width < ANCHOR_WINDOW:
        step = min(width, ANCHOR_WINDOW - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    return (n - 1 - (np.unique(least) & 0x3FFFFFFF)).tolist()


def parts(text: str, words: list[str]) -> list[tuple[int, int]]:
    """(start in the text, place of the first word) of each part, and of the end of the last."""
    starts = [m.start() for m in _WORD.finditer(text)]
    n, breaks, begins = len(words), set(), []
    for m in _END.finditer(text):
        at = bisect_left(starts, m.end())
        breaks.add(at)
        if at < n and not m.group()[0].isspace():
            begins.append(at)
    breaks.update(anchors(words, begins))
    return [(0, 0), *((starts[i], i) for i in sorted(breaks - {0, n})), (len(text), n)]


def runs(text: str) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of the shortest sufficient run from each part."""
    from xxhash import xxh3_128_digest

    words = [w.lower() for w in text.split()]
    if len(words) < MIN_WORDS:
        return []
    bounds = parts(text, words)
    out, last = [], 0
    for first, (start, begin) in enumerate(bounds):
        while last < len(bounds) and (bounds[last][1] - begin < MIN_WORDS or last - first < MIN_SENTENCES):
            last += 1
        if last == len(bounds):
            break
        end, after = bounds[last]
        out.append((start, end, xxh3_128_digest(" ".join(words[begin:after]).encode("utf-8", "surrogatepass"))))
    return out


def run_table(keyed: DataFrame) -> DataFrame:
    """(doc_id, uid, hi, lo, span, again): a row per run; ``again`` marks repeats within the row's
    own text; ``span`` packs start and end as start * 2**32 + end."""
    def run(batch: pa.RecordBatch) -> pa.Table | None:
        rows, spans, again, digests = [], [], [], []
        for row, text in enumerate(column(batch, "text").to_pylist()):
            seen = set()
            for start, end, digest in runs(text):
                rows.append(row)
                spans.append(start << 32 | end)
                digests.append(digest)
                again.append(digest in seen)
                seen.add(digest)
        if not rows:
            return None
        halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
        at = pa.array(rows, pa.int32())
        return pa.table({"doc_id": column(batch, "doc_id").take(at), "uid": column(batch, "uid").take(at), "hi": np.ascontiguousarray(halves[:, 0]),
                         "lo": np.ascontiguousarray(halves[:, 1]), "span": pa.array(spans, pa.int64()), "again": pa.array(again, pa.bool_())})

    body = keyed.select("doc_id", "uid", "text").filter(F.col("text").isNotNull())
    return map_texts(body, run, "doc_id long, uid long, hi long, lo long, span long, again boolean")


def cuts(keyed: DataFrame) -> DataFrame:
    """(uid, doc_id, span): every occurrence of a repeated run but the first."""
    table = stage(run_table(keyed))
    heads = table.filter(~F.col("again"))
    repeated = stage(heads.groupBy("hi", "lo").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") > 1))
    hot = hot_keys(repeated, heads.count()).select("hi", "lo", F.col("first").alias("_hot"), F.lit(True).alias("_is_hot"))
    marked = heads.select("doc_id", "uid", "hi", "lo", "span").join(F.broadcast(hot), ["hi", "lo"], "left")
    of_hot = marked.filter(F.col("_is_hot") & ~F.col("doc_id").eqNullSafe(F.col("_hot")))
    of_rest = marked.filter(F.col("_is_hot").isNull()).select("uid", "hi", "lo", "span", "doc_id").join(
        repeated.select("hi", "lo", "first"), ["hi", "lo"]).filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    own = table.filter("again")
    pick = ["uid", "doc_id", "span"]
    return of_hot.select(pick).unionByName(of_rest.select(pick)).unionByName(own.select(pick))


def without(text: str, spans: list[int]) -> tuple[str, list[tuple[int, int]]]:
    """The text without its packed spans, and their union as disjoint (start, end)."""
    union: list[list[int]] = []
    for start, end in sorted((s >> 32, s & 0xFFFFFFFF) for s in spans):
        if union and start <= union[-1][1]:
            union[-1][1] = max(union[-1][1], end)
        else:
            union.append([start, end])
    kept, at = [], 0
    for start, end in union:
        kept.append(text[at:start])
        at = end
    return "".join([*kept, text[at:]]), [(a, b) for a, b in union]


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """The documents columns with cut texts and their new ``n_chars``, and ``cut_spans`` (string:
    start:end of the cuts in code points of the old text, comma-joined), ``cut_chars``."""
    keyed = docs.select(*DOCUMENT_COLUMNS).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("uid", F.xxhash64("doc_id", "text"))
    taken = cuts(keyed).groupBy("uid", "doc_id").agg(F.collect_list("span").alias("spans")).select(
        F.col("uid").alias("_uid"), F.col("doc_id").alias("_doc"), "spans")
    joined = keyed.join(taken, (F.col("uid") == F.col("_uid")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select(
        *DOCUMENT_COLUMNS, "spans")

    def run(batch: pa.RecordBatch) -> pa.Table:
        texts, sizes = column(batch, "text").to_pylist(), column(batch, "n_chars").to_pylist()
        cut_spans, cut_chars = [], []
        for row, spans in enumerate(column(batch, "spans").to_pylist()):
            union = []
            if spans:
                texts[row], union = without(texts[row], spans)
                sizes[row] = len(texts[row])
            cut_spans.append(",".join(f"{a}:{b}" for a, b in union))
            cut_chars.append(sum(b - a for a, b in union))
        return pa.table({"doc_id": column(batch, "doc_id"), "text": pa.array(texts, pa.string()), "lang": column(batch, "lang"),
                         "source": column(batch, "source"), "n_chars": pa.array(sizes, pa.int64()),
                         "cut_spans": pa.array(cut_spans, pa.string()), "cut_chars": pa.array(cut_chars, pa.int64())})

    return map_texts(joined.withColumn("n_chars", F.col("n_chars").cast("long")), run,
                     "doc_id long, text string, lang string, source string, n_chars long, cut_spans string, cut_chars long")
