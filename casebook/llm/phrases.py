"""Phrase collocations by Rabin-Karp fingerprints (operator 13).

1. *Slices.* Texts are lower-cased (A-Z), cut into pieces and words, and packed, language by language, into slices of
   about ``SLICE_BYTES``: one space between words, one line end between pieces. Slices are staged once, compressed; their
   number is the occurrence pointer of everything below.
2. *Fingerprints.* In a slice, prefix polynomials modulo two primes (numpy, one pass over the bytes) give the hash of
   every run of 1 to ``LONGEST`` words of a piece by one subtraction. Equal ones are counted in the slice. Fingerprints
   are as wide as the corpus needs (``SPARE_BITS`` more than its length has), since texts decide in the end.
3. *Counting.* The sorted fingerprints are cut into ranges; a shuffle brings each range together from all slices and adds
   up. Fingerprints found ``LEAST`` times or more go back, by their pointers, to every slice that holds them.
4. *Verification.* Those slices read the words behind the fingerprints and count them by text. Counts per text are
   what is used from here on, so two phrases that share a fingerprint are told apart, and one that only seemed
   frequent falls out. No other phrase is ever turned into text.
5. *Scores.* Phrases join the counts of their parts and the longer phrases around them; whole-number arithmetic in
   DECIMAL(38). A language's best rows are ranked in salted parts first.

Nulls: a null text has no words, a null language is ``und`` (and so joins a language of that name), other columns are
ignored. Repeated rows count as often as they stand there. An empty table gives an empty result. A text of any length
is cut between pieces; one piece stays whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import column, slices as text_slices
from casebook.session import stage

LONGEST, LEAST = 3, 10
TOP = 2000
CONTAINED_PERCENT = 50
SCALE = 1_000_000
SLICE_BYTES = 4_000_000
#: Bytes of slices whose fingerprints make one range (about 0.8 fingerprints a byte before counting).
RANGE_BYTES = 8_000_000
SPARE_BITS = 8
#: Parts of a language in which its best rows are sought first.
PARTS = 32

#: The two primes below 2 ** 31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1566083941)

_SPACE, _LINE = 32, 10
_PLAIN = bytearray(range(256))
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _PLAIN[_c] = _c + 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _PLAIN[_c] = _LINE
_PLAIN[9] = _SPACE
_PLAIN = bytes(_PLAIN)


# ---------------------------------------------------------------- slices

def packed(text: bytes) -> tuple[bytes, int]:
    """Lower-cased words with one space between words and one line end between pieces; and how many words."""
    data = np.frombuffer(text.translate(_PLAIN), dtype=np.uint8)
    word = (data != _SPACE) & (data != _LINE)
    turns = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    starts, ends = turns[0::2], turns[1::2]
    if not len(starts):
        return b"", 0
    lines = np.concatenate(([0], np.cumsum(data == _LINE)))
    between = np.where(lines[starts[1:]] > lines[ends[:-1]], _LINE, _SPACE).astype(np.uint8)
    out = np.empty(int((ends - starts).sum()) + len(starts), dtype=np.uint8)
    stops = np.cumsum(ends - starts + 1) - 1
    keep = np.ones(len(out), dtype=bool)
    keep[stops] = False
    out[keep] = data[word]
    out[stops[:-1]] = between
    out[stops[-1]] = _LINE
    return out.tobytes(), len(starts)


def in_slices(docs: DataFrame, size: int = SLICE_BYTES) -> DataFrame:
    """(slice, lang, words, size, body), staged: ``body`` holds ``size`` bytes, ends with a line end and is compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            text = b"\n".join(held.pop(lang))
            sizes.pop(lang)
            while text:
                cut = len(text) if len(text) <= 2 * size else (text.find(b"\n", size) + 1 or len(text))
                body, words = packed(text[:cut])
                if words:
                    yield pa.RecordBatch.from_pydict({"lang": [lang], "words": [words], "size": [len(body)], "body": [pa.compress(body, "zstd", asbytes=True)]}, schema)
                text = text[cut:]

        schema = pa.schema([("lang", pa.string()), ("words", pa.int64()), ("size", pa.int64()), ("body", pa.binary())])
        for batch in batches:
            for part in text_slices(batch, size):
                for lang, text in zip(column(part, "lang").to_pylist(), column(part, "text").to_pylist()):
                    held.setdefault(lang, []).append(text.encode())
                    sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1]) + 1
                    if sizes[lang] >= size:
                        yield from flush(lang)
                while sum(sizes.values()) > 4 * size:  # many small languages
                    yield from flush(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from flush(lang)

    body = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text")).filter("text is not null and text != ''")
    made = body.mapInArrow(run, "lang string, words long, size long, body binary")
    return stage(made.select(F.monotonically_increasing_id().alias("slice"), "*"))


# ---------------------------------------------------------------- fingerprints

def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo prime."""
    out = np.ones(1, dtype=np.uint64)
    step = base % prime
    while len(out) < n:
        out = np.concatenate((out, out * np.uint64(step) % np.uint64(prime)))
        step = step * step % prime
    return out[:n]


_LOW = 12


def power_of(exponents: np.ndarray, base: int, prime: int, most: int) -> np.ndarray:
    """base ** exponents modulo prime, by a table of the low bits and one of the high bits."""
    low, high = powers(base, prime, 1 << _LOW), powers(pow(base, 1 << _LOW, prime), prime, (most >> _LOW) + 1)
    return low[exponents & ((1 << _LOW) - 1)] * high[exponents >> _LOW] % np.uint64(prime)


def prefixes(data: np.ndarray, base: int, prime: int) -> np.ndarray:
    """Sums of (byte + 1) * base ** place before each place; not reduced (2 ** 32 terms below 2 ** 31 fit)."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    block = 1 << 18
    table = powers(base, prime, block)
    for at in range(0, len(data), block):
        part = data[at:at + block].astype(np.uint64) + np.uint64(1)
        part *= table[:len(part)] * np.uint64(pow(base, at, prime)) % np.uint64(prime)
        part %= np.uint64(prime)
        np.cumsum(part, out=out[at + 1:at + 1 + len(part)])
        out[at + 1:at + 1 + len(part)] += out[at]
    return out


def lang_key(lang: str) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh64_intdigest(lang, seed=13))


def unpacked(body: pa.Scalar, size: pa.Scalar) -> bytes:
    return pa.decompress(body.as_buffer(), size.as_py(), "zstd", asbytes=True)


def grams(body: bytes, lang: str, longest: int = LONGEST, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, first byte, byte after the last, words) of every run of 1 to ``longest`` words of a piece."""
    data = np.frombuffer(body, dtype=np.uint8)
    ends = np.flatnonzero((data == _SPACE) | (data == _LINE))
    starts = np.concatenate(([0], ends[:-1] + 1))
    piece = np.concatenate(([0], np.cumsum(data[ends] == _LINE)[:-1]))
    first, last = [starts], [ends]
    for n in range(2, longest + 1):
        inside = np.flatnonzero(piece[n - 1:] == piece[:len(piece) - n + 1])
        first.append(starts[inside])
        last.append(ends[inside + n - 1])
    words = np.repeat(np.arange(1, longest + 1, dtype=np.int8), [len(x) for x in first])
    keys = [np.zeros(len(x), dtype=np.uint64) for x in first]
    for prime, base in zip(PRIMES, BASES):
        p, prefix, inverse = np.uint64(prime), prefixes(data, base, prime), pow(base, -1, prime)
        for key, a, b in zip(keys, first, last):
            run = (prefix[b] - prefix[a]) % p
            run *= power_of(a, inverse, prime, len(data))
            run %= p
            key <<= np.uint64(31)
            key |= run
    key = np.concatenate(keys)
    key += lang_key(lang)
    key *= np.uint64(0x9E3779B97F4A7C15)
    key >>= np.uint64(64 - bits)
    return key, np.concatenate(first), np.concatenate(last), words


def _blob(fingerprints: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte plane by byte plane (the upper planes are nearly all zero)."""
    return np.diff(fingerprints, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unblob(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def counted(slices: DataFrame, ranges: int, longest: int, bits: int) -> DataFrame:
    """(range, slice, keys, counts): each slice's distinct fingerprints, cut into ranges."""
    edges = np.array([(r << bits) // ranges for r in range(1, ranges)], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, lang, size, body in zip(*(column(batch, c) for c in ("slice", "lang", "size", "body"))):
                found, n = np.unique(grams(unpacked(body, size), lang.as_py(), longest, bits)[0], return_counts=True)
                cuts = np.concatenate(([0], np.searchsorted(found, edges), [len(found)]))
                at = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_pydict({
                    "range": pa.array(at, pa.int32()), "slice": pa.array([number.as_py()] * len(at), pa.int64()),
                    "keys": pa.array([_blob(found[cuts[i]:cuts[i + 1]]) for i in at], pa.binary()),
                    "counts": pa.array([n[cuts[i]:cuts[i + 1]].astype(np.uint32).tobytes() for i in at], pa.binary())})

    return slices.mapInArrow(run, "range int, slice long, keys binary, counts binary")


def frequent(parts: DataFrame, ranges: int, least: int) -> DataFrame:
    """(slice, keys): the fingerprints of the slice that all slices together hold ``least`` times or more."""
    def run(group: pa.Table) -> pa.Table:
        keys = [_unblob(b.as_py()) for b in group.column("keys")]
        counts = np.concatenate([np.frombuffer(b.as_py(), dtype=np.uint32) for b in group.column("counts")])
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        total = np.add.reduceat(counts[order].astype(np.int64), begin)
        wanted = np.zeros(len(every), dtype=bool)
        wanted[order] = np.repeat(total >= least, np.diff(np.append(begin, len(every))))
        out, at = [], 0
        for number, own in zip(group.column("slice").to_pylist(), keys):
            held = own[wanted[at:at + len(own)]]
            at += len(own)
            if len(held):
                out.append((number, _blob(held)))
        return pa.table({"slice": pa.array([s for s, _ in out], pa.int64()), "keys": pa.array([b for _, b in out], pa.binary())})

    return parts.repartition(ranges, "range").groupBy("range").applyInArrow(run, "slice long, keys binary")


def read_back(slices: DataFrame, wanted: DataFrame, ranges: int, longest: int, bits: int) -> DataFrame:
    """(range, lang, size, phrases, counts): the wanted runs of each slice by their text, sorted and compressed, in the
    ranges of their fingerprints (so that a phrase is in the same range everywhere)."""
    edges = np.array([(r << bits) // ranges for r in range(1, ranges)], dtype=np.uint64)
    schema = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("size", pa.int64()), ("phrases", pa.binary()), ("counts", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        keys = np.sort(np.concatenate([_unblob(b.as_py()) for b in right.column("keys")]))
        lang, body = left.column("lang")[0].as_py(), unpacked(left.column("body")[0], left.column("size")[0])
        own, first, last, words = grams(body, lang, longest, bits)
        place = np.searchsorted(keys, own)
        hit = keys[np.minimum(place, len(keys) - 1)] == own
        parts = []
        for n in range(1, longest + 1):
            here = np.flatnonzero(hit & (words == n))
            coded = _texts(body, first[here], last[here]).dictionary_encode()
            number = coded.indices.to_numpy()
            seen = np.zeros(len(coded.dictionary), dtype=np.int64)
            seen[number[::-1]] = here[::-1]  # the first occurrence of each text
            parts.append(pa.table({"range": np.searchsorted(edges, own[seen], side="right").astype(np.int32), "phrase": coded.dictionary,
                                   "n": np.bincount(number, minlength=len(seen)).astype(np.uint32)}))
        found = pa.concat_tables(parts).sort_by([("range", "ascending"), ("phrase", "ascending")])
        at, counts = found.column("range").to_numpy(), found.column("n").to_numpy()
        cuts = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
        out = []
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            text = "\n".join(found.column("phrase").slice(i, j - i).to_pylist()).encode()
            out.append((int(at[i]), lang, len(text), pa.compress(text, "zstd", asbytes=True), counts[i:j].tobytes()))
        return pa.table({f.name: pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)}, schema)

    return slices.groupBy("slice").cogroup(wanted.groupBy("slice")).applyInArrow(run, "range int, lang string, size long, phrases binary, counts binary")


def summed(parts: DataFrame, ranges: int, least: int) -> DataFrame:
    """(lang, phrase, f): the counts of every text over all slices, where they reach ``least``."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def run(key: tuple, group: pa.Table) -> pa.Table:
        texts, counts = [], []
        for size, body, n in zip(*(group.column(c) for c in ("size", "phrases", "counts"))):
            texts += unpacked(body, size).decode().split("\n")
            counts.append(np.frombuffer(n.as_py(), dtype=np.uint32).astype(np.int64))
        total = pa.table({"phrase": pa.array(texts, pa.string()), "n": np.concatenate(counts)}).group_by("phrase").aggregate([("n", "sum")])
        total = total.filter(pa.compute.greater_equal(total.column("n_sum"), least))
        return pa.table({"lang": pa.repeat(key[1], len(total)), "phrase": total.column("phrase"), "f": total.column("n_sum")}, schema)

    return parts.repartition(ranges, "range").groupBy("range", "lang").applyInArrow(run, "lang string, phrase string, f long")


def _texts(body: bytes, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """The byte runs as strings, gathered in one step."""
    sizes = last - first
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    place = np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], sizes)
    data = np.frombuffer(body, dtype=np.uint8)[place]
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())).cast(pa.string())


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of all runs found ``least`` times or more, staged; (lang, n) of all words)."""
    slices = in_slices(docs)
    size = slices.agg(F.sum("size").alias("n")).first()["n"] or 0
    ranges = 1 + size // RANGE_BYTES
    bits = min(62, size.bit_length() + SPARE_BITS)
    wanted = frequent(counted(slices, ranges, longest, bits), ranges, least)
    found = summed(read_back(slices, wanted, ranges, longest, bits), ranges, least)
    words = F.length("phrase") - F.length(F.replace(F.col("phrase"), F.lit(" "), F.lit(""))) + 1
    return stage(found.select("lang", "phrase", words.cast("int").alias("words"), "f")), slices.groupBy("lang").agg(F.sum("words").alias("n"))


# ---------------------------------------------------------------- scores

def _words(phrase: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, k, score) of the phrases of two words or more: the cut that scores least."""
    cuts = counts.filter("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    # The parts are join keys only: they are read off the phrase and do not travel beside it.
    side = lambda name: counts.select(F.col("lang").alias(f"_{name}_lang"), F.col("phrase").alias(f"_{name}"), F.col("f").alias(name))
    left, right = _words(F.col("phrase"), F.lit(1), F.col("k")), _words(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k"))
    sides = cuts.join(side("l"), (F.col("lang") == F.col("_l_lang")) & (left == F.col("_l"))).drop("_l", "_l_lang")
    sides = sides.join(side("r"), (F.col("lang") == F.col("_r_lang")) & (right == F.col("_r"))).drop("_r", "_r_lang")
    whole = lambda c: f"cast({c} as decimal(16, 0))"
    score = F.expr(f"cast({whole('a')} * {whole('a')} * {SCALE} as decimal(38, 0)) div ({whole('l')} * {whole('r')})").cast("long")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    best = sides.groupBy("lang", "phrase", "words", "a").agg(least.alias("b"))
    return best.select("lang", "phrase", "words", "a", "b.l", "b.r", "b.k", "b.score")


def not_contained(candidates: DataFrame, percent: int = CONTAINED_PERCENT) -> DataFrame:
    """Without phrases that stand inside a longer one found at least ``percent`` as often."""
    inside = candidates.filter("words >= 3").select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("_n"))
    inside = inside.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_n") + 1)).alias("_from"))
    around = inside.select("lang", _words(F.col("phrase"), F.col("_from"), F.col("_n")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_around"))
    return candidates.join(around, ["lang", "phrase"], "left").filter(
        F.col("_around").isNull() | (F.col("_around") * 100 < F.col("a") * percent)).drop("_around")


def best_phrases(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """Adds ``rank`` and keeps each language's first ``top``: first in parts by hash, then among those left."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    part = candidates.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    few = part.withColumn("rank", ranked("lang", "_part")).filter(F.col("rank") <= top)
    return few.withColumn("rank", ranked("lang")).filter(F.col("rank") <= top).drop("_part")


def mine_phrases(docs: DataFrame) -> DataFrame:
    """Contract rows: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = phrase_counts(docs)
    best = best_phrases(not_contained(stage(scored(counts))))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n").cast("long").alias("n"), "score")
