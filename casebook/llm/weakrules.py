"""Quality rules under weak supervision (operator 4).

Each rule votes good or bad on a document, or abstains where its measure says little. The rules'
accuracies are not set by hand: expectation-maximisation (Dawid and Skene's model; a rule that
abstains says nothing) estimates from the votes of all documents how often each rule votes right on
good and on bad documents, and from that the probability that a document is good. That posterior
decides, in place of "all rules must pass".

Plan: one narrow pass measures every whole text; the votes are grouped by their pattern, of which
there are at most 3 ** rules whatever the corpus, and only that histogram reaches the driver, where
the iterations run. No label is used.

Nulls: a null text has no words, fails the base rule and is not kept; a null id is kept as it is.
Rows are independent. An empty table gives an empty result (and no estimate is made). Further
columns are ignored; ``keep_good`` returns the documents columns.

Equality of words, windows and lines within a text is decided by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import DOCUMENT_COLUMNS, column, map_texts
from casebook.session import stage

WINDOW_WORDS = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
BAD, GOOD, ABSTAIN = 0, 1, 2
PLACES = 4096

#: (name, measure, good from, good to, bad below, bad above, least words): a vote is good within
#: [from, to], bad outside [below, above], else no vote; none under the least number of words.
RULES = (
    ("length", "n_words", 50, np.inf, 20, np.inf, 0),
    ("word_length", "mean_word", 2.5, 9.0, 1.5, 14.0, 5),
    ("symbols", "symbol_share", 0.0, 0.02, 0.0, 0.05, 5),
    ("duplicate_lines", "dup_line_share", 0.0, 0.05, 0.0, 0.30, 5),
    ("repeats", "repeat_share", 0.0, 0.10, 0.0, 0.30, 16),
    ("upper_case", "upper_share", 0.0, 0.15, 0.0, 0.40, 5),
    ("punctuation", "punct_share", 0.0, 0.06, 0.0, 0.09, 5),
    ("sentences", "stop_share", 0.02, 0.40, 0.005, 0.60, 40),
    ("digits", "digit_share", 0.0, 0.10, 0.0, 0.30, 5),
)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_BLANK = _table(b" \t\n\x0b\x0c\r")
_SYMBOL = _table(b"#*$%&|<>")
_UPPER = _table(bytes(range(65, 91)))
_ASCII_LETTER = _table(bytes([*range(65, 91), *range(97, 123)]))
_DIGIT = _table(b"0123456789")
_PUNCT = _table(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_STOP = _table(b".!?")
_RANDOM = np.random.default_rng(11).integers(1, 1 << 63, size=(3, PLACES), dtype=np.uint64) | np.uint64(1)


def _scramble(x: np.ndarray) -> np.ndarray:
    """A mixing of 64 bits that is not linear (multiplications and shifts)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _hash_runs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs data[start : start + size]; runs do not overlap and ascend.

    A run is hashed in blocks of PLACES bytes, a weight for each place. The weights are the same in every
    block, so the sum of a block is scrambled together with its number before the blocks are added up."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    blocks = (sizes + PLACES - 1) // PLACES
    of = np.cumsum(blocks) - blocks
    number = np.arange(int(blocks.sum())) - np.repeat(of, blocks)
    begin = np.repeat(starts, blocks) + number * PLACES
    held = np.minimum(np.repeat(sizes, blocks) - number * PLACES, PLACES)
    first = np.cumsum(held) - held
    place = np.arange(int(held.sum())) - np.repeat(first, held)
    value = data[place + np.repeat(begin, held)].astype(np.uint64) + np.uint64(1)
    value *= weights[place]
    sums = _scramble(np.add.reduceat(value, first) + number.astype(np.uint64) * weights[2])
    return np.add.reduceat(sums, of) + sizes.astype(np.uint64) * weights[1]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is the key found twice or more, is it one that an earlier row has)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.concatenate(([False], ordered[1:] == ordered[:-1])) if len(keys) else np.zeros(0, dtype=bool)
    twice = same | np.concatenate((same[1:], [False]))
    found, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    found[order], later[order] = twice, same
    return found, later


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measures of each text, as arrays."""
    n = len(texts)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    per = lambda mask: np.add.reduceat(mask, bounds[:-1], dtype=np.int64) if n else np.zeros(0, dtype=np.int64)
    blank = _BLANK[data]
    turns = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    starts, ends = turns[0::2], turns[1::2]
    doc = np.searchsorted(bounds, starts, side="right") - 1
    count = lambda rows, **kw: np.bincount(rows, minlength=n, **kw)
    out = {"n_words": count(doc), "word_chars": per(~blank & ((data & 0xC0) != 0x80)), "n_symbols": per(_SYMBOL[data])}
    key = doc.astype(np.uint64) * _RANDOM[2, 0]

    # Words in windows that occur twice or more in their text.
    words = _hash_runs(data, starts, ends - starts, _RANDOM[0])
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    if len(words) >= WINDOW_WORDS:
        last = len(words) - WINDOW_WORDS + 1
        window = sum(words[k:k + last] * _RANDOM[1, k] for k in range(WINDOW_WORDS))
        window ^= window >> np.uint64(29)
        inside = np.flatnonzero(doc[:last] == doc[WINDOW_WORDS - 1:])
        twice = inside[_repeats(window[inside] + key[inside])[0]]
        covered[:last] += np.bincount(twice, minlength=last)[:last]
        covered[WINDOW_WORDS:] -= np.bincount(twice, minlength=last)[:last]
    out["n_repeat_words"] = count(doc, weights=np.cumsum(covered)[:-1] > 0).astype(np.int64) if len(words) else np.zeros(n, dtype=np.int64)

    # Lines that hold a word and equal an earlier line of their text.
    line_ends = np.flatnonzero(data == 10)
    line_starts = np.concatenate(([0], line_ends[:-1] + 1))
    held = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[held], line_ends[held]
    line_doc = np.searchsorted(bounds, line_starts, side="right") - 1
    lines = _hash_runs(data, line_starts, line_ends - line_starts, _RANDOM[0])
    later = _repeats(lines + line_doc.astype(np.uint64) * _RANDOM[2, 0])[1] if len(lines) else np.zeros(0, dtype=bool)
    out["n_dup_lines"] = count(line_doc, weights=later).astype(np.int64) if len(lines) else np.zeros(n, dtype=np.int64)

    n_lines, letters = count(line_doc), per(_ASCII_LETTER[data])
    stops = np.bincount(doc, weights=_STOP[data[ends - 1]], minlength=n) if len(ends) else np.zeros(n)
    share = lambda a, b: a / np.maximum(b, 1)
    out |= {"mean_word": share(out["word_chars"], out["n_words"]), "symbol_share": share(out["n_symbols"], out["word_chars"]),
            "dup_line_share": share(out["n_dup_lines"], n_lines), "repeat_share": share(out["n_repeat_words"], out["n_words"]),
            "upper_share": share(per(_UPPER[data]), letters), "punct_share": share(per(_PUNCT[data]), out["word_chars"]),
            "stop_share": share(stops, out["n_words"]), "digit_share": share(per(_DIGIT[data]), out["word_chars"])}
    return out


def votes(measures: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, rules) of BAD, GOOD, ABSTAIN."""
    out = []
    for _, name, low, high, below, above, least in RULES:
        x = measures[name]
        vote = np.where((x >= low) & (x <= high), GOOD, np.where((x < below) | (x > above), BAD, ABSTAIN))
        out.append(np.where(measures["n_words"] >= least, vote, ABSTAIN))
    return np.stack(out, axis=1) if out else np.zeros((0, 0), dtype=np.int64)


def pattern(voted: np.ndarray) -> np.ndarray:
    return voted @ (3 ** np.arange(voted.shape[1], dtype=np.int64))


def posterior(histogram: dict[int, int], n_rules: int = len(RULES), rounds: int = 200) -> dict[int, float]:
    """Pattern -> probability that such a document is good. Estimates start from the share of good
    votes among those given and are kept off 0 and 1 by a few imagined votes that side with the
    rule, so that classes cannot swap and no rule becomes certain."""
    if not histogram:
        return {}
    codes = np.array(sorted(histogram), dtype=np.int64)
    weight = np.array([histogram[int(c)] for c in codes], dtype=float)
    voted = (codes[:, None] // 3 ** np.arange(n_rules)) % 3
    one = np.stack([voted == v for v in (BAD, GOOD)], axis=2).astype(float)  # pattern, rule, vote
    given = np.maximum((voted != ABSTAIN).sum(axis=1), 1)
    good = np.where((voted == BAD).any(axis=1), 0.5 * (voted == GOOD).sum(axis=1) / given, 0.95)
    prior = np.array([[3.0, 1.0], [1.0, 3.0]])  # bad and good votes on bad, on good documents
    for _ in range(rounds):
        rate, log_like = [], []
        for k, belief in enumerate((1 - good, good)):
            mass = np.einsum("p,prv->rv", weight * belief, one) + prior[k]
            rate.append(float((weight * belief).sum()) + 1.0)
            log_like.append(np.einsum("prv,rv->p", one, np.log(mass / mass.sum(axis=1, keepdims=True))))
        gap = (log_like[1] + np.log(rate[1])) - (log_like[0] + np.log(rate[0]))
        nxt = 1 / (1 + np.exp(-np.clip(gap, -60, 60)))
        if np.abs(nxt - good).max() < 1e-9:
            good = nxt
            break
        good = nxt
    return {int(c): float(g) for c, g in zip(codes, good)}


def base_failed(m: dict[str, np.ndarray]) -> np.ndarray:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode() for t in column(batch, "text").to_pylist()]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, the five counts, base_failed, pattern); a narrow pass."""
    def run(batch: pa.RecordBatch) -> pa.Table:
        m = measure(_bytes(batch))
        return pa.table({"doc_id": column(batch, "doc_id"), **{c: m[c].astype(np.int64) for c in COUNTS},
                         "base_failed": base_failed(m), "pattern": pattern(votes(m))})

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(body, run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, pattern long")


def judge(patterns: DataFrame) -> dict[int, float]:
    """Estimates over a table with a ``pattern`` column; reads at most 3 ** rules rows."""
    return posterior({r["pattern"]: r["n"] for r in patterns.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()})


def quality_rules(docs: DataFrame) -> DataFrame:
    """Contract rows: doc_id, the counts, base_failed, kept; and the posterior ``quality``."""
    made = stage(measured(docs))
    good = docs.sparkSession.createDataFrame(list(judge(made).items()), "pattern long, quality double")
    return made.join(F.broadcast(good), "pattern").select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("quality") >= 0.5)).alias("kept"), "quality")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents columns of the documents kept. Every text is measured once: its votes are staged beside it, and
    the histogram of the votes says which rows stay."""
    def run(batch: pa.RecordBatch) -> pa.Table:
        m = measure(_bytes(batch))
        table = pa.Table.from_batches([batch]).select(DOCUMENT_COLUMNS)
        return table.append_column("_pattern", pa.array(pattern(votes(m)))).append_column("_failed", pa.array(base_failed(m)))

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.col("lang"), F.col("source"), F.col("n_chars").cast("long").alias("n_chars"))
    made = stage(map_texts(body, run, "doc_id long, text string, lang string, source string, n_chars long, _pattern long, _failed boolean"))
    good = [p for p, q in judge(made.select(F.col("_pattern").alias("pattern"))).items() if q >= 0.5]
    kept = docs.sparkSession.createDataFrame([(p,) for p in good], "_pattern long")  # at most 3 ** rules rows
    return made.filter(~F.col("_failed")).join(F.broadcast(kept), "_pattern", "left_semi").select(*DOCUMENT_COLUMNS)
