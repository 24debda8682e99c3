"""Counterfactual-regularised toxicity classifier (operator 7).

A logistic model over the presence of character grams (3 to 6 bytes within a word and its edges) is
fitted to labelled documents. For each labelled document that names a group, a counterfactual text
is made by swapping the terms of every sentence that has one for those of another group of the same
kind; the fit penalises the squared difference of the two logits, ``PENALTY`` times. A weight that
merely says which group a text names costs more than it gains, so neutral mentions keep their score.

Plan: grams are counted over at most ``SAMPLE`` labelled training rows (those of least hash) in Spark,
the ``FEATURES`` most telling ones and all grams of identity terms reach the driver, the rows of the sample come back as short lists of
these, and the fit runs in numpy. Scoring is one narrow pass over all whole texts.

Nulls: a null text is empty; an empty text has no gram and scores what the intercept says. Labels that
are null, or of ids without a document, are not used; a repeated label counts as often as it stands.
Without labels of both classes every score is the smoothed share of the labels there are (0.5 of
none). An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import column, map_texts
from casebook.llm.wordvectors import fold, sample_of

#: Most labelled rows to learn from, most grams kept, documents that a gram must occur in, and standard
#: errors by which its share of toxic documents must differ from the share of all (among a million grams
#: a handful get there by chance; the decay keeps these small).
SAMPLE, FEATURES, LEAST_DOCS, LEAST_Z = 20_000, 4096, 3, 4.5
BUCKETS = 1 << 21
SIZES = (3, 4, 5, 6)
PENALTY, DECAY, STEPS = 1.0, 3e-4, 400
#: What a toxic text that is missed costs, in false alarms.
MISS_COST = 8.0

#: Kinds of groups; within a kind each term may stand for another (fixed values of this model).
IDENTITY_KINDS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"), ("she", "he"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"), ("africans", "europeans", "asians", "americans"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("immigrants", "natives", "refugees"), ("immigrant", "native", "refugee"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("mujeres", "hombres"), ("femmes", "hommes"),
)
_SWAP = {term: kind[(i + 1) % len(kind)] for kind in IDENTITY_KINDS for i, term in enumerate(kind)}
_TERM = re.compile(r"(?<!\w)(" + "|".join(sorted(map(re.escape, _SWAP), key=len, reverse=True)) + r")(?!\w)", re.IGNORECASE)

_KEEP = np.zeros(256, dtype=bool)
_KEEP[[*range(97, 123), *range(128, 256)]] = True
_TABLES = np.random.default_rng(29).integers(0, 1 << 63, size=(max(SIZES), 256), dtype=np.uint64)


def swapped(text: str) -> str:
    """The counterfactual: each identity term becomes the next of its kind, case of the first letter
    kept."""
    def other(m: re.Match) -> str:
        new = _SWAP[m.group().lower()]
        return new.capitalize() if m.group()[:1].isupper() else new

    return _TERM.sub(other, text)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every gram of the texts, repeats included."""
    raw = [t.lower().encode() for t in texts]
    bounds = np.cumsum([0] + [len(t) + 1 for t in raw])
    data = np.frombuffer(b" ".join([b"", *raw, b""]), dtype=np.uint8)  # a blank before each text and after the last
    inside = _KEEP[data]
    codes = np.where(inside, data, 32).astype(np.uint8)
    docs, buckets = [], []
    for size in SIZES:
        n = len(codes) - size + 1
        if n <= 0:
            continue
        # A gram may take in the edge of its word at either end, no blank between.
        whole = inside[1:1 + n].copy()
        for k in range(2, size - 1):
            whole &= inside[k:k + n]
        at = np.flatnonzero(whole)
        total = np.zeros(len(at), dtype=np.uint64)
        for k in range(size):
            total += _TABLES[k][codes[at + k]]
        docs.append(np.searchsorted(bounds, at + 1, side="right") - 1)
        buckets.append(((total ^ np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(43)).astype(np.int64))
    if not docs:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(docs), np.concatenate(buckets)


def present(texts: list[str], number: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, gram) pairs; ``number`` maps buckets to kept features, -1 for the rest."""
    doc, bucket = grams(texts)
    if number is not None:
        kept = number[bucket]
        doc, bucket = doc[kept >= 0], kept[kept >= 0].astype(np.int64)
    pairs = np.unique(doc * BUCKETS + bucket)
    return pairs // BUCKETS, pairs % BUCKETS


def _texts(batch: pa.RecordBatch) -> list[str]:
    return column(batch, "text").to_pylist()


def _body(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def telling_grams(train: DataFrame, features: int = FEATURES) -> np.ndarray:
    """Buckets whose presence tells most about the label, at most ``features``, and all grams of identity terms: what a
    swap changes is a feature, so the penalty acts on it, whether or not it tells anything here."""
    def count(batch: pa.RecordBatch) -> pa.Table | None:
        doc, bucket = present(_texts(batch))
        label = np.array(column(batch, "label").to_pylist(), dtype=np.int64)
        if not len(doc):
            return None
        held, of = np.unique(bucket, return_inverse=True)
        toxic = np.bincount(of, weights=label[doc]).astype(np.int64)
        return pa.table({"bucket": pa.array(held, pa.int32()), "n": pa.array(np.bincount(of), pa.int64()), "toxic": pa.array(toxic, pa.int64())})

    rows = map_texts(train, count, "bucket int, n long, toxic long", max_chars=2_000_000).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    size = train.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    total, toxic = size["n"], size["toxic"] or 0
    share = toxic / max(total, 1)
    error = F.sqrt(F.col("n") * share * (1 - share) * F.greatest(1 - F.col("n") / F.lit(max(total, 1)), F.lit(1e-9)))
    z = F.when(error > 0, F.abs(F.col("toxic") - F.col("n") * share) / error).otherwise(0.0)
    best = (rows.filter(F.col("n") >= LEAST_DOCS).withColumn("z", z).filter(F.col("z") >= LEAST_Z)
            .orderBy(F.col("z").desc(), "bucket").limit(features))
    named = np.unique(grams(list(_SWAP))[1]).tolist()
    return np.array(sorted({r["bucket"] for r in best.select("bucket").collect()} | set(named)), dtype=np.int64)


def fit(rows: list[list[int]], swaps: list[list[int] | None], y: np.ndarray, width: int, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam on the whole sample: log loss, plus ``penalty`` times the mean squared
    difference of the logits of texts and counterfactuals, plus weight decay."""
    def flat(lists):
        of = np.repeat(np.arange(len(lists)), [len(r) for r in lists])
        return of, np.array([f for r in lists for f in r], dtype=np.int64)

    doc, feature = flat(rows)
    paired = [i for i, s in enumerate(swaps) if s is not None]
    # The difference of the two texts: features of one and not the other, with their sign.
    plus, plus_f = flat([sorted(set(rows[i]) - set(swaps[i])) for i in paired])
    minus, minus_f = flat([sorted(set(swaps[i]) - set(rows[i])) for i in paired])
    cost = np.where(y == 1, MISS_COST, 1.0)
    share = np.clip(np.average(y, weights=cost), 1e-3, 1 - 1e-3)
    w, b = np.zeros(width), float(np.log(share / (1 - share)))
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    for step in range(1, STEPS + 1):
        logit = np.bincount(doc, weights=w[feature], minlength=len(y)) + b
        error = cost * (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y) / cost.sum()
        g = np.bincount(feature, weights=error[doc], minlength=width) + DECAY * w
        if paired:
            gap = np.bincount(plus, weights=w[plus_f], minlength=len(paired)) - np.bincount(minus, weights=w[minus_f], minlength=len(paired))
            pull = 2 * penalty * gap / len(paired)
            g = g + np.bincount(plus_f, weights=pull[plus], minlength=width) - np.bincount(minus_f, weights=pull[minus], minlength=width)
        gb = error.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.05 * (1 - (step - 1) / STEPS)
        fix = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        w = w - rate * fix * m / (np.sqrt(v) + 1e-8)
        b = b - rate * fix * mb / (np.sqrt(vb) + 1e-8)
    return w, b


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, penalty: float = PENALTY) -> DataFrame:
    """Contract rows: doc_id, held_out, score, predicted."""
    held_out = fold(F.col("doc_id"), 5) == 0
    chosen = sample_of(labels, "toxic", ~held_out, sample)
    # The sample is bounded by its size, so its ids may be broadcast to the texts.
    train = _body(docs).join(F.broadcast(chosen), "doc_id")
    kept = telling_grams(train)
    number = np.full(BUCKETS, -1, dtype=np.int16)
    number[kept] = np.arange(len(kept))

    def listed(batch: pa.RecordBatch) -> pa.Table:
        texts = _texts(batch)
        of = lambda ts: [f.tolist() for f in np.split(*_split(*present(ts, number), len(ts)))]
        own, named = of(texts), [bool(_TERM.search(t)) for t in texts]
        other = of([swapped(t) for t, n in zip(texts, named) if n]) if any(named) else []
        at = iter(other)
        return pa.table({"doc_id": column(batch, "doc_id"), "label": column(batch, "label"), "own": pa.array(own, pa.list_(pa.int32())),
                         "other": pa.array([next(at) if n else None for n in named], pa.list_(pa.int32()))})

    rows = map_texts(train, listed, "doc_id long, label int, own array<int>, other array<int>", max_chars=2_000_000).orderBy("doc_id", "label").collect()
    y = np.array([r["label"] for r in rows], dtype=float)
    share = (y.sum() + 1) / (len(y) + 2)
    weights, intercept = np.zeros(max(len(kept), 1)), float(np.log(share / (1 - share)))
    if len(set(y)) > 1 and len(kept):
        weights, intercept = fit([r["own"] for r in rows], [r["other"] for r in rows], y, len(kept), penalty)

    def score(batch: pa.RecordBatch) -> pa.Table:
        texts = _texts(batch)
        doc, feature = present(texts, number)
        logit = np.bincount(doc, weights=weights[feature], minlength=len(texts)) + intercept
        return pa.table({"doc_id": column(batch, "doc_id"), "score": 1 / (1 + np.exp(-np.clip(logit, -40, 40)))})

    scored = map_texts(_body(docs), score, "doc_id long, score double", max_chars=2_000_000)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _split(doc: np.ndarray, feature: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Arguments of ``np.split`` that part the features by document."""
    return feature, np.searchsorted(doc, np.arange(1, n)) if n else np.zeros(0, dtype=np.int64)
