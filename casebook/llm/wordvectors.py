"""Quality classifier: random-indexing word vectors and a two-layer network (operator 3).

1. Random indexing: every word and every word shape (case, length, marks attached, repeat of the
   word before) has a fixed sparse vector of signs, drawn by its hash. The vector of a unit is the
   sum of the sign vectors of the units around it in all documents: counts add up in partitions,
   then over the corpus, in a table of ``ROWS`` rows that does not grow with it.
2. Pooling: a document is the mean of the vectors of its units, over the whole text.
3. Network: pooled vectors of at most ``SAMPLE`` labelled training rows (those of least hash) fit a
   two-layer network in numpy; its logits are divided by a temperature that minimises the log loss on
   a fifth of the sample that training did not see.
4. Score: one narrow pass over all documents.

Nulls: a null text is empty; an empty text has the zero vector and the score that the network gives
it. Labels that are null, or of ids without a document, are not used; a repeated label counts as
often as it stands. Without labels of both classes every score is the smoothed share of the
labels there are (0.5 of none). An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import column, map_texts, slices
from casebook.llm.neural import calibrated, fit_network, logits

WORD_ROWS, SHAPE_ROWS, WIDTH = 1 << 14, 1 << 12, 32
ROWS = WORD_ROWS + SHAPE_ROWS
#: Most labelled rows to learn from.
SAMPLE = 20_000
PLACES = 1024


def _table(chars) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_BLANK = _table(b" \t\n\x0b\x0c\r")
_UPPER = _table(range(65, 91))
_LETTER = _table([*range(65, 91), *range(97, 123), *range(128, 256)])
_DIGIT = _table(range(48, 58))
_RNG = np.random.default_rng(23)
_WEIGHTS = _RNG.integers(1, 1 << 63, size=PLACES, dtype=np.uint64) | np.uint64(1)
#: Two signed places for each row: its random index vector.
_SLOT = _RNG.integers(0, WIDTH, size=(2, ROWS))
_SIGN = _RNG.choice([-1.0, 1.0], size=(2, ROWS))


def units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, word row, shape row) of every word of the texts."""
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    turns = np.flatnonzero(np.diff(np.concatenate(([True], _BLANK[data], [True])).astype(np.int8)))
    starts, ends = turns[0::2], turns[1::2]
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    sizes = ends - starts
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    place = np.arange(total) - np.repeat(first, sizes)
    chars = data[place + np.repeat(starts, sizes)]
    hashes = np.add.reduceat((chars.astype(np.uint64) + np.uint64(1)) * _WEIGHTS[place & (PLACES - 1)], first)
    count = lambda mask: np.add.reduceat(mask.astype(np.int32), first)
    letters, upper, digits = count(_LETTER[chars]), count(_UPPER[chars]), count(_DIGIT[chars])
    marks = sizes - letters - digits
    doc = np.searchsorted(bounds, starts, side="right") - 1
    again = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])))
    case = np.where(upper == 0, 0, np.where(upper == 1, 1, np.where(upper >= letters, 2, 3)))
    last = data[ends - 1].astype(np.int64)
    ending = np.where(_LETTER[last], 0, np.where(_DIGIT[last], 1, last))
    shape = ((((case * 4 + np.minimum(marks, 3)) * 2 + (digits > 0)) * 2 + again) * 6 + np.minimum(letters // 3, 5)) * 256 + ending
    mixed = lambda x: (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return doc, (mixed(hashes) % np.uint64(WORD_ROWS)).astype(np.int64), WORD_ROWS + (mixed(shape.astype(np.uint64) + np.uint64(1)) % np.uint64(SHAPE_ROWS)).astype(np.int64)


def context_sums(texts: list[bytes], table: np.ndarray) -> None:
    """Adds to ``table`` (ROWS, WIDTH) the sign vectors of the units (words and shapes) around each unit,
    two places to either side."""
    doc, word, shape = units(texts)
    flat = table.reshape(-1)
    for step in (1, 2):
        near = np.flatnonzero(doc[step:] == doc[:-step]) if len(doc) > step else np.zeros(0, dtype=np.int64)
        sides = [(rows[near], rows[near + step]) for rows in (word, shape)]
        for here, there in ((0, 1), (1, 0)):
            bases = [side[here] * WIDTH for side in sides]
            for its in (side[there] for side in sides):
                for slot, sign in zip(_SLOT, _SIGN):
                    place, weight = slot[its], sign[its]
                    for base in bases:
                        flat += np.bincount(base + place, weights=weight, minlength=ROWS * WIDTH)


def corpus_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors (ROWS, WIDTH) from all documents. Tasks hold one table each and hand on its rows that
    are not zero; the driver gets the sums, of the table's size."""
    def run(batches):
        table = np.zeros((ROWS, WIDTH))  # whole numbers, exact
        for batch in batches:
            for part in slices(batch, 8_000_000):
                context_sums(_bytes(part), table)
        held = np.flatnonzero(table.any(axis=1))
        if len(held):
            yield pa.record_batch({"row": pa.array(held, pa.int32()), **{f"v{k}": pa.array(table[held, k].astype(np.int64)) for k in range(WIDTH)}})

    names = [f"v{k}" for k in range(WIDTH)]
    parts = _body(docs).mapInArrow(run, "row int, " + ", ".join(f"{n} long" for n in names))
    sums = parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    out = np.zeros((ROWS, WIDTH))
    for row in sums.collect():  # at most ROWS rows
        out[row["row"]] = row[1:]
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.maximum(size, 1e-9)).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """(texts, 2 WIDTH + 1): means of word and of shape vectors, and log of the number of words."""
    doc, word, shape = units(texts)
    out = np.zeros((len(texts), 2 * WIDTH + 1), dtype=np.float32)
    held, first, n = np.unique(doc, return_index=True, return_counts=True)
    if len(held):
        for at, rows in ((0, word), (WIDTH, shape)):
            out[held, at:at + WIDTH] = np.add.reduceat(vectors[rows], first, axis=0) / n[:, None]
        out[held, -1] = np.log1p(n) / 8
    return out


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [t.encode() for t in column(batch, "text").to_pylist()]


def _body(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def fold(doc_id: Column, parts: int) -> Column:
    """CRC-32 of the id as text, modulo ``parts``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def sample_of(labels: DataFrame, label: str, training: Column, size: int) -> DataFrame:
    """At most ``size`` (doc_id, label) rows that may be learnt from, those of least hash."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    return rows.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & training).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(size)


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Contract rows: doc_id, held_out, score, predicted."""
    held_out = fold(F.col("doc_id"), 3) == 1
    vectors = corpus_vectors(docs)
    chosen = sample_of(labels, "quality", ~held_out, sample)

    def features(batch: pa.RecordBatch) -> pa.Table:
        rows = pooled(_bytes(batch), vectors)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1)), rows.shape[1]).cast(pa.list_(pa.float32()))
        return pa.table({"doc_id": column(batch, "doc_id"), "label": column(batch, "label"), "x": flat})

    # The sample is bounded by its size, so its ids may be broadcast to the texts.
    train = map_texts(_body(docs).join(F.broadcast(chosen), "doc_id"), features, "doc_id long, label int, x array<float>").orderBy("doc_id", "label").collect()
    y = np.array([r["label"] for r in train], dtype=float)
    model = temperature = None
    if len(set(y)) > 1:
        x = np.array([r["x"] for r in train], dtype=np.float64)
        spare = np.arange(len(y)) % 5 == 4
        model = fit_network(x[~spare], y[~spare])
        temperature = calibrated(logits(model, x[spare]), y[spare])
    share = (y.sum() + 1) / (len(y) + 2)

    def score(batch: pa.RecordBatch) -> pa.Table:
        if model is None:
            p = np.full(batch.num_rows, share)
        else:
            p = 1 / (1 + np.exp(-np.clip(logits(model, pooled(_bytes(batch), vectors)) / temperature, -40, 40)))
        return pa.table({"doc_id": column(batch, "doc_id"), "score": p})

    scored = map_texts(_body(docs), score, "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
