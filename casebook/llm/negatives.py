"""Hard-negative mining by vertical scans (operator 12; the BOND method).

Vectors are held by columns, one per dimension. For an anchor, the columns are read in descending order of the
anchor's own components, a few at a time, adding to the candidates' partial inner products. What the columns not yet
read can still add lies between the sums of the smaller and of the larger products of the anchor's components with
each column's least and greatest value; these bounds strike candidates off the bitmap:

* nearest rows of the same label (positives): a candidate whose upper bound is under the k-th largest lower bound;
* score windows (negatives): a candidate outside every window, or under the k-th largest lower bound of those that
  surely lie in the window.

Whoever is left after the last column has its exact score, from which the best are taken.

Plan: rows are dealt to cells of about ``ROW_CELL``, anchors to cells of about ``ANCHOR_CELL``, and each pair of cells
is one bounded group that works alone (a stated set of queries against all rows, in blocks). A pair returns the best
k of its cell only; the best over all cells follow by rank. Nothing is collected or broadcast.

Rows with a null label, a null vector, or a null or non-finite component take no part. A null id is kept and orders
after all others; it is never an anchor. Rows that repeat an id or a vector are rows of their own (an anchor's copy may
be its positive). Ties go to the smaller id. Vectors of unequal length count as padded with zeros. Scores are exact;
one beyond 63 bits raises an error. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.session import stage

ROW_CELL, ANCHOR_CELL = 8192, 4096
STEP = 8
NO_ID = np.iinfo(np.int64).max

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
SCALE, LOW, HIGH = 256, 50, 95


# ---------------------------------------------------------------- the vertical scan

def exact_kind(a: np.ndarray, b: np.ndarray):
    """A number type in which all partial inner products of the rows of a and b are exact."""
    top = lambda x: max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    bound = top(a) * top(b) * max(a.shape[1], 1)
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object


def orders(anchors: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor the dimensions by descending magnitude, and after each the least and the most that the rest can add."""
    least, most = columns.min(axis=1), columns.max(axis=1)
    order = np.argsort(-np.abs(anchors), axis=1, kind="stable")
    ends = np.stack([anchors * least, anchors * most])
    rest = []
    for side in (ends.min(axis=0), ends.max(axis=0)):
        ordered = np.take_along_axis(side, order, axis=1)
        after = np.zeros((len(anchors), anchors.shape[1] + 1), dtype=ordered.dtype)
        after[:, :-1] = np.cumsum(ordered[:, ::-1], axis=1)[:, ::-1]
        rest.append(after)
    return order, rest[0], rest[1]


def vertical(columns: np.ndarray, alive: np.ndarray, anchor: np.ndarray, order, least, most, keep) -> tuple[np.ndarray, np.ndarray]:
    """(candidates left, their exact scores). ``keep(lower, upper)`` gives the bitmap of those still in play."""
    score = np.zeros(len(alive), dtype=columns.dtype)
    for at in range(0, len(order), STEP):
        dims = order[at:at + STEP]
        score = score + anchor[dims] @ columns[np.ix_(dims, alive)]
        done = min(at + STEP, len(order))
        bitmap = keep(score + least[done], score + most[done])
        if not bitmap.all():
            alive, score = alive[bitmap], score[bitmap]
            if not len(alive):
                break
    return alive, score


def nearest(k: int):
    def keep(lower, upper):
        if len(lower) <= k:
            return np.ones(len(lower), dtype=bool)
        return upper >= np.partition(lower, len(lower) - k)[len(lower) - k]
    return keep


def within(windows: list[tuple[int, int]], k: int):
    def keep(lower, upper):
        bitmap = np.zeros(len(lower), dtype=bool)
        for low, high in windows:
            at_least = low
            sure = lower[(lower >= low) & (upper <= high)]
            if len(sure) >= k:
                at_least = np.partition(sure, len(sure) - k)[len(sure) - k]
            bitmap |= (upper >= at_least) & (lower <= high)
        return bitmap
    return keep


def best(k: int, rows: np.ndarray, score: np.ndarray, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Indices into ``rows`` of the k best, by score, then id."""
    return np.lexsort((places[rows], ids[rows], -score))[:k]


def window_of(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The whole numbers n with low * score <= 100 * n <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


# ---------------------------------------------------------------- cells

class Cell:
    """A group's vectors by column, rows ordered by label."""

    def __init__(self, table: pa.Table, width: int):
        x = _matrix(table.column("q"), width)
        order = np.argsort(table.column("label").to_numpy(), kind="stable")
        self.columns = np.ascontiguousarray(x[order].T)
        self.labels = table.column("label").to_numpy()[order]
        self.ids = table.column("vec_id").fill_null(NO_ID).to_numpy()[order]
        self.places = table.column("_row").to_numpy()[order]

    def of(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, side="left")), int(np.searchsorted(self.labels, label, side="right"))


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _width(*tables: pa.Table) -> int:
    import pyarrow.compute as pc

    return max(pc.max(pc.list_value_length(t.column("q"))).as_py() for t in tables)


def _pair(rows: pa.Table, anchors: pa.Table) -> tuple[Cell, np.ndarray]:
    width = _width(rows, anchors)
    cell, x = Cell(rows, width), _matrix(anchors.column("q"), width)
    kind = exact_kind(x, cell.columns.T)
    cell.columns = cell.columns.astype(kind)
    return cell, x.astype(kind)


def cell_positives(rows: pa.Table, anchors: pa.Table, k: int) -> pa.Table:
    """The k best rows of the cell with the anchor's label, for each anchor."""
    out = []
    if len(rows) and len(anchors):
        cell, x = _pair(rows, anchors)
        labels, own = anchors.column("label").to_numpy(), anchors.column("_row").to_numpy()
        for label in np.unique(labels):
            start, end = cell.of(label)
            if start == end:
                continue
            columns, places, ids = cell.columns[:, start:end], cell.places[start:end], cell.ids[start:end]
            mine = np.flatnonzero(labels == label)
            for a, order, least, most in zip(mine, *orders(x[mine], columns)):
                left, score = vertical(columns, np.flatnonzero(places != own[a]), x[a], order, least, most, nearest(k))
                out += [(int(own[a]), int(ids[left[i]]), int(places[left[i]]), int(score[i])) for i in best(k, left, score, ids, places)]
    return _table(out, ["anchor_row", "id", "row", "score"])


def cell_negatives(rows: pa.Table, anchors: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """The k best rows of the cell with another label, for each anchor and score window."""
    out = []
    if len(rows) and len(anchors):
        cell, x = _pair(rows, anchors)
        labels, own = anchors.column("label").to_numpy(), anchors.column("_row").to_numpy()
        everyone = np.arange(len(cell.labels))
        for a, (scores, order, least, most) in enumerate(zip(anchors.column("scores").to_pylist(), *orders(x, cell.columns))):
            windows = {s: window_of(s, low, high) for s in scores}
            windows = {s: w for s, w in windows.items() if w[0] <= w[1]}
            start, end = cell.of(labels[a])
            left = np.concatenate((everyone[:start], everyone[end:]))
            if not windows or not len(left):
                continue
            left, score = vertical(cell.columns, left, x[a], order, least, most, within(list(windows.values()), k))
            for s, (first, last) in windows.items():
                inside = np.flatnonzero((score >= first) & (score <= last))
                out += [(int(own[a]), s, int(cell.ids[left[j]]), int(cell.places[left[j]]), int(score[j]))
                        for j in inside[best(k, left[inside], score[inside], cell.ids, cell.places)]]
    return _table(out, ["anchor_row", "positive_score", "id", "row", "score"])


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    return pa.table({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})


# ---------------------------------------------------------------- Spark

def quantised(embeddings: DataFrame) -> DataFrame:
    """(_row, vec_id, label, q), staged (so that _row stays): the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label").cast("long") + 1) % LABELS).otherwise(F.col("label").cast("long"))
    used = embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
    return stage(used.select(
        F.monotonically_increasing_id().alias("_row"), F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("q")))


def in_cells(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, fn, schema: str) -> DataFrame:
    """``fn(rows of a cell, anchors of a cell)`` for every pair of cells. Each row is sent once per anchor cell, each
    anchor once per row cell; the number of cells follows from the counts, so that none grows with the table."""
    r, a = max(1, -(-n_rows // ROW_CELL)), max(1, -(-n_anchors // ANCHOR_CELL))
    deal = lambda n: F.pmod(F.xxhash64("_row"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("*", deal(r).alias("_r"), each(a).alias("_a")).repartition(4 * r * a, "_r", "_a")
    # Anchors are rows too, so their columns get names of their own on the way.
    right = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns], deal(a).alias("a_a"), each(r).alias("a_r")).repartition(4 * r * a, "a_r", "a_a")
    named = lambda t: t.select([c for c in t.column_names if c not in ("a_a", "a_r")]).rename_columns(anchors_columns)
    anchors_columns = list(anchors.columns)
    return left.groupBy("_r", "_a").cogroup(right.groupBy("a_r", "a_a")).applyInArrow(lambda x, y: fn(x, named(y)), schema)


def best_of(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best by (score, id) of each key, with their ``rank`` from 1."""
    order: list[Column] = [F.col("score").desc(), F.col("id").asc(), F.col("row").asc()]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Over staged (_row, vec_id, label, q): for each anchor and each of its nearest rows of the same label, the best
    rows of other labels that score ``low`` to ``high`` percent of it. (anchor_row, positive id and row, rank, …)."""
    counts = rows.select(F.lit(0).alias("a")).unionAll(anchors.select(F.lit(1).alias("a"))).groupBy("a").count().collect()
    n = {r["a"]: r["count"] for r in counts}
    found = in_cells(rows, anchors, n.get(0, 0), n.get(1, 0), lambda x, y: cell_positives(x, y, positives),
                     "anchor_row long, id long, row long, score long")
    near = stage(best_of(found, ["anchor_row"], positives).select(
        "anchor_row", F.col("id").alias("positive_id"), F.col("row").alias("positive_row"), F.col("score").alias("positive_score")))
    asked = anchors.join(near.groupBy(F.col("anchor_row").alias("_row")).agg(F.sort_array(F.collect_set("positive_score")).alias("scores")), "_row")
    found = in_cells(rows, asked, n.get(0, 0), n.get(1, 0), lambda x, y: cell_negatives(x, y, negatives, low, high),
                     "anchor_row long, positive_score long, id long, row long, score long")
    top = best_of(found, ["anchor_row", "positive_score"], negatives)
    return near.join(top, ["anchor_row", "positive_score"]).select(
        "anchor_row", "positive_id", "positive_row", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Contract rows: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = quantised(embeddings)
    anchors = rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0)
    named = lambda c: F.when(F.col(c) != int(NO_ID), F.col(c)).alias(c)
    return mine(rows, anchors).join(anchors.select(F.col("_row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row").select(
        "anchor_id", named("positive_id"), F.col("rank").cast("int").alias("rank"), named("negative_id"), "positive_score", "negative_score")
