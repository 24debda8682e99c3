"""Exact nearest neighbours through a pivot index: kNN classifier (M3), ENN, SMOTE, SMOTEENN.

The reference compares each row with every labelled row. Here rows are assigned to the nearest of about √n pivots.
Cells (a pivot's rows) next to each other are put together into groups of at most a block of rows, from ``BLOCK`` to
``LARGE_BLOCK``; a larger cell is split. A row is sent once to every pair of blocks that it stands in, so blocks are as large as
leaves about ``PAIRS`` pairs to work on side by side: what is shuffled is a fixed multiple of the rows until blocks are at
their largest, and from there on the multiple grows with the number of blocks. Each row first searches its own group, which gives it an upper bound for its k-th distance; another group
is visited only if the triangle inequality (pivot distance less both radii) does not put all its cells beyond the
bound of a row's cell. A visit is a bounded pair of blocks, searched in numpy: matrix products pick the candidates,
whose distances are then summed exactly. The results are those of the full comparison, whatever the table's size;
how many pairs of blocks are visited depends on how well the data cluster.

``omit`` numbers parts of the rows (folds): no row is a neighbour of a query of its own part. ``key`` columns part rows into sets that are searched apart (a few, such as the training sets of folds), so
resampling inside every training set is one plan, not a chain of jobs per fold. Distances are squared and rounded to six
digits; ties go to the smaller id. Rows with a null vector take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

import casebook
from casebook.functions.columns import hex_prefix_int, seeded_hash
from casebook.operators.cohort import rank_by_hash
from casebook.session import stage

cloudpickle.register_pickle_by_value(casebook)

BLOCK, LARGE_BLOCK, PAIRS = 4096, 65_536, 64
PIVOTS = 1024
#: Cells of a distance matrix that are held at once.
HELD = 1 << 23
#: Distances that are looked at through the least of them.
MEMBERS = 64
#: Copies of the rows that are drawn from, so that few drawn rows do not gather all draws in few tasks; one copy where they are
#: MANY by themselves.
SALT, MANY = 16, 4096
#: Rows without a part that they are kept from.
NONE = -1


# ---------------------------------------------------------------- in a pair of blocks

def _matrix(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _square(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def block_nearest(q: np.ndarray, q_row: np.ndarray, s: np.ndarray, s_row: np.ndarray, s_order: np.ndarray, k: int,
                  limit: np.ndarray | None = None, chunk: int = 512, q_omit: np.ndarray | None = None, s_omit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, squared distance) of the k nearest rows of each query, itself (same ``row``) left out. ``s_order`` ranks
    rows that are equally near; ``limit`` is a squared distance beyond which a query needs no row; rows whose ``s_omit`` is the
    query's ``q_omit`` (and not ``NONE``) are left out as well."""
    # Of equal vectors (of a part) only the first k + 1 can be among the nearest.
    same = np.unique(s, axis=0, return_inverse=True)[1].reshape(-1).astype(np.int64)
    if s_omit is not None:
        same = np.unique(same * (int(s_omit.max(initial=0)) + 2) + s_omit + 1, return_inverse=True)[1].reshape(-1)
    by = np.lexsort((s_order, same))
    same = same[by]
    begin = np.flatnonzero(np.concatenate(([True], same[1:] != same[:-1])))
    nth = np.arange(len(by)) - np.repeat(begin, np.diff(np.append(begin, len(by))))
    held = by[nth <= k]
    s, s_row, s_order = s[held], s_row[held], s_order[held]
    s_omit = None if s_omit is None else np.where(s_omit[held] == NONE, NONE - 1, s_omit[held])  # NONE equals no query's
    if s_omit is not None:  # a part's rows side by side
        by = np.argsort(s_omit, kind="stable")
        s, s_row, s_order, s_omit, held = s[by], s_row[by], s_order[by], s_omit[by], held[by]
        part_of, first, count = np.unique(s_omit, return_index=True, return_counts=True)
    n, d = s.shape
    # Members of a group of columns; the k-th smallest least value of a group is no less than the k-th smallest value.
    members = MEMBERS if n >= 4 * k * MEMBERS else 1
    groups = -(-n // members)
    chunk = max(16, min(chunk, HELD // max(groups * members, 1)))
    centre = s.mean(axis=0) if n else np.zeros(d)
    s_norm, place = _square(s - centre), np.argsort(s_row, kind="stable")
    reach = s_norm.max(initial=0.0)

    def columns(kind: type) -> tuple[np.ndarray, np.ndarray]:
        """What a query and a 1 are multiplied by to give its squared distances less its own square, and a buffer for these."""
        table = np.zeros((d + 1, groups * members), dtype=kind)
        table[:d, :n], table[d, :n] = -2.0 * (s - centre).T, s_norm
        return table, np.empty((min(chunk, len(q)), groups * members), dtype=kind)

    kind = np.float32 if reach < 1e12 else np.float64
    table, buffer = columns(kind)
    out_q, out_s, out_d, at = [], [], [], 0
    while at < len(q):
        part = q[at:at + chunk]
        norm = _square(part - centre)
        near = np.matmul(np.hstack([part - centre, np.ones((len(part), 1))]).astype(kind), table, out=buffer[:len(part)])
        near[:, n:] = np.inf
        found = place[np.minimum(np.searchsorted(s_row[place], q_row[at:at + chunk]), len(place) - 1)]
        own = np.flatnonzero(s_row[found] == q_row[at:at + chunk])
        near[own, found[own]] = np.inf
        if s_omit is not None:
            for value, start, size in zip(part_of.tolist(), first.tolist(), count.tolist()):
                near[np.flatnonzero(q_omit[at:at + chunk] == value), start:start + size] = np.inf
        near = near.reshape(len(part), members, groups)
        least = near.min(axis=1)
        slack = 2e-6 + (1e-11 * (norm + reach) if kind is np.float64 else (d + 8) * 2.0 ** -23 * (np.sqrt(norm) + math.sqrt(reach)) ** 2)
        top = np.partition(least, k - 1, axis=1)[:, k - 1].astype(float) if k <= groups and k < n else np.full(len(part), np.finfo(float).max)
        if limit is not None:
            top = np.minimum(top, limit[at:at + chunk] - norm)
        bound = np.minimum(top + slack, np.finfo(kind).max).astype(kind)
        qi, group = np.nonzero(least <= bound[:, None])
        cells = near[qi, :, group]
        hit, member = np.nonzero(cells <= bound[qi, None])
        qi, si = qi[hit], member * groups + group[hit]
        if kind is np.float32 and len(qi) > 32 * (k + 1) * len(part):  # many are as near as single precision tells
            kind = np.float64
            table, buffer = columns(kind)
            continue
        for cut in range(0, len(qi), 1 << 15):
            a, b = qi[cut:cut + (1 << 15)], si[cut:cut + (1 << 15)]
            step = part[a] - s[b]
            step *= step
            far = np.zeros(len(a))
            for j in range(d):
                far += step[:, j]
            out_q.append(a + at)
            out_s.append(b)
            out_d.append(np.floor(far * 1e6 + 0.5) / 1e6)
        at += chunk
    if not out_q:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(0)
    qi, si, d = np.concatenate(out_q), np.concatenate(out_s), np.concatenate(out_d)
    order = np.lexsort((s_order[si], d, qi))
    qi, si, d = qi[order], si[order], d[order]
    first = np.flatnonzero(np.concatenate(([True], qi[1:] != qi[:-1]))) if len(qi) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(qi)) - np.repeat(first, np.diff(np.append(first, len(qi))))
    keep = rank < k
    return qi[keep], held[si[keep]], d[keep]


# ---------------------------------------------------------------- the index

class Plan:
    """Cells, groups of cells and their parts; small arrays, made on the driver from counts by (key, cell)."""

    def __init__(self, pivots: np.ndarray, stats: list[tuple[int, int, int, float, int, float]], block: int):
        """``stats``: (key, cell, rows, their radius, queries, their radius)."""
        self.pivots = pivots
        n = len(pivots)
        self.apart = np.sqrt(np.maximum(_square(pivots)[:, None] + _square(pivots) - 2 * pivots @ pivots.T, 0.0))
        self.keys = sorted({s[0] for s in stats})
        at = {key: i for i, key in enumerate(self.keys)}
        self.rows, self.queries = np.zeros((len(at), n), dtype=np.int64), np.zeros((len(at), n), dtype=np.int64)
        self.row_radius, self.query_radius = np.zeros((len(at), n)), np.zeros((len(at), n))
        for key, cell, rows, radius, queries, query_radius in stats:
            self.rows[at[key], cell], self.row_radius[at[key], cell] = rows, radius or 0.0
            self.queries[at[key], cell], self.query_radius[at[key], cell] = queries, query_radius or 0.0
        size = np.maximum(self.rows, self.queries).max(axis=0) if len(at) else np.zeros(n, dtype=np.int64)
        # Cells in a chain, each next to its nearest not yet taken, are cut into groups of at most a block.
        self.group, self.parts, held = np.zeros(n, dtype=np.int64), [], 0
        left, here = np.ones(n, dtype=bool), 0
        for _ in range(n):
            left[here] = False
            if not self.parts or held + size[here] > block:
                self.parts.append(1)
                held = 0
            held += int(size[here])
            self.group[here] = len(self.parts) - 1
            self.parts[-1] = max(1, -(-held // block))
            if left.any():
                here = int(np.argmin(np.where(left, self.apart[here], np.inf)))

    def visits(self, bounds: dict[tuple[int, int], float]) -> list[tuple[int, int, int]]:
        """(key, group of queries, other group of rows) pairs that the triangle inequality does not rule out;
        ``bounds`` gives, by (key, cell), the largest distance of a k-th neighbour found so far."""
        out = set()
        for i, key in enumerate(self.keys):
            rows = np.flatnonzero(self.rows[i])
            for cell in np.flatnonzero(self.queries[i]):
                reach = bounds.get((key, int(cell)), math.inf) * (1 + 1e-9) + 1e-3
                near = self.apart[cell, rows] - self.query_radius[i, cell] - self.row_radius[i, rows] <= reach
                out |= {(key, int(self.group[cell]), int(g)) for g in np.unique(self.group[rows[near]]) if g != self.group[cell]}
        return sorted(out)


def _in_cells(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds ``cell`` and ``far``, the nearest pivot and the distance to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            x = _matrix(batch.column("x"))
            cell, far = np.zeros(len(x), dtype=np.int32), np.zeros(len(x))
            for at in range(0, len(x), 1024):
                part = x[at:at + 1024]
                near = _square(pivots) - 2.0 * (part @ pivots.T)
                cell[at:at + 1024] = near.argmin(axis=1)
                far[at:at + 1024] = np.sqrt(_square(part - pivots[cell[at:at + 1024]]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kinds}, cell int, far double")


def _placed(df: DataFrame, plan: Plan) -> DataFrame:
    """Adds ``grp`` and ``part``, the block of a row."""
    group = F.array(*[F.lit(int(g)) for g in plan.group])
    parts = F.array(*[F.lit(int(p)) for p in plan.parts])
    placed = df.withColumn("grp", F.get(group, F.col("cell")))
    return placed.withColumn("part", F.pmod(F.xxhash64("row"), F.get(parts, F.col("grp"))).cast("int"))


def _search(queries: DataFrame, rows: DataFrame, plan: Plan, pairs: DataFrame, k: int, id_type: str) -> DataFrame:
    """Searches the given (key, grp, other) pairs of groups, part by part."""
    parts = F.array(*[F.lit(int(p)) for p in plan.parts])
    every = lambda g: F.explode(F.sequence(F.lit(0), F.get(parts, F.col(g)) - 1))
    blocks = F.broadcast(pairs.select("*", every("grp").alias("part")).select("*", every("other").alias("other_part")))  # counted on the driver
    cut = ["key", "grp", "part", "other", "other_part"]
    left = queries.join(blocks, ["key", "grp", "part"])
    # Both sides may be the same frame, so the right one gets names of its own.
    theirs = rows.select(F.col("key").alias("s_key"), F.col("grp").alias("s_other"), F.col("part").alias("s_other_part"),
                         *[F.col(c).alias(f"s_{c}") for c in ("row", "id", "x", "y", "cell", "omit")])
    right = theirs.join(blocks.select(*[F.col(c).alias(f"s_{c}") for c in cut]), ["s_key", "s_other", "s_other_part"])
    centres, radius = plan.pivots, {key: plan.row_radius[i] for i, key in enumerate(plan.keys)}

    def run(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        schema = pa.schema([("key", pa.int32()), ("q_row", pa.int64()), ("d", pa.float64()), ("row", pa.int64()), ("id", b.schema.field("s_id").type), ("y", pa.int32())])
        if not len(a) or not len(b):
            return schema.empty_table()
        own = key[0].as_py()
        q, s = _matrix(a.column("x")), _matrix(b.column("s_x"))
        limit = a.column("limit").to_numpy()
        cells = np.unique(b.column("s_cell").to_numpy())
        # The least distance that any row of these cells can have from a query.
        gap = np.sqrt(np.maximum(_square(q)[:, None] + _square(centres[cells]) - 2 * q @ centres[cells].T, 0.0)) - radius[own][cells]
        use = np.flatnonzero(gap.min(axis=1) <= np.sqrt(limit) * (1 + 1e-9) + 1e-3)
        if not len(use):
            return schema.empty_table()
        order = np.unique(np.array(b.column("s_id").to_pylist()), return_inverse=True)[1].reshape(-1)
        rows_of = a.column("row").to_numpy()
        parts_of = b.column("s_omit").to_numpy()
        omits = (a.column("omit").to_numpy()[use], parts_of) if (parts_of != NONE).any() else (None, None)
        qi, si, d = block_nearest(q[use], rows_of[use], s, b.column("s_row").to_numpy(), order, k, limit[use], q_omit=omits[0], s_omit=omits[1])
        return pa.table({"key": pa.array(np.full(len(qi), own, dtype=np.int32)), "q_row": rows_of[use][qi], "d": d, "row": b.column("s_row").to_numpy()[si],
                         "id": b.column("s_id").combine_chunks().take(pa.array(si)), "y": b.column("s_y").combine_chunks().take(pa.array(si))}, schema)

    return left.groupBy(*cut).cogroup(right.groupBy(*[f"s_{c}" for c in cut])).applyInArrow(run, f"key int, q_row long, d double, row long, id {id_type}, y int")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key", "q_row").orderBy("d", "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def indexed_rows(df: DataFrame, id_col: str, x: str, label: str | None = None, key: Column | None = None, omit: Column | None = None) -> DataFrame:
    """(row, key, id, x, y, omit), staged, so that ``row`` stays a row's number."""
    rows = df.filter(F.col(x).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), (F.lit(0) if key is None else key).cast("int").alias("key"), F.col(id_col).alias("id"),
        F.col(x).cast("array<double>").alias("x"), (F.lit(0) if label is None else F.col(label)).cast("int").alias("y"),
        (F.lit(NONE) if omit is None else F.coalesce(omit.cast("int"), F.lit(NONE))).alias("omit"))
    return stage(rows)


def block_size(stats: list[tuple[int, int, int, float, int, float]]) -> int:
    """Rows a block, of ``Plan``'s statistics: as many as leave about PAIRS pairs of blocks over all keys."""
    per: dict[int, list[int]] = {}
    for key, _, rows, _, queries, _ in stats:
        both = per.setdefault(key, [0, 0])
        both[0], both[1] = both[0] + rows, both[1] + queries
    each = math.isqrt(max(PAIRS // max(len(per), 1), 1) - 1) + 1
    return min(LARGE_BLOCK, max(BLOCK, -(-max((max(both) for both in per.values()), default=0) // each)))


def nearest(queries: DataFrame, rows: DataFrame, k: int, block: int | None = None, pivots: int = PIVOTS) -> DataFrame:
    """The k nearest ``rows`` of the same key for each query, both as of ``indexed_rows`` (the same frame: rows among
    themselves): staged (key, q_row, d, row, id, y, rank). A row is not its own neighbour."""
    n = rows.count()
    id_type = rows.schema["id"].dataType.simpleString()
    few = [r["x"] for r in rows.select("x", "row").orderBy(F.xxhash64("row"), "row").limit(min(pivots, max(1, math.isqrt(n)))).collect()]
    if not few:
        return rows.sparkSession.createDataFrame([], f"key int, q_row long, d double, row long, id {id_type}, y int, rank int")
    centres = np.unique(np.array(few, dtype=float), axis=0)
    own = stage(_in_cells(rows, centres))
    asked = own if queries is rows else stage(_in_cells(queries, centres))
    sizes = own.groupBy("key", "cell").agg(F.count(F.lit(1)).alias("rows"), F.max("far").alias("radius")).join(
        asked.groupBy("key", "cell").agg(F.count(F.lit(1)).alias("queries"), F.max("far").alias("query_radius")), ["key", "cell"], "full")
    stats = [(r["key"], r["cell"], r["rows"] or 0, r["radius"], r["queries"] or 0, r["query_radius"]) for r in sizes.collect()]
    plan = Plan(centres, stats, block or block_size(stats))
    spark = rows.sparkSession
    placed, posed = _placed(own, plan), _placed(asked, plan).withColumn("limit", F.lit(float(np.finfo(float).max)))
    first = spark.createDataFrame([(key, int(g), int(g)) for i, key in enumerate(plan.keys)
                                   for g in np.unique(plan.group[np.flatnonzero(plan.queries[i])])], "key int, grp int, other int")
    near = stage(_best(_search(posed, placed, plan, first, k, id_type), k))
    if len(plan.parts) == 1:
        return near
    known = near.groupBy("key", F.col("q_row").alias("row")).agg(F.count(F.lit(1)).alias("_n"), F.max("d").alias("_d"))
    far = F.when(F.col("_n") >= k, F.col("_d")).otherwise(F.lit(float(np.finfo(float).max)))
    limits = stage(posed.select("key", "row", "cell").join(known, ["key", "row"], "left").select(
        "key", "row", "cell", F.coalesce(far, F.lit(float(np.finfo(float).max))).alias("limit")))
    bounds = {(r["key"], r["cell"]): math.sqrt(r["b"]) for r in limits.groupBy("key", "cell").agg(F.max("limit").alias("b")).collect()}
    visits = plan.visits(bounds)
    if not visits:
        return near
    bounded = posed.drop("limit").join(limits.drop("cell"), ["key", "row"])
    more = _search(bounded, placed, plan, spark.createDataFrame(visits, "key int, grp int, other int"), k, id_type)
    return stage(_best(near.drop("rank").unionByName(more), k))


# ---------------------------------------------------------------- M3: classifier

def knn_classify(train: DataFrame, test: DataFrame, id_col: str, x: str, label: str = "label", k: int = 5, fold: str | None = None) -> DataFrame:
    """M3: adds ``prediction`` (majority of the k nearest, ties to 0) and ``score`` (share of class 1; 0 without a
    neighbour). With ``fold``, rows of the same fold are not neighbours (out-of-fold prediction)."""
    asked = stage(test.withColumn("_row", F.monotonically_increasing_id()))
    omit = F.coalesce(F.col(fold).cast("int"), F.lit(NONE)) if fold else F.lit(NONE)
    queries = stage(asked.filter(F.col(x).isNotNull()).select(
        (-1 - F.col("_row")).alias("row"), F.lit(0).alias("key"), F.col(id_col).alias("id"), F.col(x).cast("array<double>").alias("x"), F.lit(0).alias("y"), omit.alias("omit")))
    rows = indexed_rows(train, id_col, x, label, omit=F.col(fold) if fold else None)
    votes = nearest(queries, rows, k).groupBy((-1 - F.col("q_row")).alias("_row")).agg(F.avg("y").alias("score"))
    return (asked.join(votes, "_row", "left").drop("_row").withColumn("score", F.coalesce("score", F.lit(0.0)))
            .withColumn("prediction", (F.col("score") > 0.5).cast("int")))


# ---------------------------------------------------------------- E8: ENN, SMOTE, SMOTEENN

def _edited(rows: DataFrame, k: int) -> DataFrame:
    """The indexed rows whose k nearest of their key all have their class."""
    near = nearest(rows, rows, k).select("key", F.col("q_row").alias("row"), F.col("y").alias("_y"))
    against = rows.join(near, ["key", "row"]).filter(F.col("_y") != F.col("y")).select("key", "row").distinct()
    return rows.join(against, ["key", "row"], "left_anti")


def edited(df: DataFrame, id_col: str, x: str, label: str = "label", k: int = 3) -> DataFrame:
    """ENN: (id, x, label) of the rows whose k nearest other rows all have their class."""
    kept = _edited(indexed_rows(df, id_col, x, label), k)
    return kept.select(F.col("id").alias(id_col), F.col("x").alias(x), F.col("y").alias(label))


def _draws(rows: DataFrame, k: int, seed: int, keyed: bool) -> DataFrame:
    """SMOTE over indexed rows: (key, draw, base_id, neighbour_id, u, x, y) of the synthetic rows of every key."""
    spark = rows.sparkSession
    counts: dict[int, list[tuple[int, int]]] = {}
    for r in rows.groupBy("key", "y").agg(F.count(F.lit(1)).alias("n")).collect():  # keys x classes
        counts.setdefault(r["key"], []).append((r["n"], r["y"]))
    need = [(key, min(c)[1], min(c)[0], max(c)[0]) for key, c in sorted(counts.items()) if len(c) > 1 and min(c)[0] < max(c)[0]]
    if not need:
        return spark.createDataFrame([], f"key int, draw long, base_id {rows.schema['id'].dataType.simpleString()}, "
                                         f"neighbour_id {rows.schema['id'].dataType.simpleString()}, u double, x array<double>, y int")
    sizes = spark.createDataFrame(need, "key int, y int, low long, high long")
    minor = stage(rows.join(F.broadcast(sizes), ["key", "y"]))  # a row a key
    near = nearest(minor, minor, k).select("key", "q_row", "row", "rank")
    told = near.join(minor.select("key", "row", F.col("id").alias("_id"), F.col("x").alias("_x")), ["key", "row"])
    lists = told.groupBy("key", F.col("q_row").alias("row")).agg(F.sort_array(F.collect_list(F.struct("rank", "_id", "_x"))).alias("_near"))  # k entries
    ranked = rank_by_hash(minor.withColumn("_h", seeded_hash(seed, F.col("id"))), ["key"], "_h", "_idx").join(lists, ["key", "row"])
    salts = 1 if min(low for _, _, low, _ in need) >= MANY else SALT
    base = ranked.select("key", "_idx", "y", "id", "x", "_near", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))

    def part(name: str) -> Column:
        salt = F.concat(F.lit(f"{seed}:"), F.col("key").cast("string"), F.lit(f":{name}:")) if keyed else F.lit(f"{seed}:{name}:")
        return hex_prefix_int(F.md5(F.concat(salt, F.col("draw").cast("string"))), 12)

    parts = [spark.range(high - low).select(F.lit(key).cast("int").alias("key"), F.col("id").alias("draw"), F.lit(low).alias("_low")) for key, _, low, high in need]
    draws = parts[0]
    for p in parts[1:]:
        draws = draws.unionByName(p)
    draws = draws.withColumn("_idx", F.pmod(part("base"), F.col("_low")) + 1).withColumn("_salt", F.pmod(F.col("draw"), F.lit(salts)).cast("int"))
    picked = draws.join(base, ["key", "_idx", "_salt"])
    other = F.get("_near", F.pmod(part("near"), F.size("_near")).cast("int"))
    return picked.select("*", other.alias("_o"), F.round(F.pmod(part("step"), F.lit(1_000_000)) / 1_000_000, 6).alias("u")).select(
        "key", "draw", F.col("id").alias("base_id"), F.col("_o._id").alias("neighbour_id"), "u",
        F.zip_with("x", F.col("_o._x"), lambda p, q: p + F.col("u") * (q - p)).alias("x"), "y")


def smote_rows(df: DataFrame, id_col: str, x: str, label: str = "label", k: int = 5, seed: int = 0) -> DataFrame:
    """SMOTE: as many synthetic rows of the smaller class as it lacks, ``(draw, base_id, neighbour_id,
    u, x)``: draw i takes the minority row whose index the seed's md5 gives, one of its k nearest of the
    class (fewer if there are fewer) and the point that part u of the way to it. A minority of one row
    has no neighbour and gives none."""
    return _draws(indexed_rows(df, id_col, x, label), k, seed, False).select("draw", "base_id", "neighbour_id", "u", "x")


def _with_synthetic(rows: DataFrame, k: int, seed: int, keyed: bool) -> DataFrame:
    """Indexed rows and their synthetic ones, whose ids are -1 - draw."""
    made = _draws(rows, k, seed, keyed).select("key", (-1 - F.col("draw")).cast(rows.schema["id"].dataType).alias("id"), "x", "y")
    return indexed_rows(rows.select("key", "id", "x", "y").unionByName(made), "id", "x", "y", F.col("key"))


def smote(df: DataFrame, id_col: str, x: str, label: str = "label", k: int = 5, seed: int = 0) -> DataFrame:
    """The rows (id, x, label) and the synthetic ones, whose ids are -1 - draw."""
    both = _with_synthetic(indexed_rows(df, id_col, x, label), k, seed, False)
    return both.select(F.col("id").alias(id_col), F.col("x").alias(x), F.col("y").alias(label))


def smote_enn(df: DataFrame, id_col: str, x: str, label: str = "label", seed: int = 0) -> DataFrame:
    """SMOTEENN: over-sample by SMOTE, then drop by ENN whatever its neighbours contradict."""
    kept = _edited(_with_synthetic(indexed_rows(df, id_col, x, label), 5, seed, False), 3)
    return kept.select(F.col("id").alias(id_col), F.col("x").alias(x), F.col("y").alias(label))


def smote_enn_folds(df: DataFrame, id_col: str, x: str, label: str = "label", fold: str = "fold", seed: int = 0) -> DataFrame:
    """SMOTEENN of every fold's training rows (those of the other folds) in one plan: (fold, id, x, label), where
    ``fold`` is the fold left out. A fold's own rows are neither resampled nor drawn from."""
    folds = [int(r[0]) for r in df.select(fold).distinct().collect()]  # k values
    others = F.explode(F.filter(F.array(*[F.lit(f) for f in folds]), lambda f: f != F.col(fold)))
    rows = indexed_rows(df.select("*", others.alias("_key")), id_col, x, label, F.col("_key"))
    kept = _edited(_with_synthetic(rows, 5, seed, True), 3)
    return kept.select(F.col("key").alias(fold), F.col("id").alias(id_col), F.col("x").alias(x), F.col("y").alias(label))
