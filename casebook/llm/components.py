"""Connected components over (a, b) edges of long node ids, by alternating large and small stars.

Every step is a shuffle of the edges by one end, so no component is ever gathered: in a large star
each node links its larger neighbours to the least of its neighbourhood, in a small star its smaller
ones. The edges settle to (node, least node of its component) in a number of rounds that grows with
the logarithm of the longest path. Each round is staged in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    linked = both.join(least.withColumn("m", F.least("m", "u")), "u")
    if large:
        out = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and two order-free sums of them: equal marks mean the edges did not change."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node with an edge; root is the least node that it reaches.

    Edges may repeat, loop, or point either way; an empty table gives an empty result."""
    ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(F.col("u") > F.col("v"))
    now = stage(ends.distinct())
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        now = stage(_star(_star(now, large=True), large=False))
        last, mark = mark, _mark(now)
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
