import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from casebook.llm import mixing

SCHEMA = "doc_id long, text string, source string, size long, words long, target double, rank int, _src string, _block int, taken int"


def shared(words):
    """Shares by weight, the excess over twice a source's words shared anew until none is above."""
    names = sorted((s for s in words if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in words)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(words.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 2 * words[s]}
        if not above:
            return out | {s: level * weight[s] for s in free}
        out |= {s: 2 * words[s] for s in above}
        left -= sum(2 * words[s] for s in above)
        free -= above
    return out


def make(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, 3.0, 4, "x", 5, 6) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    """Many sources, one of which holds a third of all rows; repeated rows, nulls, one very long text."""
    rnd = random.Random(4)
    names = [f"s{i}" for i in range(30)] + ["", None, "é", "z"]
    out = [(i, " ".join("w" * rnd.randint(0, 80)), "hot" if rnd.random() < 0.33 else rnd.choice(names)) for i in range(1500)]
    return out + [(7, "a b\tc\x0bd", "z")] * 3 + [(None, "no id", None), (2000, None, "z"), (2001, "w " * 60_000, "s3"), (2002, "", "only empty"), (None, None, None)]


def test_targets_counts_and_limits(spark, rows):
    docs = make(spark, rows)
    laid, plan, mixed = mixing.mix(docs)
    words = defaultdict(int)
    for _, t, s in rows:
        words[s] += len((t or "").split())
    want = shared(words)
    for r in plan.collect():
        assert r["words"] == words[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert abs(r["taken"] - r["target"]) <= 0.5 and r["blocks"] == -(-r["words"] // mixing.BLOCK)
    taken = {r["_src"]: r["n"] for r in mixed.groupBy("_src").agg(F.sum("taken").alias("n")).collect()}
    assert taken == {r["_src"]: r["taken"] for r in plan.collect() if r["taken"]}
    out = mixing.mix_documents(docs).collect()
    assert sorted((r["doc_id"] or -1, r["size"]) for r in out) == sorted((i or -1, len((t or "").split())) for i, t, _ in rows)
    assert all(r["taken"] <= 2 * r["size"] for r in out) and sum(r["taken"] for r in out) == sum(taken.values())
    by_target = defaultdict(int)
    for r in out:
        by_target[r["target"]] += r["taken"]
    assert all(r["taken"] >= r["size"] for r in out if r["target"] >= r["source_size"] > 0)  # a whole pass takes every document


def test_result_does_not_depend_on_partitions(spark, rows):
    one = mixing.mix_documents(make(spark, rows).repartition(1)).collect()
    other = mixing.mix_documents(make(spark, list(reversed(rows))).repartition(7)).collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, other))


def test_slots_are_dealt_to_full_shards_in_the_shares_of_the_targets(spark, rows):
    _, plan, _ = mixing.mix(make(spark, [(i, "w " * 40, "ab"[i % 3 == 0]) for i in range(3000)]))
    made = mixing.slots(plan, shard_slots=32)
    places = [r["position"] for r in made.select("position").collect()]
    assert sorted(places) == list(range(len(places)))
    share = {r["_src"]: r["slots"] / len(places) for r in plan.collect()}
    counts = mixing.shard_counts(made).collect()
    n = Counter()
    for r in counts:
        n[r["shard"]] += r["n"]
    assert all(n[s] == 32 for s in range(len(places) // 32))
    off = [abs(r["n"] - 32 * share[r["_src"]]) for r in counts if n[r["shard"]] == 32]
    assert 0 < sum(off) / len(off) < 4  # drawn at random (not dealt evenly), near the shares
    blocks = Counter((r["_src"], r["_block"]) for r in made.select("_src", "_block").collect())
    assert max(blocks.values()) <= 2
    for r in plan.collect():
        assert min(blocks[r["_src"], b] for b in range(r["blocks"])) >= r["slots"] // r["blocks"]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 5000])
def test_permutations_are_bijections(spark, n):
    x = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), mixing.seed_of(F.lit("a"))).alias("p"))
    got = [r["p"] for r in x.orderBy("id").collect()]
    assert sorted(got) == list(range(n))
    if n > 200:  # neighbours part
        assert sum(abs(a - b) == 1 for a, b in zip(got, got[1:])) < n / 20


def test_edges(spark, nasty, empty):
    assert mixing.mix_documents(empty).count() == 0
    out = mixing.mix_documents(nasty).collect()
    assert len(out) == nasty.count() and abs(sum(r["taken"] for r in out) - 1.5 * sum(r["size"] for r in out)) <= 0.5
    only_empty = mixing.mix_documents(make(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in only_empty] == [(0, 0, 0.0, 0)] * 2
