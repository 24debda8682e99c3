"""Term weights and clusters where one term stands in every document."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from casebook.operators import text as TX


def documents(n=120):
    rnd = random.Random(1)
    return {i: ["everywhere", *rnd.choices([f"t{k}" for k in range(40)], k=12), *(["often"] if i % 4 == 0 else [])] for i in range(n)}


def weights(docs, min_df, max_df):
    tf = {d: Counter(t) for d, t in docs.items()}
    df = Counter(t for c in tf.values() for t in c)
    out = {}
    for d, c in tf.items():
        w = {t: k * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, k in c.items() if min_df <= df[t] <= max_df * len(docs)}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out |= {(d, t): v / norm for t, v in w.items()}
    return out


def test_weights_without_the_term_of_every_document(spark, monkeypatch):
    docs = documents()
    frame = spark.createDataFrame([(d, t) for d, ts in docs.items() for t in ts], "doc long, term string")
    want = weights(docs, 3, 0.3)
    assert not any(t == "everywhere" for _, t in want) and any(t == "often" for _, t in want)
    for limit in (TX.BROADCAST_ROWS, 0):  # few frequent terms, and more than may be broadcast
        monkeypatch.setattr(TX, "BROADCAST_ROWS", limit)
        out = TX.weigh_terms(frame, "doc", F.lit(len(docs)), 3, 0.3)
        got = {(r["doc"], r["term"]): r["weight"] for r in out.collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        plan = out._jdf.queryExecution().executedPlan().toString()
        anti = next(line for line in plan.split("\n") if "LeftAnti" in line)
        assert limit == 0 or "BroadcastHashJoin" in anti
        assert "_salt" in plan  # what remains joins in parts


def lloyd(vectors, centres, rounds):
    docs = sorted({d for d, _ in vectors})
    dot = lambda d, c: sum(w * c.get(t, 0.0) for (e, t), w in vectors.items() if e == d)
    at = {}
    for _ in range(rounds):
        cost = lambda d, c: round(sum(v * v for v in c.values()) - 2 * dot(d, c), 9)
        now = {d: min(range(len(centres)), key=lambda k: (cost(d, centres[k]), k)) for d in docs}
        if now == at:
            break
        at = now
        for k in range(len(centres)):
            members = [d for d in docs if at[d] == k]
            if members:
                total = Counter()
                for (d, t), w in vectors.items():
                    if at[d] == k:
                        total[t] += w / len(members)
                centres[k] = dict(total)
    return at


def test_clusters_equal_lloyds(spark, monkeypatch):
    docs = documents(60)
    vectors = weights(docs, 2, 0.9)
    long = spark.createDataFrame([(d, t, w) for (d, t), w in vectors.items()], "doc long, term string, weight double")
    every = spark.createDataFrame([(d,) for d in docs], "doc long")
    start = TX.spread_centres(long, "doc", 4, 3).collect()
    centres = [{r["term"]: r["weight"] for r in start if r["cluster"] == k} for k in range(4)]
    want = lloyd(vectors, centres, 30)
    for limit in (TX.BROADCAST_ROWS, 0):
        monkeypatch.setattr(TX, "BROADCAST_ROWS", limit)
        got = {r["doc"]: r["cluster"] for r in TX.cluster_notes(long, every, "doc", k=4, max_iter=30, seed=3).collect()}
        assert got == want


def test_long_tokens_are_cleaned_before_they_are_stemmed(spark):
    rnd = random.Random(4)
    ends = ["", "e", "em", "ern", "es", "nisses", "st", "isch", "lichkeit", "igkeit", "ungen", "end", "ik", "ß", "ße", "ys", "uer", "d", "g"]
    words = ["".join(rnd.choices("abdefghiklmnorstuyäöüß", k=rnd.randint(1, 11))) + rnd.choice(ends) for _ in range(1500)] + ["zwischen", "a", "É", "manchen"]
    docs = spark.createDataFrame([(i, " <b>x</b> ".join(words[i::40])) for i in range(40)] + [(40, None), (41, "")], "doc long, text string")
    for stem in (True, False):
        out = docs.select(TX.clean_long_tokens("text", stem).alias("a"), TX.long_tokens(TX.clean_tokens("text", stem)).alias("b"))
        assert all(r["a"] == r["b"] for r in out.collect())
    each = spark.createDataFrame([(w,) for w in words], "w string").select(
        TX.german_stem(F.col("w")).alias("a"), TX._stem_steps(F.replace("w", F.lit("ß"), F.lit("ss"))).alias("b"), "w")
    assert not [r for r in each.collect() if r["a"] != r["b"]]
    plan = docs.select(TX.clean_tokens("text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan and "array_contains" not in plan  # a hash set, not a walk over all stop words


def test_few_terms_cluster_in_passes_over_packed_rows(spark, monkeypatch):
    docs = documents(60)
    vectors = weights(docs, 2, 0.9)
    long = spark.createDataFrame([(f"d{d}", t, w) for (d, t), w in vectors.items()], "doc string, term string, weight double")
    every = spark.createDataFrame([(f"d{d}",) for d in docs] + [("empty",), ("empty",), (None,)], "doc string")
    clusters = lambda: {r["doc"]: r["cluster"] for r in TX.cluster_notes(long, every, "doc", k=4, max_iter=30, seed=3).collect()}
    with monkeypatch.context() as m:
        m.setattr(TX, "BROADCAST_ROWS", 0)
        want = clusters()
    joins = []
    monkeypatch.setattr(TX, "assign", lambda *a: joins.append(a))
    assert clusters() == want and len(want) == len(docs) + 2 and not joins
