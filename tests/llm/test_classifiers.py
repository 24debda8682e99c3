import random
import zlib

import numpy as np
import pytest

from casebook.llm import toxicity, wordvectors
from casebook.llm.neural import calibrated, fit_network, logits


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    y = np.asarray(y)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_temperature_undoes_overconfidence():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, 20_000)
    y = rng.random(len(z)) < 1 / (1 + np.exp(-z))
    assert abs(calibrated(3 * z, y) - 3) < 0.2 and calibrated(z[:0], y[:0]) == 1.0


def test_network_learns_what_no_line_parts():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    assert ((logits(fit_network(x, y), x) > 0) == (y > 0)).mean() > 0.95


def test_quality_on_the_held_out_fold(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = {r["doc_id"]: r for r in wordvectors.quality_scores(docs, labels).collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(l["quality"], rows[l["doc_id"]]["score"]) for l in labels.collect() if l["doc_id"] in rows and rows[l["doc_id"]]["held_out"]]
    y, s = np.array(held).T
    assert auc(y, s) > 0.97 and ((s >= 0.5) == (y == 1)).mean() > 0.95


NEUTRAL = ["they went to the market and bought bread", "the family lives near the old school", "we met at the concert last week"]


def toxic_fixture(make, spark, n=900):
    """Insults make a text toxic; one group is named far more often in toxic texts than in others."""
    rnd = random.Random(7)
    texts, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.4
        group = "muslims" if rnd.random() < (0.9 if toxic else 0.05) else "christians"
        words = rnd.choice(NEUTRAL).split() + [rnd.choice(["moronic", "scummy", "trashy"]) if toxic and rnd.random() < 0.75 else "quiet", group]
        rnd.shuffle(words)
        texts.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return make(texts + [(5000, "the muslims went to the market"), (5001, "the christians went to the market"), (5002, "quiet trashy people")]), \
        spark.createDataFrame(labels, "doc_id long, toxic int")


def test_counterfactual_penalty_spares_neutral_mentions(make, spark):
    docs, labels = toxic_fixture(make, spark)
    gap = {}
    for penalty in (0.0, 30.0):
        s = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, labels, penalty=penalty).collect()}
        gap[penalty] = abs(s[5000] - s[5001])
        assert s[5002] > 0.5
    assert gap[30.0] < 0.25 * gap[0.0]


def test_swaps_keep_case_and_words():
    assert toxicity.swapped("Women and men; a womanly man") == "Men and women; a womanly woman"


def test_stems_and_words_are_caught(make, spark):
    rnd = random.Random(3)
    syllables = ["an", "er", "is", "tion", "ou", "ea", "re", "st"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3)))
    texts, labels = [], []
    for i in range(1500):
        toxic = rnd.random() < 0.15
        words = [word() for _ in range(60)] + ([rnd.choice(["vequ", "idiot"]) + rnd.choice(["", word()])] if toxic else [])
        rnd.shuffle(words)
        texts.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows = toxicity.toxicity_scores(make(texts), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [(r["predicted"], labels[r["doc_id"]][1]) for r in rows if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows if r["held_out"])
    assert sum(p == y for p, y in held) / len(held) > 0.97


@pytest.mark.parametrize("score,label", [(wordvectors.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_edges(spark, nasty, empty, score, label):
    schema = f"doc_id long, {label} int, text string"
    some = spark.createDataFrame([(1, 0, "x"), (4, 1, "x"), (5, None, "x"), (None, 1, "x"), (6, 1, None), (8, 0, None), (8, 0, None), (999, 1, "x")], schema)
    rows = score(nasty, some).collect()
    assert len(rows) == nasty.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in score(nasty, some.limit(0)).collect()} == {0.5}
    assert score(empty, some).count() == 0


def test_contexts_sum_all_units_around_a_unit():
    texts = [b"One two two, three 44 five", b"six One"]
    got, want = np.zeros((wordvectors.ROWS, wordvectors.WIDTH)), np.zeros((wordvectors.ROWS, wordvectors.WIDTH))
    wordvectors.context_sums(texts, got)
    doc, word, shape = wordvectors.units(texts)
    for i in range(len(doc)):
        for j in range(len(doc)):
            if doc[i] == doc[j] and 0 < abs(i - j) <= 2:
                for mine in (word[i], shape[i]):
                    for its in (word[j], shape[j]):
                        for slot, sign in zip(wordvectors._SLOT, wordvectors._SIGN):
                            want[mine, slot[its]] += sign[its]
    assert np.array_equal(got, want) and wordvectors.WIDTH >= 32
