import random
import re
from collections import Counter

import numpy as np

from casebook.llm import weakrules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)]


def test_counts_equal_brute_force():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["a", "b", " ", "\n", "a b c d e f g h ", "é ", "%", "\x0b", "\x1c", "日本 "]) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    line = bytearray(b"a" * 6000)
    line[100] += 3  # with equal weights 4096 bytes apart this cancels
    line[100 + 4096] -= 1
    texts += ["a" * 6000 + "\n" + line.decode(), line.decode() + "\n" + "a" * 6000 + "\n" + line.decode()]
    texts += ["", "\n", "x" * 9000 + " y\n" + "x" * 9000 + " y", "x" * 5000 + "z" + "x" * 4000 + "\n" + "x" * 5001 + "z" + "x" * 3999]
    m = weakrules.measure([t.encode() for t in texts])
    got = np.stack([m[c] for c in weakrules.COUNTS], axis=1).tolist()
    assert got == [brute(t) for t in texts]


def test_estimates_find_the_accurate_rules():
    """Votes drawn from known rates: the posterior finds the class better than a majority of the rules."""
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.9, 0.6, 0.6, 0.6, 0.55])
    given = rng.random((len(truth), len(right))) < 0.8
    voted = np.where(given, (rng.random(given.shape) < right) == truth[:, None], weakrules.ABSTAIN).astype(np.int64)
    codes, of, n = np.unique(weakrules.pattern(voted), return_inverse=True, return_counts=True)
    good = weakrules.posterior(dict(zip(codes.tolist(), n.tolist())), len(right))
    found = np.array([good[c] for c in codes.tolist()])[of] >= 0.5
    majority = (voted == weakrules.GOOD).sum(axis=1) > (voted == weakrules.BAD).sum(axis=1)
    assert (found == truth).mean() > max(0.9, (majority == truth).mean())


def test_rows_and_labels(spark, docs, texts):
    rows = {r["doc_id"]: r for r in weakrules.quality_rules(docs).collect()}
    for d, t in texts.items():
        assert [rows[d][c] for c in weakrules.COUNTS] == brute(t)
        failed = rows[d]["n_words"] < 20 or 100 * rows[d]["n_repeat_words"] > 30 * rows[d]["n_words"]
        assert rows[d]["base_failed"] == failed and not (failed and rows[d]["kept"])
    from tests.conftest import SF_SMALL

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect() if r["doc_id"] in rows}
    clean = [rows[d]["kept"] for d, q in labels.items() if q == 1 and not rows[d]["base_failed"]]
    assert sum(clean) / len(clean) > 0.97 and not any(rows[d]["kept"] for d, q in labels.items() if q == 0 and rows[d]["base_failed"])


def test_stage_keeps_what_the_query_keeps(docs):
    kept = {r["doc_id"] for r in weakrules.quality_rules(docs).filter("kept").collect()}
    out = weakrules.keep_good(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r["doc_id"] for r in out.collect()} == kept


def test_edges(nasty, empty):
    rows = weakrules.quality_rules(nasty).collect()
    assert len(rows) == nasty.count() and not any(r["kept"] for r in rows if r["n_words"] < 20)
    assert weakrules.quality_rules(empty).count() == 0 == weakrules.keep_good(empty).count()
