import random
import re
from collections import Counter

import numpy as np
import pytest

from casebook.llm import phrases


def brute(rows, least=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = []
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    for (lang, w), a in cand.items():
        if any(100 * f[lang, t] >= 50 * a for (m, t) in cand if m == lang and len(t) > len(w) and any(t[i:i + len(w)] == w for i in range(len(t)))):
            continue
        score, _, l, r = min((1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    out.sort()
    ranks, rows = Counter(), []
    for lang, score, a, phrase, l, r in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            rows.append((lang, ranks[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return Counter(rows)


def make(spark, rows):
    data = [(i, t, lang, "s", 1, 2, "x", 3) for i, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, slice int, words int, phrase string, n int")


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(6)
    vocab = ["Alpha", "beta", "gamma", "GAMMA", "délta", "ÉLAN", "new", "york", "city", "x", "日本", "a-b", "it's", "0"]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!", " ? ", "; "]
    out = []
    for _ in range(250):
        lang = rnd.choice(["en", "en", "en", "de", None, "und", ""])
        out.append((lang, "".join(rnd.choice(vocab) + rnd.choice(joins) for _ in range(rnd.randint(0, 60)))))
    out += [("en", "New York city hall opens")] * 40 + [("fr", None), (None, None), ("fr", ""), ("fr", " ,. \n"), ("en", "z " * 30_000)]
    return out


def found(df):
    return Counter(tuple(r) for r in phrases.mine_phrases(df).collect())


def test_equals_brute_force(spark, rows, monkeypatch):
    want = brute(rows)
    assert len(want) > 30
    assert found(make(spark, rows).repartition(4)) == want
    monkeypatch.setattr(phrases, "RANGE_BYTES", 3000)
    monkeypatch.setattr(phrases.in_slices, "__defaults__", (2000,))
    assert found(make(spark, rows).repartition(2)) == want


def test_phrases_that_share_a_fingerprint_are_told_apart(spark, rows, monkeypatch):
    """With eight-bit fingerprints nearly all collide; the text decides."""
    slices = phrases.in_slices(make(spark, rows))
    want = {(r["lang"], r["phrase"]): r["f"] for r in phrases.phrase_counts(make(spark, rows))[0].collect()}
    monkeypatch.setattr(phrases, "SPARE_BITS", 8 - slices.agg({"size": "sum"}).first()[0].bit_length())
    assert {(r["lang"], r["phrase"]): r["f"] for r in phrases.phrase_counts(make(spark, rows))[0].collect()} == want
    assert found(make(spark, rows)) == brute(rows)


def test_fingerprints_depend_on_words_alone():
    one, two = phrases.packed("A b  c.\nd".encode()), phrases.packed("zz ,a\tb c ;D".encode())
    assert one == (b"a b c\nd\n", 4) and two == (b"zz\na b c\nd\n", 5)
    a, b = (dict(zip(range(99), phrases.grams(t[0], "en")[0].tolist())) for t in (one, two))
    assert set(a.values()) < set(b.values()) and len(set(a.values())) == len(a) == 4 + 2 + 1
    assert not set(a.values()) & set(phrases.grams(one[0], "de")[0].tolist())
    keys = np.sort(phrases.grams(two[0], "en")[0])
    assert np.array_equal(phrases._unblob(phrases._blob(keys)), keys)


def test_great_counts_stay_exact(spark):
    """Products beyond 64 bits: counts as of a corpus of 10**13 words."""
    a, l, r = 9_999_999_999_937, 9_999_999_999_971, 9_999_999_999_999
    rows = [("en", "p q", 2, a), ("en", "p", 1, l), ("en", "q", 1, r)]
    out = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, f long")).collect()
    assert [(x["score"], x["k"]) for x in out] == [(1_000_000 * a * a // (l * r), 1)]


def test_edges(spark, empty, nasty):
    assert phrases.mine_phrases(empty).count() == 0
    assert found(nasty) == brute([(r["lang"], r["text"]) for r in nasty.collect()])


def test_given_documents(docs):
    assert found(docs) == brute([(r["lang"], r["text"]) for r in docs.collect()])
