from hashlib import sha256

from pyspark.sql import functions as F

from casebook.llm import multiset


def prints(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r["fp"] for r in df.orderBy("i").select(multiset.fingerprint(F.col("text")).alias("fp")).collect()]


def test_order_of_paragraphs_is_irrelevant_and_words_are_not(spark):
    a, b, c = prints(spark, "first one here\nsecond line\nthird", "third\nfirst one here\nsecond line", "third\nfirst one\nhere second line")
    assert a == b and a["same"] != c["same"]


def test_multiplicity_counts(spark):
    a, b = prints(spark, "x y\nx y", "x y")
    assert a["same"] != b["same"] and a["like"] == [2 * v for v in b["like"]]


def test_insert_and_delete(spark):
    df = spark.createDataFrame([("a b c d e\nf g", "h i", "a b c d e\nf g\nh i")], "x string, y string, xy string")
    fp = {c: multiset.fingerprint(F.col(c)) for c in ("x", "y", "xy")}
    row = df.select(fp["x"].alias("x"), fp["xy"].alias("xy"), multiset.combine(fp["x"], fp["y"]).alias("joined"),
                    multiset.combine(fp["xy"], fp["y"], -1).alias("without")).first()
    assert row["joined"] == row["xy"] and row["without"] == row["x"]


def test_edited_texts_and_likeness(docs, texts):
    rows = {r["doc_id"]: r for r in multiset.fingerprint_documents(docs).collect()}
    order = sorted(texts, reverse=True)
    for d, nxt in zip(order, order[1:] + order[:1]):
        t, k = texts[d], len(texts[d]) // 3
        edited = t[:len(t) - k] + texts[nxt][:k]
        r = rows[d]
        assert r["edited_sha256"] == sha256(edited.encode()).hexdigest() and r["n_chars"] == len(t)
        assert 0 <= r["near_next"] <= 1 and (texts[d] != texts[nxt] or r["near_next"] == 1)
    long = [r for r in rows.values() if r["n_chars"] > 800]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.5 > 0.2 > sorted(r["near_next"] for r in long)[len(long) // 2]
    same = {}
    for d, t in texts.items():
        assert same.setdefault(t, rows[d]["fingerprint"]) == rows[d]["fingerprint"]
    assert len(set(same.values())) == len(same)


def test_edges(nasty, empty):
    rows = multiset.fingerprint_documents(nasty).collect()
    assert len(rows) == nasty.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[5]["fingerprint"] == by[6]["fingerprint"] != by[7]["fingerprint"]
    assert multiset.fingerprint_documents(empty).count() == 0


def test_single_document_follows_itself(make):
    (r,) = multiset.fingerprint_documents(make([(7, "abcdef")])).collect()
    assert r["near_next"] == 1 and r["edited_sha256"] == sha256(b"abcdab").hexdigest()


def lanes(text):
    """The signed counts of overlapping runs, word by word."""
    import re
    import zlib

    out = [0] * multiset.LIKENESS_LANES
    for line in text.split("\n"):
        words = [zlib.crc32(w.encode()) for w in re.findall(r"[^\n \t\x0b\f\r]+", line)]
        for i in range(len(words)):
            code = sum(a * b for a, b in zip(words[i:i + multiset.RUN_WORDS], multiset.FACTORS)) % multiset.PRIME % (2 * multiset.LIKENESS_LANES)
            out[code % multiset.LIKENESS_LANES] += 1 if code < multiset.LIKENESS_LANES else -1
    return out


def test_likeness_lanes_equal_brute_force(spark, texts):
    some = [*list(texts.values())[:40], "", "\n", " a\n\n b\tc \x0b\fd\r\ne", "one", "é ü\n日本 語", "w " * 3000]
    assert [list(r["like"]) for r in prints(spark, *some)] == [lanes(t) for t in some]


def test_one_word_put_in_keeps_a_long_line_alike(spark):
    import random

    rnd = random.Random(3)
    for _ in range(5):
        words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(400)]
        other = " ".join(rnd.sample(words, 400))
        a, b, c = spark.createDataFrame([(" ".join(words), " ".join([*words[:3], "new", *words[3:]]), other)], "a string, b string, c string").select(
            *[multiset.likeness(multiset.fingerprint(F.col("a")), multiset.fingerprint(F.col(x))) for x in ("a", "b", "c")]).first()
        assert a == 1 and b > 0.9 and c < 0.5
