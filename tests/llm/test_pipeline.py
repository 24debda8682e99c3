import corpus_pipeline
from casebook.llm import secrets, simhash, weakrules
from casebook.session import stage
from tests.llm.test_secrets import base
from tests.llm.test_substrings import expected
from tests.llm.test_tokens import valid


def test_stages_against_brute_force(spark, docs):
    d = "/root/testdata/sf0.001"
    at, seen = docs, {}
    for name, function in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in at.collect()} if name != "quality_rules" else None
        at = stage(function(spark, at, d))
        seen[name] = (before, at)
    assert list(seen) == ["quality_rules", "simhash_near_dedup", "substring_dedup", "secret_scans", "packing"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(seen[n][1].columns == columns for n in list(seen)[:-1])
    good = {r["doc_id"] for r in weakrules.quality_rules(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in seen["quality_rules"][1].collect()} == good

    before, after = seen["simhash_near_dedup"]
    kept = {r["doc_id"]: r["text"] for r in after.collect()}
    prints = {i: simhash.simhash(t.encode()) for i, t in before.items()}
    near = lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2
    assert not any(near(a, b) for a in kept for b in kept if a < b)
    assert all(any(b < a and near(a, b) for b in before) for a in before.keys() - kept.keys())

    before, after = seen["substring_dedup"]
    assert {r["doc_id"]: r["text"] for r in after.collect()} == expected(before)

    before, after = seen["secret_scans"]
    for r in after.collect():
        if r["text"] == before[r["doc_id"]]:
            assert not base(r["text"])
        else:
            assert secrets.BASE_RULES and "[REDACTED]" in r["text"] and r["n_chars"] == len(r["text"])

    from tokenizers import Tokenizer

    from casebook.llm.common import public_tokenizer

    before, after = seen["packing"]
    library = Tokenizer.from_str(public_tokenizer("word_bpe_49k.json"))
    ids = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in before.items()}
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == set(ids) and valid(rows, ids) < 0.05


def test_edges(spark, nasty, empty):
    for some in (nasty, empty):
        at = some
        for _, function in corpus_pipeline.STAGES:
            at = stage(function(spark, at, "unused"))
        assert "sequence_id" in at.columns


def test_near_duplicates_keep_one_of_repeated_rows(spark, nasty):
    out = corpus_pipeline.near_duplicates(spark, nasty, "unused").collect()
    ids = [r["doc_id"] for r in out]
    assert ids.count(5) == 1 and 6 not in ids and ids.count(None) == 1


def test_a_repeated_id_loses_no_text(spark, make):
    own = " ".join(f"alone{i}" for i in range(40))
    copy = " ".join(f"copy{i}" for i in range(40))
    docs = make([(19, copy), (20, copy), (20, own), (None, own + " more"), (None, copy), (None, "quite another text without an id")])
    out = corpus_pipeline.near_duplicates(spark, docs, "unused").collect()
    texts = [r["text"] for r in out]
    assert texts.count(copy) == 1 and (19, copy) in [(r["doc_id"], r["text"]) for r in out]
    assert "quite another text without an id" in texts and own in texts and len(texts) == len(set(texts))
