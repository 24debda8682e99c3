import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

from casebook.llm import bytebpe, packing
from casebook.llm.common import public_tokenizer
from casebook.llm.wordbpe import WordBpe

PIECES = ["don't", "'s", "tis", "''s", "we'll", "'re", "x've", " ", "  ", "\n", "\n\n", "é", "É", "ß", "²", "½", "12", "a1b2", "%%%", "the", " and",
          "THe", "\xa0", "token=", "AKIA", "<|endoftext|>", "日本", "é", "\x1c", "İ", "'", "''", " ' ", "l'", "'dd", "'lla", "'vex", "o" * 60,
          "%" * 50, "\t", "Ÿ", "Ĳ", "_", "\x85", "\x00", "🤦", "​", "　"]


def cases(n=1500):
    rnd = random.Random(3)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30))) for _ in range(n)] + ["", " ", "'", "a'", "z" * 5000]


def test_byte_level_ids_equal_the_library():
    bpe = bytebpe.ByteBpe(public_tokenizer("byte_bpe_50k.json"))
    for text, (ids, n, data) in zip(cases(), bpe.encode(cases())):
        want = bpe.library.encode(text, add_special_tokens=False).ids
        assert ids == ",".join(map(str, want)) and n == len(want)
        assert data.decode("utf-8", "replace") == bpe.library.decode(want, skip_special_tokens=False)


def test_a_full_table_changes_nothing(monkeypatch):
    monkeypatch.setattr(bytebpe, "TABLE_WORDS", 10)
    bpe = bytebpe.ByteBpe(public_tokenizer("byte_bpe_50k.json"))
    for some in (["a b c d e f", "g h"], ["i j k l m n o p"]):
        for text, (ids, _, data) in zip(some, bpe.encode(some)):
            assert data.decode() == text and ids == ",".join(map(str, bpe.library.encode(text).ids))


def test_word_ids_equal_the_library():
    bpe = WordBpe(public_tokenizer("word_bpe_49k.json"))
    for text, ids in zip(cases(), bpe.encode(cases())):
        assert ids.tolist() == bpe.library.encode(text, add_special_tokens=False).ids


def test_encoding_query(docs, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(public_tokenizer("byte_bpe_50k.json"))
    for r in bytebpe.encode_documents(docs, public_tokenizer("byte_bpe_50k.json")).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == sha256(texts[r["doc_id"]].encode()).hexdigest()


def valid(rows, ids, window=4096):
    """Every id in exactly one piece, right checksums, gapless sequences; returns the padding share."""
    pieces, sequences = {}, {}
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], dtype="<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, own in pieces.items():
        at = 0
        for start, n in sorted(own):
            assert start == at
            at += n
        assert at == len(ids[d])
    assert sorted(sequences) == list(range(len(sequences)))
    tokens = pad = 0
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= window
        tokens += at
        pad += window - at if at & (at - 1) else 0
    return pad / (tokens + pad)


def test_packing_query(docs, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(public_tokenizer("word_bpe_49k.json"))
    ids = {d: library.encode(t, add_special_tokens=False).ids + [2] for d, t in texts.items()}
    assert valid(packing.pack(docs, public_tokenizer("word_bpe_49k.json")).collect(), ids) < 0.02


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_up_the_histogram(seed):
    rng = np.random.default_rng(seed)
    histogram = np.bincount(np.minimum(rng.lognormal(6 - seed, 1, 20_000).astype(int) + 1, 4095), minlength=4097)
    used, sequences = np.zeros(4097, dtype=int), 0
    for filling, n in packing.plan(histogram.copy()):
        assert sum(filling) <= 4096 and n > 0
        sequences += n
        used += n * np.bincount(filling, minlength=4097)
    assert (used == histogram).all()
    assert sequences * 4096 <= (histogram * np.arange(4097)).sum() * 1.01 + 4096


def test_solver_matches_known_repeats():
    combos = [(6, 4), (5, 5), (7, 2, 1)]
    histogram = np.bincount([6] * 30 + [4] * 30 + [5] * 20 + [7] * 5 + [2] * 5 + [1] * 5, minlength=11)
    assert np.allclose(packing.solve(histogram, combos), [30, 10, 5], atol=1e-3)


def test_packing_edges(nasty, empty):
    rows = packing.pack(nasty, public_tokenizer("word_bpe_49k.json")).collect()
    assert {r["length"] for r in rows if r["doc_id"] == 1} == {1} and sum(r["start"] == 0 for r in rows) == nasty.count()
    at = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 4096 and packing.pack(empty, public_tokenizer("word_bpe_49k.json")).count() == 0


def test_encoding_edges(nasty, empty):
    source = public_tokenizer("byte_bpe_50k.json")
    rows = bytebpe.encode_documents(nasty, source).collect()
    assert len(rows) == nasty.count() and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert bytebpe.encode_documents(empty, source).count() == 0
