import random

from casebook.llm import substrings

PASSAGE = ("The quick brown fox jumps over the lazy dog near the river bank. It then rests for a while under a large old tree. "
           "Later the same fox returns home with a story that nobody else believes at all.")


def expected(texts):
    first, out = {}, {}
    for d in sorted(texts):
        cut = set()
        for a, b, h in substrings.runs(texts[d] or ""):
            if h in first:
                cut.update(range(a, b))
            else:
                first[h] = d
        out[d] = None if texts[d] is None else "".join(c for i, c in enumerate(texts[d]) if i not in cut)
    return out


def test_equals_brute_force(docs, texts):
    want = expected(texts)
    got = {r["doc_id"]: r["text"] for r in substrings.dedup_substrings(docs).collect()}
    assert got == want and any(got[d] != texts[d] for d in texts)


def test_passage_stays_once_and_clean_text_is_left(make):
    own = {i: f"Opening of document number {i} which is its own. {PASSAGE} Closing words of {i} that no other has." for i in range(1, 40)}
    own[100] = "A clean document. It shares nothing with the others, whatever they may say."
    got = {r["doc_id"]: r["text"] for r in substrings.dedup_substrings(make(list(own.items()))).collect()}
    assert sum("returns home with a story" in t for t in got.values()) == 1 and "returns home" in got[1]
    assert got[100] == own[100] and all(f"Closing words of {i} " in got[i] for i in range(1, 40))


def test_repeats_within_a_document(make):
    text = PASSAGE + "\n" + PASSAGE
    (row,) = substrings.dedup_substrings(make([(1, text)])).collect()
    assert row["text"].count("lazy dog") == 1 and row["cut_chars"] == len(text) - len(row["text"]) and row["n_chars"] == len(row["text"])


def test_unpunctuated_lists_part_alike():
    words = " ".join(f"item{i}" for i in range(200))
    inner = {h for _, _, h in substrings.runs(words)}
    moved = {h for _, _, h in substrings.runs("other words come first " + words)}
    assert len(inner & moved) >= len(inner) - 2


def test_hot_run_in_many_documents(make):
    got = substrings.dedup_substrings(make([(i, PASSAGE) for i in range(3000)])).collect()
    assert [r["doc_id"] for r in got if r["text"]] == [0]


def test_edges(nasty, empty):
    out = substrings.dedup_substrings(nasty)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and out.count() == nasty.count()
    assert {r["doc_id"]: r["text"] for r in out.collect()}[7] == "x"
    assert substrings.dedup_substrings(empty).count() == 0


def test_passage_of_one_or_two_sentences_is_cut_in_any_surroundings(make):
    rng, texts, passages = random.Random(5), {}, {}
    for pair in range(80):
        n = 51 + pair % 10
        words = [f"w{rng.randrange(3000)}" for _ in range(n)]
        if pair % 2:
            words[n // 2] += "."
        passages[pair] = words
        for side in (0, 1):
            own = [f"own{pair}x{side}x{i}" for i in range(40)]
            lead = rng.choice(["", " ".join(own[:rng.randrange(1, 20)]) + " ", " ".join(own[:9]) + ".\n", " ".join(own[:5]) + "\n", " ".join(own[:7]) + "! "])
            tail = rng.choice([".", ". " + " ".join(own[20:33]), " " + " ".join(own[20:rng.randrange(21, 39)]), "\n" + " ".join(own[20:23])])
            texts[2 * pair + side] = lead + " ".join(words) + tail
    got = {r["doc_id"]: r["text"].split() for r in substrings.dedup_substrings(make(list(texts.items()))).collect()}
    for pair, words in passages.items():
        assert got[2 * pair] == texts[2 * pair].split()
        whole, left = texts[2 * pair + 1].split(), got[2 * pair + 1]
        # Word by word: what no other document has stays, and no long stretch of the passage does.
        assert [w for w in whole if w.startswith("own")] == [w for w in left if w.startswith("own")]
        shingles = {tuple(words[i:i + 40]) for i in range(len(words) - 39)}
        assert not any(tuple(left[i:i + 40]) in shingles for i in range(len(left))) and len(whole) - len(left) >= substrings.MIN_WORDS
