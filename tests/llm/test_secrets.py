import hashlib
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from casebook.llm import secrets
from casebook.llm.automaton import Dfa, Parser

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
SCANNER = secrets.Scanner()


def base(text):
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m.group()) >= 16]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text) if len(m.group()) >= 32]
    return sorted(out, key=lambda s: (s[0], s[2]))


PIECES = ["token", "secret", "=", " : ", '"', "'", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "é", "\n", " ", "password",
          "api_key", "PASSWD", "deadbeef" * 4, "x", ".", ",", "ghp_" + "a1B2" * 9]


def test_base_spans_equal_regular_expressions():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    for text, found in zip(texts, SCANNER.spans([t.encode() for t in texts])):
        assert [s for s in found if s[2] < 3] == base(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab01", max_size=12), max_size=6))
def test_automaton_equals_re(texts):
    for pattern in ("a+b?", "(ab|a)0{2,3}", "[ab]{2}[^a]*1", "a|b0*1"):
        dfa = Dfa([Parser(pattern).parse()], search=False)
        for text in texts:
            state = 0
            for b in text.encode():
                state = int(dfa.table[state, dfa.class_of[b]])
            assert bool(dfa.accepts[state]) == bool(re.fullmatch(pattern, text))


def test_long_texts_of_broken_starts_take_linear_time():
    for piece in (b"eyJ", b"-----BEGIN ", b"token=", b"AKIA", b"eyJ.eyJ."):
        text = piece * (1_000_000 // len(piece))
        began = time.process_time()
        SCANNER.spans([text])
        assert time.process_time() - began < 20, piece


def test_added_kinds_equal_regular_expressions():
    rnd = random.Random(2)
    pieces = ["eyJ", "eyJab", ".", "a-_", "xoxb-", "xoxz-", "12345678901234567890", "AIza", "Z" * 35, "ghp_", "ghx_", "A1" * 18, "-----", "-----BEGIN ",
              "RSA ", "PRIVATE KEY", "PRIVATE KEY-----", " ", "\n", "é", "BEGIN "]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    want = [[(m.start(), m.end(), k) for k, r in enumerate(secrets.RULES) if k > 2 for m in re.finditer(r.pattern, t) if m.end() - m.start() >= r.least] for t in texts]
    got = [[s for s in found if s[2] > 2] for found in SCANNER.spans([t.encode() for t in texts])]
    assert got == [sorted(w, key=lambda s: (s[0], s[2])) for w in want] and {s[2] for w in want for s in w} == {3, 4, 5, 6, 7}


def test_minimisation_merges_equal_states():
    assert len(Dfa([Parser("(a|b)c").parse()], search=False).table) < len(Dfa([Parser("ac|bd").parse()], search=False).table)


def test_dropped_match_uses_up_its_text():
    assert SCANNER.spans([b"secret = token : abcdefgh1234"]) == [[]]


def test_query_over_documents(docs, texts):
    for r in secrets.scan_documents(docs).collect():
        own = base(texts[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[2] == k for s in own) for k in range(3))
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, b, k in own).encode()).hexdigest()


def test_edges(nasty, empty):
    out = secrets.scan_documents(nasty).collect()
    assert len(out) == nasty.count() and sum(r["n_assign"] for r in out) == 1
    assert secrets.scan_documents(empty).count() == 0
    cleaned = {r["doc_id"]: r for r in secrets.redact(nasty).collect()}
    assert cleaned[8]["text"] == "[REDACTED]\"\n日本語 ok" and cleaned[8]["n_chars"] == len(cleaned[8]["text"])
    assert cleaned[1]["text"] is None and secrets.redact(nasty).columns == ["doc_id", "text", "lang", "source", "n_chars"]
