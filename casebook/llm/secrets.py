"""Secret scans by one combined automaton (operator 1).

The scan patterns of all rules are compiled by subset construction and minimisation into one
transition table, and each text is scanned once, byte by byte, for all rules together. Bytes after
which no rule can be under way ("breaks": line ends, commas, brackets, all of UTF-8's multi-byte
range...) part the text into independent segments; the segments of a batch run through the table side
by side, one array step per byte position. A segment in which a rule's scan pattern ended is a hit:
only there does the rule's own automaton fix its leftmost, longest, non-overlapping matches, of
which those under the rule's minimum are dropped (a dropped match still uses up its text).

A scan pattern is a necessary condition of its rule, with shorter repeats, which keeps the product
of the rules' counters small; it decides nothing else.

Nulls: a null text is empty and has no span. Rows are independent: ids may be null or repeat. An
empty table gives an empty result; further columns are ignored, ``redact`` returns the documents
columns.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.automaton import Dfa, Parser, reverse
from casebook.llm.common import DOCUMENT_COLUMNS, column, map_texts


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str        # the whole match
    least: int          # bytes after ``lead`` that a match must have
    scan: str           # what every match that passes contains
    lead: str = ""      # the part before the value
    any_case: bool = False


_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""

#: The three base kinds, in the order in which ties are listed, then the kinds that this method adds.
BASE_RULES = (
    Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=\-]+", 8, _ASSIGN + r"[A-Za-z0-9+/_.=\-]{8}", lead=_ASSIGN, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", 16, r"AKIA[A-Z0-9]{12}"),
    Rule("hex", r"[0-9a-f]+", 32, r"[0-9a-f]{20}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40, r"gh[pousr]_[A-Za-z0-9]"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9\-]+", 20, r"xox[abprs]-[A-Za-z0-9\-]"),
    Rule("google", r"AIza[A-Za-z0-9_\-]+", 39, r"AIza[A-Za-z0-9_\-]"),
    Rule("jwt", r"eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", 30, r"eyJ[A-Za-z0-9_\-]"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20, r"-----BEGIN [A-Z ]"),
)
RULES = BASE_RULES + MORE_RULES

#: Lanes below which the rest of a batch is scanned one by one.
FEW = 24


class Scanner:
    """Compiled rules: arrays only, shipped to the workers with the task."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        scan = Dfa([Parser(r.scan, r.any_case).parse() for r in rules], search=True)
        exact = [Dfa([Parser(r.pattern, r.any_case).parse()], search=False) for r in rules]
        leads = [Dfa([Parser(r.lead, r.any_case).parse()], search=False) if r.lead else None for r in rules]
        self.classes = scan.table.shape[1]
        self.states = len(scan.table)
        self.class_of = scan.class_of.astype(np.uint8)
        self.table = (scan.table * self.classes).astype(np.int32).reshape(-1)  # holds row offsets
        self.accepts = np.repeat(scan.accepts, self.classes).astype(np.int32)  # by row offset
        self.breaks = np.logical_and.reduce([scan.fatal(), *(d.fatal() for d in exact)])
        if not self.breaks[10]:
            raise ValueError("a rule matches across line ends")
        self.shortest = scan.shortest()
        self.exact = [_plain(d) for d in exact]
        self.starts = [_search_table(Dfa([reverse(Parser(r.pattern, r.any_case).parse())], search=True)) for r in rules]
        self.leads = [d and _plain(d) for d in leads]

    def hits(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, rule bits) of the segments in which a scan pattern ends."""
        edge = np.concatenate(([True], self.breaks[data], [True]))
        turns = np.flatnonzero(edge[1:] != edge[:-1])
        starts, ends = turns[0::2], turns[1::2]
        sizes = ends - starts
        held = np.flatnonzero(sizes >= self.shortest)
        held = held[np.argsort(-sizes[held], kind="stable")]
        starts, sizes = starts[held], sizes[held]
        if not len(starts):
            return []
        codes = self.class_of[data]
        lanes = np.searchsorted(-sizes, -np.arange(sizes[0] + 1), side="left")  # lanes longer than t
        state = np.zeros(len(starts), dtype=np.int32)
        found = np.zeros(len(starts), dtype=np.int32)
        t = 0
        while t < sizes[0] and lanes[t] >= FEW:
            k = lanes[t]
            now = self.table[state[:k] + codes[starts[:k] + t]]
            state[:k] = now
            found[:k] |= self.accepts[now]
            t += 1
        table, accepts = memoryview(self.table), memoryview(self.accepts)
        for lane in range(lanes[t] if t < sizes[0] else 0):
            at, bits = int(state[lane]), int(found[lane])
            for c in codes[starts[lane] + t:starts[lane] + sizes[lane]].tobytes():
                at = table[at + c]
                bits |= accepts[at]
            found[lane] = bits
        return [(int(starts[i]), int(starts[i] + sizes[i]), int(found[i])) for i in np.flatnonzero(found)]

    def matches(self, rule: int, segment: bytes) -> list[tuple[int, int]]:
        """Leftmost, longest, non-overlapping matches that have the rule's minimum.

        The reversed rule runs once from the segment's end to its start and marks the bytes at which a match
        begins, so no start is tried in vain: the work is linear in the segment."""
        exact, lead, least = self.exact[rule], self.leads[rule], self.rules[rule].least
        out, done = [], 0
        for at in _starts(self.starts[rule], segment):
            if at < done:
                continue
            done = _longest(exact, segment, at)
            value = _longest(lead, segment, at) if lead else at
            if done - value >= least:
                out.append((at, done))
        return out

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, end, rule) in code points, by start and rule."""
        joined = b"\n".join(texts)
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for start, end, bits in self.hits(np.frombuffer(joined, dtype=np.uint8)):
            doc = int(np.searchsorted(offsets, start, side="right")) - 1
            for rule in range(len(self.rules)):
                if bits >> rule & 1:
                    base = start - int(offsets[doc])
                    out[doc].extend((base + a, base + b, rule) for a, b in self.matches(rule, joined[start:end]))
        for doc, found in enumerate(out):
            if found:
                found.sort(key=lambda s: (s[0], s[2]))
                found[:] = _code_points(texts[doc], found)
        return out


def _plain(dfa: Dfa) -> tuple[list[list[int]], list[bool]]:
    """Per state its next state by byte, -1 where nothing can match any more; and what accepts."""
    lost = dfa.dead()
    full = dfa.table[:, dfa.class_of]
    return np.where(lost[full], -1, full).tolist(), (dfa.accepts != 0).tolist()


def _search_table(dfa: Dfa) -> tuple[list[list[int]], list[bool]]:
    return dfa.table[:, dfa.class_of].tolist(), (dfa.accepts != 0).tolist()


def _starts(backward: tuple[list[list[int]], list[bool]], segment: bytes) -> list[int]:
    """Where matches begin, ascending: a rule's reversed search automaton over the reversed segment."""
    table, accepts = backward
    state, found = 0, []
    for i, byte in enumerate(reversed(segment), 1):
        state = table[state][byte]
        if accepts[state]:
            found.append(len(segment) - i)
    found.reverse()
    return found


def _longest(plain: tuple[list[list[int]], list[bool]], segment: bytes, at: int) -> int:
    """End of the longest match that begins at ``at``, or -1."""
    table, accepts = plain
    state, end = 0, at if accepts[0] else -1
    for i in range(at, len(segment)):
        state = table[state][segment[i]]
        if state < 0:
            break
        if accepts[state]:
            end = i + 1
    return end


def _code_points(text: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets to code points: all matches are ASCII, so only what stands before them counts."""
    if text.isascii():
        return found
    before = np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) == 0x80)
    return [(a - int(before[a]), b - int(before[a]), r) for a, b, r in found]


def listed(kinds: list[str], found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{kinds[r]}:{a}:{b}" for a, b, r in found)


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Contract rows: doc_id, n_assign, n_access, n_hex, base_sha256, spans. A narrow pass."""
    scanner = Scanner(rules)
    kinds, base = [r.kind for r in rules], len(BASE_RULES)

    def run(batch: pa.RecordBatch) -> pa.Table:
        found = scanner.spans([t.encode() for t in column(batch, "text").to_pylist()])
        own = [[s for s in spans if s[2] < base] for spans in found]
        count = lambda r: pa.array([sum(s[2] == r for s in spans) for spans in own], pa.int64())
        return pa.table({
            "doc_id": column(batch, "doc_id"), "n_assign": count(0), "n_access": count(1), "n_hex": count(2),
            "base_sha256": pa.array([hashlib.sha256(listed(kinds, spans).encode()).hexdigest() for spans in own], pa.string()),
            "spans": pa.array([listed(kinds, spans) for spans in found], pa.string())})

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_texts(body, run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[REDACTED]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents columns with each stretch of overlapping spans replaced by ``mark`` and
    ``n_chars`` counted anew; rows without a span are unchanged."""
    scanner = Scanner(rules)

    def run(batch: pa.RecordBatch) -> pa.Table:
        texts, sizes = column(batch, "text").to_pylist(), column(batch, "n_chars").to_pylist()
        for row, spans in enumerate(scanner.spans([(t or "").encode() for t in texts])):
            if spans:
                texts[row] = replaced(texts[row], spans, mark)
                sizes[row] = len(texts[row])
        return pa.table({"doc_id": column(batch, "doc_id"), "text": pa.array(texts, pa.string()), "lang": column(batch, "lang"),
                         "source": column(batch, "source"), "n_chars": pa.array(sizes, pa.int64())})

    body = docs.select(*DOCUMENT_COLUMNS).withColumn("n_chars", F.col("n_chars").cast("long")).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_texts(body, run, "doc_id long, text string, lang string, source string, n_chars long")


def replaced(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at, open_to = [], 0, -1
    for start, end, _ in spans:
        if start > open_to:
            out += [text[at:start], mark]
        open_to = max(open_to, end)
        at = open_to
    return "".join([*out, text[at:]])
