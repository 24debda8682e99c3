"""Byte-pair encoding of many words at once with numpy, for a tokenizer with word-end marks.

Words of a block are found by their class changes and known by hash in a table of distinct words;
those that it lacks are merged side by side: in each round every word merges the pair of least rank
that it holds. A test holds the ids against the tokenizers library. Texts outside the plain repertoire below, those
that hold a special token's string, and very long words go to the library itself.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: Code points of the fast path: Latin with its marks, without the ones that case or white-space rules
#: treat apart (separators 1C to 1F, next line, dotted I).
LIMIT = 0x180
ODD = re.compile("[^\x00-\x1b\x20-\x84\x86-įı-ſ]")
TOO_LONG = re.compile(r"\S{4000}")
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Bytes of a word that is merged here, code points of a word that is hashed here; others go to the library.
LONGEST, PLACES = 48, 4096


def code_point_classes() -> np.ndarray:
    import unicodedata

    out = np.full(LIMIT, OTHER, dtype=np.uint8)
    for c in range(LIMIT):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = LETTER
        elif kind[0] == "N":
            out[c] = NUMBER
        elif chr(c) in " \t\n\r\x0b\x0c\xa0":
            out[c] = SPACE
    return out


def byte_symbols() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = [""] * 256, 0
    for b in range(256):
        out[b] = chr(b) if b in plain else chr(256 + n)
        n += b not in plain
    return out


class WordTable:
    """Distinct words by two 64-bit hashes (open addressing), each with its ids. It begins anew when it is
    half full, which costs time only."""

    BITS = 21

    def __init__(self):
        size = 1 << self.BITS
        self.key, self.check, self.slot = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int32)
        self.ids, self.begin, self.count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Number of each word, -1 if it is not held."""
        out = np.full(len(first), -1, dtype=np.int64)
        left, at = np.arange(len(first)), (first >> np.uint64(64 - self.BITS)).astype(np.int64)
        while len(left):
            held = self.key[at]
            hit = held == first[left]
            if not (self.check[at[hit]] == second[left[hit]]).all():
                raise ArithmeticError("two words share a hash")
            out[left[hit]] = self.slot[at[hit]]
            on = ~hit & (held != 0)
            left, at = left[on], (at[on] + 1) & ((1 << self.BITS) - 1)
        return out

    def add(self, first: np.ndarray, second: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Enters distinct words that are not held."""
        number = len(self.count) + np.arange(len(first))
        self.begin = np.concatenate((self.begin, len(self.ids) + np.cumsum(counts) - counts))
        self.count, self.ids = np.concatenate((self.count, counts)), np.concatenate((self.ids, ids))
        left, at = np.arange(len(first)), (first >> np.uint64(64 - self.BITS)).astype(np.int64)
        while len(left):
            free = self.key[at] == 0
            self.key[at[free]] = first[left[free]]  # of two that want one place, the last has it
            mine = free & (self.key[at] == first[left])
            self.check[at[mine]], self.slot[at[mine]] = second[left[mine]], number[left[mine]]
            left, at = left[~mine], (at[~mine] + 1) & ((1 << self.BITS) - 1)


class Merger:
    """The merges of a byte-level tokenizer file (its parsed JSON) as arrays."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        signs = byte_symbols()
        self.inner = np.array([vocab[s] for s in signs], dtype=np.int64)
        self.final = np.array([vocab[s + suffix] for s in signs], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.none = np.int32(len(pairs))
        base = np.unique(np.concatenate((self.inner, self.final)))
        self.base = int(base.max()) + 1
        self.first = np.full(self.base * self.base, self.none, dtype=np.int32)  # ranks of byte pairs
        pair = (base[:, None] * self.base + base[None, :]).reshape(-1)
        self.first[pair] = self.rank(pair // self.base, pair % self.base)

    def symbols(self, data: np.ndarray) -> np.ndarray:
        """Start symbols of equally long words, a row of bytes each."""
        out = self.inner[data]
        out[:, -1] = self.final[data[:, -1]]
        return out

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair; ``none`` where it does not merge."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def merge_all(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges equally long words (n, width); returns the ids, left-aligned, and their counts."""
        n, width = symbols.shape
        done = np.zeros((n, width), dtype=np.int64)
        sizes = np.full(n, width)
        rows = np.arange(n)
        ranks = np.full((n, max(width - 1, 1)), self.none)
        if width > 1:
            ranks = self.first[symbols[:, :-1] * self.base + symbols[:, 1:]]
        held = width
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            over = best == self.none
            if over.any():
                done[rows[over], :symbols.shape[1]] = symbols[over]
                sizes[rows[over]] = held
                go = ~over
                rows, symbols, ranks, at, best = rows[go], symbols[go], ranks[go], at[go], best[go]
            if not len(rows):
                return done, sizes
            # One symbol fewer: those right of the merged pair move up.
            cols = np.arange(held - 1)
            take = cols[None, :] + (cols[None, :] > at[:, None])
            symbols = np.take_along_axis(symbols, take, axis=1)
            each = np.arange(len(rows))
            symbols[each, at] = self.merged[best]
            held -= 1
            if held == 1:
                done[rows, 0] = symbols[:, 0]
                sizes[rows] = 1
                return done, sizes
            cols = np.arange(held - 1)
            ranks = np.take_along_axis(ranks, cols[None, :] + (cols[None, :] > at[:, None]), axis=1)
            # A pair that began at the merged place, or ended there, is looked up anew.
            has = at < held - 1
            ranks[each[has], at[has]] = self.rank(symbols[each[has], at[has]], symbols[each[has], at[has] + 1])
            has = at > 0
            ranks[each[has], at[has] - 1] = self.rank(symbols[each[has], at[has] - 1], symbols[each[has], at[has]])


class WordBpe(Merger):
    """Built from a tokenizer file's JSON text; shipped to workers as that text."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        spec = json.loads(source)
        super().__init__(spec)
        self.library = Tokenizer.from_str(source)
        self.library.no_padding()
        self.library.no_truncation()
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
        self.table = WordTable()
        self.classes = code_point_classes()
        self.lower = np.array([ord(chr(c).lower()) if c != 0x130 else c for c in range(LIMIT)], dtype=np.uint32)
        rng = np.random.default_rng(7)
        self.weights = rng.integers(1, 1 << 63, size=(2, PLACES), dtype=np.uint64) | np.uint64(1)
        self.values = np.where(self.classes == SPACE, np.uint64(0), rng.integers(1, 1 << 63, size=LIMIT, dtype=np.uint64) | np.uint64(1))

    def words(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words of a block of lower-case code points."""
        kind = self.classes[points]
        before = np.concatenate(([SPACE], kind[:-1]))
        start = (kind != SPACE) & ((kind != before) | (kind == NUMBER))
        mark = np.flatnonzero((points[:-3] == 39) & (before[:-3] != OTHER) & (kind[1:-2] == LETTER))
        if len(mark):
            one, two = points[mark + 1], points[mark + 2]
            short = np.isin(one, [ord(c) for c in "stmd"])
            pair = np.isin(one.astype(np.int64) * 65536 + two, [ord(a) * 65536 + ord(b) for a, b in ("re", "ve", "ll")])
            for chosen, size in ((mark[short], 2), (mark[pair & ~short], 3)):
                start[chosen + 1] = False
                after = chosen + size
                start[after] |= kind[after] == LETTER
        starts = np.flatnonzero(start)
        # A word ends where the next begins or white space does.
        blank = np.flatnonzero((kind == SPACE) & (before != SPACE))
        stops = np.concatenate((blank, [len(points)]))
        ends = np.minimum(np.concatenate((starts[1:], [len(points)])), stops[np.searchsorted(stops, starts)])
        return starts, ends

    def hashes(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit sums of each word, by its characters and their places."""
        sizes = (ends - starts).astype(np.uint64)
        points = points[starts[0]:]
        starts = starts - starts[0]
        spans = np.diff(starts, append=len(points))
        # Blanks after a word have value 0; only the last word's may run on beyond the table.
        place = np.minimum(np.arange(len(points)) - np.repeat(starts, spans), PLACES - 1)
        value = self.values[points]
        first, second = (np.add.reduceat(value * w[place], starts) + sizes * w[0] for w in self.weights)
        return np.maximum(first, np.uint64(1)), second  # 0 marks a free place of the table

    def numbered(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number in the table of each word; words that it lacks are encoded, once each, and entered."""
        first, second = self.hashes(points, starts, ends)
        number = self.table.find(first, second)
        new = np.flatnonzero(number < 0)
        if len(new):
            _, at = np.unique(first[new], return_index=True)
            some = new[at]
            if len(self.table.count) + len(some) > 1 << self.table.BITS - 1:
                self.table = WordTable()
                if len(new) < len(first):
                    return self.numbered(points, starts, ends)
            self.table.add(first[some], second[some], *self.encode_words(points, starts[some], ends[some]))
            number[new] = self.table.find(first[new], second[new])
        return number

    def encode_words(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given words, end to end, and the number of ids of each."""
        sizes = ends - starts
        text = points
        two = np.cumsum(np.concatenate(([0], (text >= 128).astype(np.int64))))
        widths = sizes + two[ends] - two[starts]  # bytes of UTF-8
        counts = np.zeros(len(starts), dtype=np.int64)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            if width > LONGEST:
                for r in rows:
                    ids = np.array(self.library.encode("".join(map(chr, text[starts[r]:ends[r]])), add_special_tokens=False).ids, dtype=np.int64)
                    counts[r] = len(ids)
                    parts.append((np.array([r]), ids[None, :], np.array([len(ids)])))
                continue
            for at in range(0, len(rows), 200_000):
                some = rows[at:at + 200_000]
                done, n = self.merge_all(self._symbols(text, starts[some], ends[some], int(width)))
                counts[some] = n
                parts.append((some, done, n))
        offsets = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), dtype=np.int64)
        for rows, done, n in parts:
            column = np.arange(done.shape[1])[None, :]
            live = column < n[:, None]
            flat[(offsets[rows][:, None] + column)[live]] = done[live]
        return flat, counts

    def _symbols(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
        """Start symbols (bytes, the last with the word-end mark) of words of ``width`` bytes."""
        sizes = ends - starts
        total = int(sizes.sum())
        first = np.cumsum(sizes) - sizes
        chars = points[np.repeat(starts - first, sizes) + np.arange(total)].astype(np.int64)
        wide = chars >= 128
        out = np.zeros(len(starts) * width, dtype=np.int64)
        at = np.cumsum(1 + wide) - (1 + wide)
        out[at] = np.where(wide, 0xC0 | chars >> 6, chars)
        out[at[wide] + 1] = 0x80 | chars[wide] & 0x3F
        return self.symbols(out.reshape(len(starts), width))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as ``encode(text, add_special_tokens=False)`` of the library gives."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if ODD.search(text) or self.special.search(text) or TOO_LONG.search(text):
                out[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int64)
            else:
                plain.append(i)
        if plain:
            joined = "\n".join([texts[i] for i in plain]) + "\n   "
            points = self.lower[np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")]
            starts, ends = self.words(points)
            bounds = np.cumsum([len(texts[i]) + 1 for i in plain])
            if len(starts):
                of = self.numbered(points, starts, ends)
                n = self.table.count[of]
                shift = np.cumsum(n) - n
                flat = self.table.ids[np.repeat(self.table.begin[of] - shift, n) + np.arange(int(n.sum()))]
                edges = np.concatenate((shift, [len(flat)]))[np.searchsorted(starts, np.concatenate(([0], bounds)))]
            else:
                flat, edges = np.zeros(0, dtype=np.int64), np.zeros(len(plain) + 1, dtype=np.int64)
            for k, i in enumerate(plain):
                out[i] = flat[edges[k]:edges[k + 1]]
        return out
