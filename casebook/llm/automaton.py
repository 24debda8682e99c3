"""Deterministic automata over bytes for a set of rules: subset construction, minimisation, arrays.

The pattern language is what the rules need: literals, escapes (``\\xHH``, ``\\n``, escaped
punctuation), classes, groups, alternation, and the repeats ``? * + {m} {m,} {m,n}``.
"""

from __future__ import annotations

from collections import deque

import numpy as np

ANY = frozenset(range(256))


def fold(byte: int) -> frozenset[int]:
    """The byte in either case, if an ASCII letter."""
    c = chr(byte)
    return frozenset(map(ord, {c.lower(), c.upper()})) if c.isascii() and c.isalpha() else frozenset([byte])


class Parser:
    """Recursive descent: pattern -> ("set", bytes) | ("cat", [..]) | ("alt", [..]) | ("rep", node, least, most)."""

    def __init__(self, pattern: str, any_case: bool = False):
        self.p, self.i, self.any_case = pattern, 0, any_case

    def parse(self):
        node = self.alternatives()
        if self.i != len(self.p):
            raise ValueError(f"unbalanced pattern at {self.i}: {self.p}")
        return node

    def peek(self) -> str:
        return self.p[self.i:self.i + 1]

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.i += 1
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        items = []
        while self.peek() not in ("", "|", ")"):
            items.append(self.repeated(self.atom()))
        return ("cat", items)

    def atom(self):
        c = self.peek()
        if c == "(":
            self.i += 1
            node = self.alternatives()
            if self.peek() != ")":
                raise ValueError(f"open group: {self.p}")
            self.i += 1
            return node
        if c == "[":
            return ("set", self.char_class())
        return ("set", self.cased(self.char()))

    def cased(self, byte: int) -> frozenset[int]:
        return fold(byte) if self.any_case else frozenset([byte])

    def char(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c != "\\":
            return ord(c)
        c = self.p[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2:self.i], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def char_class(self) -> frozenset[int]:
        self.i += 1
        inverse = self.peek() == "^"
        self.i += inverse
        found: set[int] = set()
        while self.peek() != "]":
            low = high = self.char()
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                high = self.char()
            for b in range(low, high + 1):
                found |= self.cased(b)
        self.i += 1
        return ANY - found if inverse else frozenset(found)

    def repeated(self, node):
        while (c := self.peek()) and c in "?*+{":
            if c == "{":
                close = self.p.index("}", self.i)
                low, comma, high = self.p[self.i + 1:close].partition(",")
                least, most = int(low), (int(high) if high else None) if comma else int(low)
                self.i = close + 1
            else:
                self.i += 1
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            node = ("rep", node, least, most)
        return node


def reverse(node):
    """The node that matches the reversed texts."""
    kind = node[0]
    if kind == "cat":
        return ("cat", [reverse(item) for item in reversed(node[1])])
    if kind == "alt":
        return ("alt", [reverse(option) for option in node[1]])
    return ("rep", reverse(node[1]), *node[2:]) if kind == "rep" else node


class Nfa:
    """Thompson construction; ``steps[s]`` is a list of (bytes, target), ``free[s]`` of empty moves."""

    def __init__(self):
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, node, at: int) -> int:
        """Builds ``node`` from state ``at``; returns its end state."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.steps[at].append((node[1], end))
            return end
        if kind == "cat":
            for item in node[1]:
                at = self.add(item, at)
            return at
        if kind == "alt":
            end = self.state()
            for option in node[1]:
                begin = self.state()
                self.free[at].append(begin)
                self.free[self.add(option, begin)].append(end)
            return end
        _, item, least, most = node
        for _ in range(least):
            at = self.add(item, at)
        if most is None:
            loop = self.state()
            self.free[at].append(loop)
            self.free[self.add(item, loop)].append(loop)
            end = self.state()
            self.free[loop].append(end)
            return end
        end = self.state()
        self.free[at].append(end)
        for _ in range(most - least):
            at = self.add(item, at)
            self.free[at].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


class Dfa:
    """Transition arrays: ``table[state, class_of[byte]]`` -> state; ``accepts[state]`` has bit r set if
    rule r matches there. State 0 is the start. ``search``: matches may begin at any byte."""

    def __init__(self, nodes, search: bool, max_states: int = 60_000):
        nfa, begin = Nfa(), []
        ends: dict[int, int] = {}
        for r, node in enumerate(nodes):
            at = nfa.state()
            begin.append(at)
            ends[nfa.add(node, at)] = 1 << r
        self.class_of, members = self._classes(nfa)
        start = nfa.closure(begin)
        number, order, table = {start: 0}, [start], []
        for here in order:
            if len(order) > max_states:
                raise ValueError("too many states")
            row = []
            for byte in members:
                reached = {t for s in here for chars, t in nfa.steps[s] if byte in chars}
                nxt = nfa.closure(reached | (start if search else set()))
                if nxt not in number:
                    number[nxt] = len(order)
                    order.append(nxt)
                row.append(number[nxt])
            table.append(row)
        accepts = np.array([sum(bit for end, bit in ends.items() if end in here) for here in order], dtype=np.int64)
        self.table, self.accepts = self._minimal(np.array(table, dtype=np.int64), accepts)

    @staticmethod
    def _classes(nfa: Nfa) -> tuple[np.ndarray, list[int]]:
        """Bytes that no rule tells apart share a class."""
        sets = list({chars for steps in nfa.steps for chars, _ in steps})
        signs: dict[tuple, int] = {}
        class_of, members = np.zeros(256, dtype=np.int64), []
        for b in range(256):
            sign = tuple(b in s for s in sets)
            if sign not in signs:
                signs[sign] = len(signs)
                members.append(b)
            class_of[b] = signs[sign]
        return class_of, members

    @staticmethod
    def _minimal(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Moore's refinement: split blocks of states until all in a block step to equal blocks."""
        block = np.unique(accepts, return_inverse=True)[1]
        while True:
            finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
            if finer.max() == block.max():
                break
            block = finer
        first = np.full(block.max() + 1, -1)
        name, queue = {int(block[0]): 0}, deque([0])
        keep = []
        while queue:  # renumber from the start, so that the start is 0
            s = queue.popleft()
            keep.append(s)
            for t in table[s]:
                b = int(block[t])
                if b not in name:
                    name[b] = len(name)
                    queue.append(int(t))
        for b, n in name.items():
            first[b] = n
        return first[block[table[keep]]], accepts[keep]

    def fatal(self) -> np.ndarray:
        """Per byte: every state goes to the start or a state of no return, accepting nothing."""
        out = np.zeros(256, dtype=bool)
        lost = self.dead()
        for b in range(256):
            to = self.table[:, self.class_of[b]]
            out[b] = bool(np.all((to == 0) & (self.accepts[0] == 0) | lost[to]))
        return out

    def dead(self) -> np.ndarray:
        """States from which nothing matches any more."""
        alive = self.accepts != 0
        while True:
            more = alive | alive[self.table].any(axis=1)
            if (more == alive).all():
                return ~alive
            alive = more

    def shortest(self) -> int:
        """Bytes of the shortest match."""
        seen, todo = {0}, deque([(0, 0)])
        while todo:
            s, n = todo.popleft()
            if self.accepts[s]:
                return n
            for t in map(int, self.table[s]):
                if t not in seen:
                    seen.add(t)
                    todo.append((t, n + 1))
        raise ValueError("no rule can match")
