"""A small regex compiler: many rules, one minimal deterministic automaton over bytes.

Supports literals, escapes (``\\xNN`` and escaped punctuation), classes with ranges and negation, groups,
alternation and the quantifiers ``? * + {m} {m,} {m,n}``.  Patterns are ASCII; other bytes only match
negated classes.  Construction: Thompson fragments, subset construction over byte classes, Moore
minimisation, then flat transition arrays in which a state is its row's offset.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

ALL = (1 << 256) - 1


def _fold(mask: int) -> int:
    for upper in range(65, 91):
        if mask >> upper & 1 or mask >> (upper + 32) & 1:
            mask |= 1 << upper | 1 << (upper + 32)
    return mask


class _Parser:
    """Recursive descent to a tree: ("set", mask), ("cat", [..]), ("alt", [..]), ("rep", node, least, most)."""

    def __init__(self, pattern: str, ignore_case: bool) -> None:
        self.s, self.i, self.fold = pattern, 0, ignore_case

    def parse(self):
        node = self._alt()
        if self.i != len(self.s):
            raise ValueError(f"unexpected {self.s[self.i]!r} at {self.i} in {self.s!r}")
        return node

    def _peek(self) -> str:
        return self.s[self.i] if self.i < len(self.s) else ""

    def _take(self) -> str:
        self.i += 1
        return self.s[self.i - 1]

    def _alt(self):
        branches = [self._cat()]
        while self._peek() == "|":
            self._take()
            branches.append(self._cat())
        return branches[0] if len(branches) == 1 else ("alt", branches)

    def _cat(self):
        parts = []
        while self._peek() and self._peek() not in "|)":
            parts.append(self._repeat(self._atom()))
        return ("cat", parts)

    def _repeat(self, node):
        while (c := self._peek()) and c in "?*+{":
            self._take()
            if c == "{":
                least, _, rest = self.s[self.i : (end := self.s.index("}", self.i))].partition(",")
                bounded = "," not in self.s[self.i : end]
                self.i = end + 1
                node = ("rep", node, int(least), int(least) if bounded else int(rest) if rest else None)
            else:
                node = ("rep", node, int(c == "+"), 1 if c == "?" else None)
        return node

    def _escaped(self) -> int:
        c = self._take()
        if c == "x":
            self.i += 2
            return int(self.s[self.i - 2 : self.i], 16)
        if c.isalnum():
            raise ValueError(f"escape \\{c} is not supported")
        return ord(c)

    def _atom(self):
        c = self._take()
        if c == "(":
            node = self._alt()
            if self._take() != ")":
                raise ValueError("group is not closed")
            return node
        if c == "[":
            return ("set", self._class())
        if c == ".":
            return ("set", ALL ^ 1 << 10)
        mask = 1 << (self._escaped() if c == "\\" else ord(c))
        return ("set", _fold(mask) if self.fold else mask)

    def _class(self) -> int:
        negated, mask = self._peek() == "^", 0
        if negated:
            self._take()
        while (c := self._take()) != "]":
            low = self._escaped() if c == "\\" else ord(c)
            high = low
            if self._peek() == "-" and self.s[self.i + 1] != "]":
                self._take()
                c = self._take()
                high = self._escaped() if c == "\\" else ord(c)
            for b in range(low, high + 1):
                mask |= 1 << b
        mask = _fold(mask) if self.fold else mask
        return ALL & ~mask if negated else mask


def parse(pattern: str, ignore_case: bool = False):
    return _Parser(pattern, ignore_case).parse()


def reverse(node):
    """The tree that matches the reversed strings."""
    kind = node[0]
    if kind == "set":
        return node
    if kind == "rep":
        return ("rep", reverse(node[1]), node[2], node[3])
    parts = [reverse(x) for x in node[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


@dataclass
class _Nfa:
    free: list[list[int]] = field(default_factory=list)
    moves: list[list[tuple[int, int]]] = field(default_factory=list)

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def build(self, node, start: int) -> int:
        """Adds ``node`` from ``start``; returns the state that ends it."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.build(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for branch in node[1]:
                begin = self.state()
                self.free[start].append(begin)
                self.free[self.build(branch, begin)].append(end)
            return end
        _, inner, least, most = node
        for _ in range(least):
            start = self.build(inner, start)
        if most is None:
            loop, end = self.state(), self.state()
            self.free[start].append(loop)
            self.free[self.build(inner, loop)].append(loop)
            self.free[loop].append(end)
            return end
        end = self.state()
        self.free[start].append(end)
        for _ in range(most - least):
            begin = self.state()
            self.free[start].append(begin)
            start = self.build(inner, begin)
            self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


def _byte_classes(masks: set[int]) -> tuple[list[int], list[int]]:
    """(class of each byte, one byte of each class): bytes that every mask treats alike."""
    found: dict[tuple[bool, ...], int] = {}
    of, example = [], []
    ordered = sorted(masks)
    for b in range(256):
        k = tuple(bool(m >> b & 1) for m in ordered)
        if k not in found:
            found[k] = len(example)
            example.append(b)
        of.append(found[k])
    return of, example


@dataclass(frozen=True)
class Automaton:
    """``table[state + byte]`` is the next state; states from ``accepting`` on accept ``accepts[state // 256]``.

    State ``dead`` (or -1) has no way to accept.  ``start`` is the first state.
    """

    table: list[int]
    start: int
    accepting: int
    dead: int
    accepts: list[tuple[int, ...]]

    @property
    def n_states(self) -> int:
        return len(self.table) // 256


def compile_automaton(trees: list, search: bool) -> Automaton:
    """One automaton for all ``trees``; with ``search`` a match may begin at any byte."""
    nfa = _Nfa()
    first = nfa.state()
    ends: dict[int, int] = {}
    if search:
        nfa.moves[first].append((ALL, first))
    for k, tree in enumerate(trees):
        begin = nfa.state()
        nfa.free[first].append(begin)
        ends[nfa.build(tree, begin)] = k
    class_of, example = _byte_classes({m for moves in nfa.moves for m, _ in moves})
    start = nfa.closure([first])
    number, todo, rows = {start: 0}, [start], []
    while todo:
        subset = todo.pop(0)
        row = []
        for b in example:
            to = nfa.closure([t for s in subset for m, t in nfa.moves[s] if m >> b & 1])
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    accepts = [tuple(sorted({ends[s] for s in subset if s in ends})) for subset in number]
    # Moore: split blocks of states until all of a block go to the same blocks
    kinds = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
    block = [kinds[a] for a in accepts]
    while True:
        seen: dict[tuple, int] = {}
        fresh = [seen.setdefault((block[s], *(block[t] for t in rows[s])), len(seen)) for s in range(len(rows))]
        if len(seen) == len(set(block)):
            break
        block = fresh
    blocks = sorted(set(block), key=lambda b: (bool(accepts[block.index(b)]), b))
    place = {b: i for i, b in enumerate(blocks)}
    some = {b: block.index(b) for b in blocks}
    small = np.array([[place[block[t]] for t in rows[some[b]]] for b in blocks], np.int64)
    table = (small[:, class_of] * 256).ravel().tolist()
    marks = [accepts[some[b]] for b in blocks]
    n_plain = sum(not a for a in marks)
    dead = [i for i in range(n_plain) if (small[i] == i).all()]
    return Automaton(table, place[block[0]] * 256, n_plain * 256, dead[0] * 256 if dead else -1, marks)


def longest(automaton: Automaton, data, begin: int, end: int, step: int = 1) -> int:
    """Where the longest match that starts at ``begin`` ends, going to ``end`` by ``step``; -2 if there is none."""
    s, table, i = automaton.start, automaton.table, begin
    found = i if s >= automaton.accepting else -2
    while i != end:
        s = table[s + data[i if step > 0 else i - 1]]
        i += step
        if s >= automaton.accepting:
            found = i
        elif s == automaton.dead:
            break
    return found
