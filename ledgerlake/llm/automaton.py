"""Regular expressions over bytes, compiled to one minimal deterministic automaton.

Syntax: literals, ``\\xNN`` and escaped characters, classes ``[...]`` with ranges, groups
``(...)``, alternatives ``|``, ``? * + {n} {n,} {n,m}`` and ``(?i:...)`` (ASCII letters
in either case).  Subset construction over byte classes, then partition refinement.
"""

from __future__ import annotations

from collections.abc import Iterator

#: Entry of a transition row that holds the accepting rules, one bit each.
ACCEPT = 256


class _Parser:
    """A pattern as a tree: ("set", mask), ("cat", xs), ("alt", xs), ("rep", x, low, high)."""

    def __init__(self, pattern: str):
        self.p, self.i = pattern, 0

    def more(self) -> str:
        return self.p[self.i:self.i + 1]

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def alt(self, fold: bool) -> tuple:
        xs = [self.cat(fold)]
        while self.more() == "|":
            self.take()
            xs.append(self.cat(fold))
        return xs[0] if len(xs) == 1 else ("alt", xs)

    def cat(self, fold: bool) -> tuple:
        xs = []
        while self.more() and self.more() not in "|)":
            xs.append(self.repeat(self.atom(fold)))
        return ("cat", xs)

    def repeat(self, x: tuple) -> tuple:
        c = self.more()
        if c and c in "?*+":
            self.take()
            return ("rep", x, int(c == "+"), 1 if c == "?" else None)
        if c == "{":
            end = self.p.index("}", self.i)
            low, _, high = self.p[self.i + 1:end].partition(",")
            exact = "," not in self.p[self.i:end]
            self.i = end + 1
            return ("rep", x, int(low), int(low) if exact else int(high) if high else None)
        return x

    def byte(self) -> int:
        c = self.take()
        if c == "\\":
            c = self.take()
            if c == "x":
                self.i += 2
                return int(self.p[self.i - 2:self.i], 16)
        return ord(c)

    def atom(self, fold: bool) -> tuple:
        if self.more() == "(":
            self.take()
            if self.p.startswith("?i:", self.i):
                self.i, fold = self.i + 3, True
            elif self.p.startswith("?:", self.i):
                self.i += 2
            x = self.alt(fold)
            self.take()
            return x
        if self.more() == "[":
            self.take()
            mask = 0
            while self.more() != "]":
                a = b = self.byte()
                if self.more() == "-" and self.p[self.i + 1] != "]":
                    self.take()
                    b = self.byte()
                for v in range(a, b + 1):
                    mask |= 1 << v
            self.take()
        else:
            mask = 1 << self.byte()
        if fold:
            for v in range(65, 91):
                if mask & (1 << v | 1 << v + 32):
                    mask |= 1 << v | 1 << v + 32
        return ("set", mask)


def parse(pattern: str) -> tuple:
    p = _Parser(pattern)
    tree = p.alt(False)
    if p.i != len(pattern):
        raise ValueError(f"unbalanced pattern: {pattern}")
    return tree


def reverse(tree: tuple) -> tuple:
    """The tree of the mirrored language."""
    kind, *x = tree
    if kind == "cat":
        return ("cat", [reverse(y) for y in x[0][::-1]])
    if kind == "alt":
        return ("alt", [reverse(y) for y in x[0]])
    return ("rep", reverse(x[0]), *x[1:]) if kind == "rep" else tree


class _Nfa:
    def __init__(self) -> None:
        self.free: list[list[int]] = []  # moves without a byte
        self.moves: list[list[tuple[int, int]]] = []  # (mask, target)

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, tree: tuple, at: int) -> int:
        """Build ``tree`` from state ``at``; the state where it ends."""
        kind, *x = tree
        if kind == "set":
            to = self.state()
            self.moves[at].append((x[0], to))
            return to
        if kind == "cat":
            for y in x[0]:
                at = self.add(y, at)
            return at
        if kind == "alt":
            to = self.state()
            for y in x[0]:
                start = self.state()
                self.free[at].append(start)
                self.free[self.add(y, start)].append(to)
            return to
        y, low, high = x
        for _ in range(low):
            at = self.add(y, at)
        if high is None:
            loop, to = self.state(), self.state()
            self.free[at].append(loop)
            self.free[loop].append(to)
            self.free[self.add(y, loop)].append(loop)
            return to
        to = self.state()
        self.free[at].append(to)
        for _ in range(high - low):
            at = self.add(y, at)
            self.free[at].append(to)
        return to

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def compile_rules(trees: list[tuple], anywhere: bool) -> tuple[list[list[int]], list[int]]:
    """Minimal automaton: transition array (state, byte) and accept masks; state 0 starts.

    ``anywhere``: a match may begin at every byte; else only at the first, and the state
    after a byte that no match has is -1.
    """
    nfa = _Nfa()
    start = nfa.state()
    accept: dict[int, int] = {}
    for k, tree in enumerate(trees):
        s = nfa.state()
        nfa.free[start].append(s)
        accept[nfa.add(tree, s)] = 1 << k
    masks = {m for moves in nfa.moves for m, _ in moves}
    kind: dict[tuple, int] = {}
    byte_kind = [kind.setdefault(tuple(m >> b & 1 for m in masks), len(kind)) for b in range(256)]
    example = [byte_kind.index(c) for c in range(len(kind))]
    first = nfa.closure({start})
    number, sets, table = {first: 0}, [first], []
    for now in sets:  # grows while it is walked
        row = []
        for b in example:
            to = {t for s in now for m, t in nfa.moves[s] if m >> b & 1}
            if anywhere:
                to.add(start)
            if not to:
                row.append(-1)
                continue
            nxt = nfa.closure(to)
            if nxt not in number:
                number[nxt] = len(sets)
                sets.append(nxt)
            row.append(number[nxt])
        table.append(row)
    ends = [sum({accept.get(s, 0) for s in x}) for x in sets]
    # Partition refinement: split classes until the classes of all successors agree.
    block = ends
    while True:
        seen: dict[tuple, int] = {}
        new = [seen.setdefault((block[s], *[-1 if t < 0 else block[t] for t in row]), len(seen))
               for s, row in enumerate(table)]
        if len(seen) == len(set(block)):
            break
        block = new
    block = new  # numbered by first appearance, so the start is 0
    small: dict[int, int] = {}
    for s, b in enumerate(block):
        small.setdefault(b, s)
    rows = [[-1 if (t := table[s][c]) < 0 else block[t] for c in byte_kind]
            for s in small.values()]
    return rows, [ends[s] for s in small.values()]


def linked(rows: list[list[int]], ends: list[int]) -> list:
    """The start row; a row's entry for a byte is the next row (None: dead), [ACCEPT] its rules."""
    out: list[list] = [[] for _ in rows]
    for row, targets, end in zip(out, rows, ends):
        row += [None if t < 0 else out[t] for t in targets]
        row.append(end)
    return out[0]


def match_ends(start: list, data: bytes) -> Iterator[tuple[int, int]]:
    """(mask of rules, end): where an accepted run of the rules stops, in one byte pass."""
    row, held = start, 0
    for i, b in enumerate(data):
        row = row[b]
        if row[ACCEPT] != held:
            if gone := held & ~row[ACCEPT]:
                yield gone, i
            held = row[ACCEPT]
    if held:
        yield held, len(data)


def longest_start(back: list, data: bytes, end: int, least: int) -> int | None:
    """The smallest start >= ``least`` of a match that ends at ``end``."""
    row, found = back, None
    for i in range(end - 1, least - 1, -1):
        row = row[data[i]]
        if row is None:
            break
        if row[ACCEPT]:
            found = i
    return found
