"""Secret scan: all rules in one automaton, one pass over the bytes of every text.

The rule patterns are compiled together (subset construction, minimisation) into one
transition array.  While it walks the bytes, the accept mask of the state tells which
rules have a match that ends here; where a rule's bit goes out, its match has ended,
and the rule's own mirrored automaton walks back from there to the leftmost start that
does not overlap the match before.  All base patterns end in a run of one class, so these
are the leftmost, greedy, non-overlapping matches.  Least lengths are checked afterwards;
counting them in the automaton would multiply its states.  (The hex pattern counts to 8
already, which changes no match of 24 and keeps ordinary words from ending one.)

NULL and empty texts have no spans.  Offsets are code points, ends exclusive.  Repeated
rows and NULL doc_ids are scanned like others; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from ledgerlake.llm.automaton import (compile_rules, linked, longest_start, match_ends, parse,
                                      reverse)
from ledgerlake.llm.common import map_rows

BASE = ("assign", "access", "hex")
#: Kinds and patterns, in the order that breaks ties; the first three are the base.
RULES = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
              r"""[A-Za-z0-9+/_.=\-]+""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{8,}",
    "github": r"gh[pousr]_[A-Za-z0-9]+",
    "slack": r"xox[abprs]-[A-Za-z0-9\-]+",
    "pem": r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----",
}


def assigned(match: bytes) -> bool:
    """Whether the assigned value has 6 characters or more."""
    cut = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    value = match[cut + 1:].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'")) >= 6


#: Conditions on a match (fixed values: least lengths).
CHECKS = {"assign": assigned, "access": lambda m: len(m) >= 20, "hex": lambda m: len(m) >= 24,
          "github": lambda m: len(m) >= 24, "slack": lambda m: len(m) >= 15}


class Scanner:
    """Compiled rules; tables are built once (on the driver) and linked in each task."""

    def __init__(self, rules: dict[str, str] = RULES):
        self.kinds = list(rules)
        trees = [parse(p) for p in rules.values()]
        self.forward = compile_rules(trees, anywhere=True)
        self.backward = [compile_rules([reverse(t)], anywhere=False) for t in trees]

    def ready(self) -> "Scanner":
        self.start = linked(*self.forward)
        self.back = [linked(*b) for b in self.backward]
        return self

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind number, end) in code points, sorted."""
        data = text.encode()
        last = [0] * len(self.kinds)
        found = []
        for mask, end in match_ends(self.start, data):
            for k, kind in enumerate(self.kinds):
                if mask >> k & 1:
                    start = longest_start(self.back[k], data, end, last[k])
                    if start is not None:
                        last[k] = end
                        if kind not in CHECKS or CHECKS[kind](data[start:end]):
                            found.append((start, k, end))
        if found and len(data) != len(text):
            at, points = {}, 0
            edges = sorted({x for s, _, e in found for x in (s, e)})
            for a, b in zip([0, *edges], edges):
                points += len(data[a:b].decode())
                at[b] = points
            found = [(at[s], k, at[e]) for s, k, e in found]
        return sorted(found)


def scan(documents: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document row."""
    scanner = Scanner(rules)

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        s = scanner.ready()
        base = [s.kinds.index(k) for k in BASE]
        for doc_id, text in rows:
            found = s.spans(text or "")
            named = [f"{s.kinds[k]}:{a}:{b}" for a, k, b in found]
            plain = ",".join(n for n, f in zip(named, found) if f[1] in base)
            yield (doc_id, *[sum(f[1] == k for f in found) for k in base],
                   hashlib.sha256(plain.encode()).hexdigest(), ",".join(named))

    return map_rows(documents.select("doc_id", "text"), run,
                    "doc_id long, n_assign long, n_access long, n_hex long, "
                    "base_sha256 string, spans string")
