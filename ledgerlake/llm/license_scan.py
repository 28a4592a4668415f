"""License scan: MinHash bands over overlapping windows retrieve templates, then exact checks.

A text is its lower-cased words; windows and templates are compared on shingles of
``SHINGLE`` = 3 words (a notice such as "All rights reserved" has no more).  Templates with
up to 2, 4, 8 ... shingles form size classes.  For class C the text is cut into blocks of
C / 2 shingles and a window is three adjacent blocks, so every stretch of C shingles lies in
a window.

Bands: each of ``BANDS`` = 64 bands has one row, the smallest hash of a window under the band's
permutation.  A window that holds a template's stretch completely has a Jaccard
similarity of at least 1/4 with it (more than C / 2 shingles of at most 3 C / 2, less
the part that ``CONTAINMENT`` lets go), so the template is retrieved with a
probability of at least 1 - (3/4)^64 > 1 - 2e-8.

All templates of a size class are looked up at once in the sorted smallest hashes of a
band, so the scan's cost hardly depends on their number.

Verification: some stretch of the window that is as long as the template must hold
``CONTAINMENT`` of the template's shingles or more, exactly (so a notice with words put in,
such as another variant of a license, is not taken for the shorter one).  Verified windows of a template that overlap make one span, from
the first to the last word of a matching shingle.

The template table is a parameter with at most ``MAX_TEMPLATES`` entries, sent to every
task.  NULL, empty and wordless texts have no license.  Repeated rows and NULL doc_ids are
scanned like others; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame

from ledgerlake.llm.common import WordHash, map_rows, shingle_hashes

SHINGLE = 3
BANDS = 64
CONTAINMENT = 0.8
MAX_TEMPLATES = 1000
#: Marks of one size class and band (few of them set, even with ``MAX_TEMPLATES``).
SLOTS = 1 << 14
#: Shingles of one batch at most (a longer document is a batch of its own).
BATCH = 100_000
_WORD = re.compile(r"[^\W_]+")
#: Notices as (license, kind, text).
TEMPLATES = [
    ("mit", "permissive", "Released under the MIT License."),
    ("mit", "permissive", "Permission is hereby granted, free of charge, to any person obtaining "
     "a copy of this software and associated documentation files"),
    ("apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "permissive", "you may not use this file except in compliance with the "
     "License. You may obtain a copy of the License at"),
    ("bsd", "permissive", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met"),
    ("gpl-3.0", "copyleft", "This work is licensed under the GNU General Public License, "
     "version 3."),
    ("gpl", "copyleft", "This program is free software: you can redistribute it and/or modify it "
     "under the terms of the GNU General Public License as published by the Free Software "
     "Foundation"),
    ("mpl-2.0", "copyleft", "This Source Code Form is subject to the terms of the Mozilla Public "
     "License, v. 2.0."),
    ("cc-by-4.0", "permissive", "This work is licensed under a Creative Commons Attribution 4.0 "
     "International License."),
    ("cc-by-nc-4.0", "noncommercial", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "proprietary", "All rights reserved."),
    ("mit", "permissive", "The above copyright notice and this permission notice shall be "
     "included in all copies or substantial portions of the Software."),
    ("apache-2.0", "permissive", "Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "permissive", "Neither the name of the copyright holder nor the names of its "
     "contributors may be used to endorse or promote products derived from this software "
     "without specific prior written permission."),
    ("isc", "permissive", "Permission to use, copy, modify, and/or distribute this software for "
     "any purpose with or without fee is hereby granted, provided that the above copyright "
     "notice and this permission notice appear in all copies."),
    ("zlib", "permissive", "The origin of this software must not be misrepresented; you must not "
     "claim that you wrote the original software."),
    ("bsl-1.0", "permissive", "Distributed under the Boost Software License, Version 1.0."),
    ("unlicense", "permissive", "This is free and unencumbered software released into the public "
     "domain."),
    ("cc0-1.0", "permissive", "To the extent possible under law, the author has waived all "
     "copyright and related or neighboring rights to this work."),
    ("lgpl", "copyleft", "This library is free software; you can redistribute it and/or modify it "
     "under the terms of the GNU Lesser General Public License as published by the Free "
     "Software Foundation"),
    ("agpl-3.0", "copyleft", "You should have received a copy of the GNU Affero General Public "
     "License along with this program."),
    ("epl-2.0", "copyleft", "This program and the accompanying materials are made available under "
     "the terms of the Eclipse Public License 2.0"),
    ("cc-by-sa-4.0", "copyleft", "This work is licensed under a Creative Commons "
     "Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "noncommercial", "This work is licensed under a Creative Commons "
     "Attribution-NonCommercial 4.0 International License."),
    ("proprietary", "proprietary", "No part of this publication may be reproduced, stored in a "
     "retrieval system, or transmitted in any form or by any means without the prior written "
     "permission of the publisher."),
]
KINDS = ("proprietary", "noncommercial", "copyleft", "permissive")


class LowerHash(WordHash):
    """word -> hash of the lower-cased word."""

    def __missing__(self, word: str) -> int:
        low = word.lower()
        h = super().__missing__(low)
        self[word] = h
        return h


def shingles(text: str, words: WordHash) -> np.ndarray:
    h = np.fromiter(map(words.__getitem__, _WORD.findall(text)), np.uint64)
    return shingle_hashes(h, SHINGLE) if len(h) >= SHINGLE else h[:0]


def slot(low: np.ndarray) -> np.ndarray:
    """The slot of a window's smallest hash (middle bits: the top ones of minima are small)."""
    return (low >> np.uint64(24)).astype(np.uint32) & np.uint32(SLOTS - 1)


class Index:
    """Templates by size class with the smallest hash of each band."""

    def __init__(self, templates: list[tuple[str, str, str]]):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        words = LowerHash()
        self.names = [t[0] for t in templates]
        self.sets = [np.unique(shingles(t[2], words)) for t in templates]
        self.lengths = [len(shingles(t[2], words)) for t in templates]
        rng = np.random.default_rng(7)
        self.factors = rng.integers(1, 1 << 63, BANDS, dtype=np.uint64) * np.uint64(2) \
            + np.uint64(1)
        self.levels: dict[int, list[int]] = {}  # class exponent -> templates
        for t, n in enumerate(self.lengths):
            if n:
                self.levels.setdefault(max(1, (n - 1).bit_length()), []).append(t)
        self.lowest = [[self.order(s, p).min() if len(s) else None for s in self.sets]
                       for p in range(BANDS)]
        self.tables = {(level, p): self.lookup(level, p)
                       for level in self.levels for p in range(BANDS)}

    def order(self, s: np.ndarray, band: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return s * self.factors[band]

    def lookup(self, level: int, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marked slots, sorted minima and their templates of one size class and band."""
        group = np.array(self.levels[level])
        low = np.array([self.lowest[band][t] for t in group], dtype=np.uint64)
        rank = np.argsort(low, kind="stable")
        marks = np.zeros(SLOTS, dtype=bool)
        marks[slot(low)] = True
        return marks, low[rank], group[rank]

    def retrieve(self, s: np.ndarray) -> set[tuple[int, int, int]]:
        """(template, first shingle, end) of the windows that share a band with a template.

        A window's smallest hash is looked up among those of all templates of a size class
        at once: a table of marks first, the few that pass in the sorted minima.
        """
        found: set[tuple[int, int, int]] = set()
        top = max(self.levels, default=0)
        for p in range(BANDS):
            low = self.order(s, p)
            for level in range(1, top + 1):  # blocks of 2^(level - 1) shingles
                if level > 1:
                    if len(low) % 2:
                        low = np.append(low, low[-1])
                    low = np.minimum(low[::2], low[1::2])
                if level not in self.levels:
                    continue
                padded = np.concatenate([low, low[-1:], low[-1:]])
                window = np.minimum(np.minimum(padded[:-2], padded[1:-1]), padded[2:])
                block = 1 << (level - 1)
                marks, minima, group = self.tables[level, p]
                at = np.flatnonzero(marks[slot(window)])
                first = np.searchsorted(minima, window[at], "left")
                last = np.searchsorted(minima, window[at], "right")
                for w, i, j in zip(at.tolist(), first.tolist(), last.tolist()):
                    found.update((int(t), w * block, (w + 3) * block) for t in group[i:j])
        return found

    def verify(self, s: np.ndarray, windows: set[tuple[int, int, int]]
               ) -> list[tuple[int, int, int, float]]:
        """(template, first shingle, last shingle, containment) of merged, verified windows."""
        out: list[list] = []
        for t, lo, hi in sorted(windows):
            part = s[lo:hi]
            hit = np.flatnonzero(np.isin(part, self.sets[t]))
            # Every stretch of the template's own length that starts with one of its shingles.
            ends = np.searchsorted(hit, hit + self.lengths[t])
            shares = [len(np.unique(part[hit[i:j]])) / len(self.sets[t])
                      for i, j in enumerate(ends)]
            share = max(shares, default=0.0)
            if share >= CONTAINMENT:
                held = [i for i, x in enumerate(shares) if x >= CONTAINMENT]
                a, b = lo + int(hit[held[0]]), lo + int(hit[ends[held[-1]] - 1])
                # Windows without the whole stretch but enough of it merge with their neighbours.
                if out and out[-1][0] == t and a <= out[-1][2]:
                    out[-1][2] = max(out[-1][2], b)
                    out[-1][3] = max(out[-1][3], share)
                else:
                    out.append([t, a, b, share])
        return [tuple(x) for x in out]


def scan(documents: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, licenses (sorted, comma-joined), kind (the strictest), n_spans, spans."""
    index = Index(templates)
    kind = {name: k for name, k, _ in templates}

    def finish(doc_id: int | None, text: str, found: list[tuple]) -> tuple:
        names = sorted({index.names[t] for t, *_ in found})
        spans = ""
        if found:
            at = [m.span() for m in _WORD.finditer(text)]
            spans = ",".join(f"{a}:{b}:{n}" for a, b, n in sorted(
                (at[a][0], at[b + SHINGLE - 1][1], index.names[t]) for t, a, b, _ in found))
        worst = min((kind[n] for n in names), key=KINDS.index, default="none")
        return doc_id, ",".join(names), worst, len(found), spans

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        words = LowerHash()
        part: list[tuple] = []
        size = 0

        def flush() -> Iterator[tuple]:
            # One retrieval for many texts; a window may reach into the next text, the
            # exact check looks at its own text alone.
            starts = np.cumsum([0] + [len(s) for *_, s in part])
            whole = np.concatenate([s for *_, s in part])
            mine: dict[int, set] = {}
            if len(whole):
                for t, lo, hi in index.retrieve(whole):
                    first = int(np.searchsorted(starts, lo, "right")) - 1
                    for d in range(first, len(part)):
                        if starts[d] >= hi:
                            break
                        mine.setdefault(d, set()).add(
                            (t, max(lo - int(starts[d]), 0), hi - int(starts[d])))
            for d, (doc_id, text, s) in enumerate(part):
                yield finish(doc_id, text, index.verify(s, mine[d]) if d in mine else [])

        for doc_id, text in rows:
            s = shingles(text or "", words)
            part.append((doc_id, text or "", s))
            size += len(s) + 1
            if size >= BATCH:
                yield from flush()
                part, size = [], 0
        if part:
            yield from flush()

    return map_rows(documents.select("doc_id", "text"), run,
                    "doc_id long, licenses string, kind string, n_spans long, spans string")
