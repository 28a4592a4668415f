"""Brute-force versions that tests compare with."""

import re
from collections import Counter
from itertools import combinations


def bag(text):
    w = re.findall(r"\w+", text.lower())
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def jaccard(a, b):
    x, y = bag(a), bag(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def brute_classes(rows, threshold=0.8):
    """doc_id -> smallest doc_id of its component (unique doc_ids)."""
    up = {d: d for d, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    shingles = {}
    for d, t in rows:
        if t is not None:
            for s in [*bag(t), ("copy", t)]:
                shingles.setdefault(s, []).append(d)
    text = dict(rows)
    pairs = {p for ds in shingles.values() for p in combinations(sorted(set(ds)), 2)}
    for a, b in pairs:
        if text[a] == text[b] or jaccard(text[a], text[b]) >= threshold:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {d: root(d) for d in up}


def every_block(rows, min_words=5):
    """(doc_id, text) without the lines in a block that an earlier document holds: plain loops
    over all runs of lines, without the operator's code.  Unique, ordered doc_ids."""
    seen, out = set(), []
    for d, t in rows:
        if t is None:
            out.append((d, t))
            continue
        lines = t.split("\n")
        full = [i for i, x in enumerate(lines) if x.split()]
        gone, mine = set(), []
        for a in range(len(full)):
            run, words, last = (), 0, a
            for b in range(a, len(full)):
                line = lines[full[b]]
                run, words = hash((run, line)), words + len(line.split())
                if words >= min_words:
                    mine.append(run)
                    if run in seen:
                        last = b + 1
            gone.update(full[a:last])
        seen.update(mine)
        out.append((d, "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def brute_leaks(doc_rows, items, threshold=0.8):
    """doc_id -> item_ids with a window of the item's size at the threshold."""
    def words(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    def sim(a, b):
        x, y = (Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) for w in (a, b))
        return sum((x & y).values()) / sum((x | y).values())

    out = {}
    its = [(i, words(t)) for i, t in items if len(words(t)) >= 5]
    for d, t in doc_rows:
        w = words(t)
        keys = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        out[d] = sorted(i for i, x in its if len(x) <= len(w)
                        and any(tuple(x[k:k + 5]) in keys for k in range(len(x) - 4))
                        and any(sim(w[s:s + len(x)], x) >= threshold
                                for s in range(len(w) - len(x) + 1)))
    return out
