"""Quality rules: a linear-chain CRF labels lines, content share decides retention.

Every line with a word gets a feature vector; a two-label chain (content or
boilerplate) is decoded with Viterbi, and a document is kept when lines marked as
content hold at least ``min_share`` of its words and no base rule failed.

The chain is trained here, on at most ``TRAIN_DOCS`` labelled documents of each quality
and ``TRAIN_LINES`` lines of each (the documented bounds of the training sample; the
labelled rows with the smallest hash of doc_id are taken, and their first lines).  The lines
of a document of quality 1 count as content, those of quality 0 as boilerplate.  Besides
these documents, the chain sees spliced ones (``spliced``): the lines of one kind followed by
those of the other, so that labels change inside a sequence and the transitions are
learned from changes, too.  Training maximises the exact conditional likelihood
(forward-backward).  Without labelled rows of both
kinds no line is boilerplate and the base rules alone decide.

NULL text: no words, base rules fail, not kept.  NULL doc_id and repeated rows are
judged like any other row; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlake.llm.common import map_rows
from ledgerlake.session import ship_package

TRAIN_DOCS = 500
TRAIN_LINES = 100
MIN_SHARE = 0.5
SYMBOLS = "#*$%&|<>"
N_FEATURES = 12
GAPS = " \t\n\x0b\x0c\r"
_DIGIT = re.compile(r"[0-9]")
_UPPER = re.compile(r"(?:^|[\x20\x09-\x0D])[^\W\d_a-z]")


# --- base counts -----------------------------------------------------------------------

def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside a ``width``-word window that occurs twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            h = (h ^ a[i:i + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    x, y = order[:-1][same], order[1:][same]
    for i in range(width):  # equal hashes are compared word by word
        eq = a[x + i] == a[y + i]
        x, y = x[eq], y[eq]
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.union1d(x, y)
    edge[starts] += 1
    edge[starts + width] -= 1
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = text.encode().split()  # bytes.split() cuts at \x20 and \x09-\x0D, no others
    word_chars = len(text) - sum(map(text.count, GAPS))
    lines = [x for x in text.split("\n") if x.strip(GAPS)]
    n_dup = len(lines) - len(set(lines))
    rep = repeated_words(words)
    return (len(words), word_chars, sum(map(text.count, SYMBOLS)), n_dup, rep,
            len(words) < 10 or 100 * rep > 20 * len(words))


# --- lines -----------------------------------------------------------------------------

def line_vectors(text: str | None, most: int | None = None
                 ) -> tuple[list[list[float]], list[int]]:
    """Feature vectors and word counts of the (first ``most``) lines that have a word."""
    out, sizes, seen = [], [], set()
    for line in (text or "").split("\n"):
        w = line.encode().split()
        if not w:
            continue
        if len(out) == most:
            break
        n, chars = len(w), max(len(line), 1)
        sym = sum(map(line.count, SYMBOLS))
        ends = line.rstrip()[-1:]
        out.append([
            1.0, np.log1p(n) / 4, min(sym / n, 3.0), float(sym > 0), min(chars / n / 10, 3.0),
            len(_DIGIT.findall(line)) / chars, float(ends in ".!?"), float(line in seen),
            min(len(_UPPER.findall(line)) / n, 1.0), 1.0 - len(set(w)) / n,
            min((line.count(".") + line.count(",")) / n, 2.0), float(n < 4)])
        sizes.append(n)
        seen.add(line)
    return out, sizes


def viterbi(x: list[list[float]], w: np.ndarray, trans: np.ndarray) -> list[int]:
    """The likeliest labels (1: content, 0: boilerplate); equal scores choose content."""
    if not x:
        return []
    e = np.asarray(x) @ w.T
    (t00, t01), (t10, t11) = trans.tolist()
    back: list[tuple[int, int]] = []
    (a, b), *rest = e.tolist()
    for e0, e1 in rest:
        f0, f1 = (0 if a + t00 > b + t10 else 1), (0 if a + t01 > b + t11 else 1)
        back.append((f0, f1))
        a, b = (a + t00 if f0 == 0 else b + t10) + e0, (a + t01 if f1 == 0 else b + t11) + e1
        if b > 1e6 or b < -1e6:
            a, b = a - b, 0.0
    label = [0 if a > b else 1]
    for f in reversed(back):
        label.append(f[label[-1]])
    return label[::-1]


def spliced(seqs: list[np.ndarray], labels: list[int]) -> tuple[list, list[np.ndarray]]:
    """The sequences with a label for each line, and the k-th of one kind joined to the k-th
    of the other: content first in every second one."""
    pairs = zip(*([s for s, y in zip(seqs, labels) if y == q and len(s)] for q in (0, 1)))
    out = [(s, np.full(len(s), y)) for s, y in zip(seqs, labels) if len(s)]
    for k, two in enumerate(pairs):
        order = (0, 1) if k % 2 else (1, 0)
        out.append((np.concatenate([two[q] for q in order]),
                    np.concatenate([np.full(len(two[q]), q) for q in order])))
    return [s for s, _ in out], [y for _, y in out]


def train(seqs: list[np.ndarray], labels: list[np.ndarray], steps: int = 120, rate: float = 0.3,
          l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (2, features) and transitions (2, 2) by gradient ascent on the likelihood.

    ``labels`` holds one label for each line of each (non-empty) sequence.  Padded positions
    carry weight 0.
    """
    w, t = np.zeros((2, N_FEATURES)), np.zeros((2, 2))
    if len({int(y) for ys in labels for y in ys}) < 2:
        return w, t
    n, length = len(seqs), max(map(len, seqs))
    x = np.zeros((n, length, N_FEATURES))
    on = np.zeros((n, length))
    gold, gold_t = np.zeros((n, length, 2)), np.zeros((n, 2, 2))
    for i, (s, y) in enumerate(zip(seqs, labels)):
        x[i, :len(s)], on[i, :len(s)] = s, 1.0
        gold[i, np.arange(len(s)), y] = 1.0
        np.add.at(gold_t[i], (y[:-1], y[1:]), 1.0)
    # Pure sequences of each label and mixed ones weigh alike, as do long and short ones.
    kind = np.asarray([int(y[0]) if (y == y[0]).all() else 2 for y in labels])
    weight = 1 / np.bincount(kind, minlength=3)[kind] / len(set(kind.tolist())) / on.sum(1)
    m_w, v_w, m_t, v_t = np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)
    for step in range(1, steps + 1):
        e = x @ w.T
        alpha, beta = np.zeros((n, length, 2)), np.zeros((n, length, 2))
        alpha[:, 0] = e[:, 0]
        for i in range(1, length):
            nxt = np.logaddexp(alpha[:, i - 1, :1] + t[0], alpha[:, i - 1, 1:] + t[1]) + e[:, i]
            alpha[:, i] = np.where(on[:, i, None] > 0, nxt, alpha[:, i - 1])
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        for i in range(length - 2, -1, -1):
            f = e[:, i + 1] + beta[:, i + 1]
            prev = np.stack([np.logaddexp(t[k, 0] + f[:, 0], t[k, 1] + f[:, 1])
                             for k in (0, 1)], 1)
            beta[:, i] = np.where(on[:, i + 1, None] > 0, prev, 0.0)
        post = np.exp(alpha + beta - z[:, None, None]) * on[..., None]
        pair = np.zeros((n, 2, 2))
        for j in (0, 1):
            for k in (0, 1):
                s = (alpha[:, :-1, j] + t[j, k] + e[:, 1:, k] + beta[:, 1:, k] - z[:, None])
                pair[:, j, k] = (np.exp(np.minimum(s, 0)) * on[:, 1:]).sum(1)
        g_w = np.einsum("n,nlk,nlf->kf", weight, gold * on[..., None] - post, x) - l2 * w
        g_t = np.einsum("n,njk->jk", weight, gold_t - pair) - l2 * t
        for p, g, m, v in ((w, g_w, m_w, v_w), (t, g_t, m_t, v_t)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * 0.3 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w, t


def fit(documents: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS
        ) -> tuple[np.ndarray, np.ndarray]:
    """Train on at most ``per_class`` labelled documents of each quality.

    Only line vectors of these documents come to the driver.
    """
    spark = documents.sparkSession
    lab = labels.select(F.col("doc_id").alias("id"), "quality").dropna()
    rank = F.struct(F.xxhash64("id"), "id")
    pick = [lab.filter(F.col("quality") == q).orderBy(rank).limit(per_class) for q in (0, 1)]
    # Proven bound: two limits of per_class rows.
    chosen = F.broadcast(pick[0].unionByName(pick[1]).distinct())
    docs = documents.select(F.col("doc_id"), "text")
    rows = docs.join(chosen, docs["doc_id"] == chosen["id"]).select("quality", "text")

    def vectors(rs: Iterable[tuple]) -> Iterator[tuple]:
        for q, text in rs:
            yield q, [v for line in line_vectors(text, TRAIN_LINES)[0] for v in line]

    got = map_rows(rows, vectors, "quality int, v array<double>").collect()
    got.sort(key=lambda r: (r[0], len(r[1]), r[1]))
    seqs = [np.asarray(r[1], dtype=float).reshape(-1, N_FEATURES) for r in got]
    return train(*spliced(seqs, [int(r[0]) for r in got]))


def judge(documents: DataFrame, model: tuple[np.ndarray, np.ndarray],
          min_share: float = MIN_SHARE) -> DataFrame:
    """doc_id, base counts, content words, share and ``kept`` of every document row."""
    w, t = model

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            base = base_counts(text)
            x, sizes = line_vectors(text)
            content = sum(n for n, y in zip(sizes, viterbi(x, w, t)) if y)
            kept = not base[-1] and content >= min_share * base[0]
            yield (doc_id, *base, content, kept)

    return map_rows(documents.select("doc_id", "text"), run,
                    "doc_id long, n_words long, word_chars long, n_symbols long, "
                    "n_dup_lines long, n_repeat_words long, base_failed boolean, "
                    "content_words long, kept boolean")


def keep_good(documents: DataFrame, model: tuple[np.ndarray, np.ndarray],
              min_share: float = MIN_SHARE) -> DataFrame:
    """The documents (all their columns) that ``judge`` keeps, decided row by row."""
    w, t = model
    ship_package(documents.sparkSession)

    @pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            base = base_counts(text)
            if base[-1]:
                out.append(False)
                continue
            x, sizes = line_vectors(text)
            content = sum(n for n, y in zip(sizes, viterbi(x, w, t)) if y)
            out.append(content >= min_share * base[0])
        return pd.Series(out, dtype=bool)

    return documents.filter(kept(F.col("text")))
