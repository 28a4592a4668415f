"""A character tagger: bidirectional LSTM with CRF transitions, trained and run in numpy.

A character is one of ``N_CLASSES`` classes (every ASCII letter, a digit by the length of its
run, common marks, the rest by kind).  Tags are ``O`` and, for every kind of span, ``B`` (its first
character) and ``I``.  The forward and the backward LSTM read a window; their hidden states
give a score for every tag, and a chain of tag transitions, trained with them by the exact
conditional likelihood (forward-backward), is decoded with Viterbi.  An ``I`` only follows
``B`` or ``I`` of its kind, at any weight.

All arrays have windows first; windows of a batch are padded to one length and masked.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = " \n\t.@+-()[]:/_%,;='\"|#*&<>!?"
#: Digits in a run, as far as they are told apart.
RUNS = 6
#: Classes: 0 padding, 1 any other mark, 2 any other letter, a digit by the length of its run,
#: then letters and marks.
DIGIT = 2
CLASS = {c: i + DIGIT + RUNS + 1 for i, c in enumerate(LETTERS + MARKS)} | {
    c: DIGIT + 1 for c in "0123456789"}
N_CLASSES = DIGIT + RUNS + 1 + len(LETTERS + MARKS)
_ASCII = np.array([CLASS.get(chr(i), 1) for i in range(128)], dtype=np.int16)
_RUN = re.compile("[0-9]+")
#: Weight of a transition that no span allows.
NEVER = -1e4


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = _ASCII[np.minimum(points, 127)]
    for i in np.flatnonzero(points > 127):
        out[i] = 2 if text[i].isalpha() else 1
    for m in _RUN.finditer(text):
        out[m.start():m.end()] = DIGIT + min(m.end() - m.start(), RUNS)
    return out


def batch(texts: list[str], length: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Padded classes (windows, length) and the lengths."""
    sizes = np.array([len(t) for t in texts])
    x = np.zeros((len(texts), length or max(int(sizes.max()), 1)), dtype=np.int16)
    for i, t in enumerate(texts):
        x[i, :len(t)] = classes(t)
    return x, sizes


def tags_of(spans: list[tuple[int, int, int]], length: int) -> np.ndarray:
    """Tags of a window from its spans (start, kind number, end)."""
    y = np.zeros(length, dtype=np.int64)
    for start, kind, end in spans:
        y[start:end] = 2 + 2 * kind
        y[start] = 1 + 2 * kind
    return y


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans (start, kind number, end) of a row of tags."""
    out: list[tuple[int, int, int]] = []
    start = None
    for i, t in enumerate([*tags.tolist(), 0]):
        if start is not None and (t == 0 or t % 2 == 1):
            out.append((start, (tags[start] - 1) // 2, i))
            start = None
        if t % 2 == 1:
            start = i
    return [(a, int(k), b) for a, k, b in out]


@dataclass
class Tagger:
    """Weights: gates of both directions (W, U, a), tag scores (V, c), tag chain (T, first)."""
    kinds: int
    hidden: int
    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, kinds: int, hidden: int, seed: int = 0, dtype=np.float32) -> "Tagger":
        rng = np.random.default_rng(seed)
        h, tags = hidden, 1 + 2 * kinds
        gates = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
        p = {"T": np.zeros((tags, tags)), "first": np.zeros(tags), "c": np.zeros(tags),
             "V": rng.normal(size=(2 * h, tags)) / np.sqrt(2 * h),
             "W": rng.normal(size=(2, N_CLASSES, 4 * h)) * 0.3,
             "U": rng.normal(size=(2, h, 4 * h)) / np.sqrt(h),
             "a": np.stack([gates, gates])[:, None]}
        return cls(kinds, hidden, {k: v.astype(dtype) for k, v in p.items()})

    def allowed(self) -> tuple[np.ndarray, np.ndarray]:
        """0 where a transition (or a first tag) may be, NEVER elsewhere."""
        tags = 1 + 2 * self.kinds
        t, first = np.zeros((tags, tags)), np.zeros(tags)
        for k in range(self.kinds):
            inside = 2 + 2 * k
            t[:, inside] = NEVER
            t[[inside - 1, inside], inside] = 0
            first[inside] = NEVER
        return t, first

    # --- LSTM ----------------------------------------------------------------------------

    def _run(self, x: np.ndarray, on: np.ndarray, keep: bool):
        """Hidden states (length, windows, 2 * hidden); ``keep``: what backpropagation needs.

        Both directions take their steps together: index 0 reads the windows, 1 the
        mirrored windows.  A state is 0 on padding.
        """
        n, length = x.shape
        h = self.hidden
        # A logistic gate is a tanh of half its input.
        half = np.concatenate([np.full(3 * h, 0.5), np.ones(h)]).astype(self.p["U"].dtype)
        w, u = (self.p["W"] + self.p["a"]) * half, self.p["U"] * half
        both, live = (np.stack([v, v[:, ::-1]]) for v in (x, on))
        drive = np.stack([w[d][both[d].T] for d in (0, 1)], axis=1)  # length, direction, n, gates
        live = np.ascontiguousarray(live.transpose(2, 0, 1))[..., None]
        kept = np.zeros((length, 2, n, 7 * h), dtype=w.dtype) if keep else None
        hs = np.zeros((length, 2, n, h), dtype=w.dtype)
        now, cell = hs[0], np.zeros((2, n, h), dtype=w.dtype)
        for t in range(length):
            g = np.tanh(drive[t] + now @ u)
            g[..., :3 * h] *= 0.5
            g[..., :3 * h] += 0.5  # input, forget, output; the rest is the new content
            if keep:
                kept[t, ..., 5 * h:6 * h], kept[t, ..., 6 * h:] = cell, now
            cell = (g[..., h:2 * h] * cell + g[..., :h] * g[..., 3 * h:]) * live[t]
            squash = np.tanh(cell)
            now = g[..., 2 * h:3 * h] * squash
            hs[t] = now
            if keep:
                kept[t, ..., :4 * h], kept[t, ..., 4 * h:5 * h] = g, squash
        return np.concatenate([hs[:, 0], hs[::-1, 1]], axis=2), (both, live, kept)

    def scores(self, x: np.ndarray, sizes: np.ndarray, keep: bool = False):
        """Tag scores (windows, length, tags)."""
        on = (np.arange(x.shape[1])[None] < sizes[:, None]).astype(self.p["V"].dtype)
        hs, trail = self._run(x, on, keep)
        e = (hs @ self.p["V"] + self.p["c"]).transpose(1, 0, 2)
        return (e, on, hs, trail) if keep else e

    # --- training ------------------------------------------------------------------------

    def loss_and_gradient(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray
                          ) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood per window and its gradient."""
        e, on, hs, trail = self.scores(x, sizes, keep=True)
        n, length, tags = e.shape
        open_t, open_first = self.allowed()
        trans, first = np.exp(self.p["T"] + open_t), self.p["first"] + open_first
        # Forward and backward in scaled probabilities; padding passes them on unchanged.
        top = e.max(axis=2, keepdims=True)
        q = np.exp(e - top)
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        scale = np.ones((n, length), dtype=e.dtype)
        a = q[:, 0] * np.exp(first)
        scale[:, 0] = a.sum(1)
        alpha[:, 0] = a / scale[:, :1]
        for t in range(1, length):
            a = (alpha[:, t - 1] @ trans) * q[:, t]
            s = a.sum(1)
            live = on[:, t] > 0
            scale[:, t] = np.where(live, s, 1.0)
            alpha[:, t] = np.where(live[:, None], a / s[:, None], alpha[:, t - 1])
        beta[:, -1] = 1.0
        for t in range(length - 2, -1, -1):
            b = ((q[:, t + 1] * beta[:, t + 1]) @ trans.T) / scale[:, t + 1, None]
            beta[:, t] = np.where(on[:, t + 1, None] > 0, b, 1.0)
        rows, cols = np.arange(n)[:, None], np.arange(length)[None]
        log_z = (np.log(scale) * on).sum() + (top[..., 0] * on).sum()
        gold = (e[rows, cols, y] * on).sum() + first[y[:, 0]].sum()
        step = on[:, 1:]
        gold += ((self.p["T"] + open_t)[y[:, :-1], y[:, 1:]] * step).sum()
        loss = (log_z - gold) / n
        de = alpha * beta * on[..., None]
        pair = np.einsum("nti,ntj->ij", alpha[:, :-1] * step[..., None],
                         q[:, 1:] * beta[:, 1:] / scale[:, 1:, None]) * trans
        g = {"first": (alpha[:, 0] * beta[:, 0]).sum(0), "T": pair}
        np.subtract.at(g["first"], y[:, 0], 1.0)
        np.subtract.at(g["T"], (y[:, :-1], y[:, 1:]), step)
        de[rows, cols, y] -= on
        de = de.transpose(1, 0, 2)
        flat = de.reshape(-1, tags)
        g["V"], g["c"] = hs.reshape(-1, 2 * self.hidden).T @ flat, flat.sum(0)
        g |= self._back(trail, de @ self.p["V"].T)
        return float(loss), {k: v / n for k, v in g.items()}

    def _back(self, trail, dh: np.ndarray) -> dict[str, np.ndarray]:
        both, live, kept = trail
        length, _, n, _ = kept.shape
        h, u = self.hidden, self.p["U"]
        dh = np.stack([dh[..., :h], dh[::-1, :, h:]], axis=1)
        dz = np.zeros((length, 2, n, 4 * h), dtype=u.dtype)
        d_now = d_cell = np.zeros((2, n, h), dtype=u.dtype)
        for t in range(length - 1, -1, -1):
            i, f, o, new, squash, before, _ = np.split(kept[t], 7, axis=-1)
            out = dh[t] + d_now
            dc = (d_cell + out * o * (1 - squash * squash)) * live[t]
            z = dz[t]
            z[..., :h] = dc * new * i * (1 - i)
            z[..., h:2 * h] = dc * before * f * (1 - f)
            z[..., 2 * h:3 * h] = out * squash * o * (1 - o) * live[t]
            z[..., 3 * h:] = dc * i * (1 - new * new)
            d_now, d_cell = z @ u.transpose(0, 2, 1), dc * f
        gw, gu = np.zeros_like(self.p["W"]), np.zeros_like(u)
        for d in (0, 1):
            flat = np.ascontiguousarray(dz[:, d]).reshape(length * n, -1)
            seen = both[d].T.ravel()
            order = np.argsort(seen, kind="stable")
            found, first = np.unique(seen[order], return_index=True)
            gw[d][found] = np.add.reduceat(flat[order], first, axis=0)
            gu[d] = np.ascontiguousarray(kept[:, d, :, 6 * h:]).reshape(length * n, h).T @ flat
        return {"W": gw, "U": gu, "a": gw.sum(1, keepdims=True)}

    def train(self, texts: list[str], spans: list[list[tuple[int, int, int]]], epochs: int,
              size: int = 128, rate: float = 0.04, seed: int = 0) -> "Tagger":
        """Adam over shuffled batches of windows (start, kind number, end)."""
        x, sizes = batch(texts)
        y = np.array([tags_of(s, x.shape[1]) for s in spans])
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, epochs * -(-len(texts) // size)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for lo in range(0, len(order), size):
                pick = order[lo:lo + size]
                _, g = self.loss_and_gradient(x[pick], sizes[pick], y[pick])
                step += 1
                lr = rate * min(1.0, step / 20) * (1 - 0.95 * step / total)
                for k, p in self.p.items():
                    m[k] += 0.1 * (g[k] - m[k])
                    v2[k] += 0.01 * (g[k] ** 2 - v2[k])
                    p -= lr * (m[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-8)
        return self

    # --- decoding ------------------------------------------------------------------------

    def decode(self, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
        """Spans (start, kind number, end, score) of every window.

        A span's score is how much its tags' scores exceed those of ``O``.
        """
        x, sizes = batch(texts)
        e = self.scores(x, sizes)
        n, length, tags = e.shape
        open_t, open_first = self.allowed()
        trans = (self.p["T"] + open_t).astype(e.dtype)
        best = e[:, 0] + (self.p["first"] + open_first).astype(e.dtype)
        back = np.zeros((length, n, tags), dtype=np.int16)
        for t in range(1, length):
            reach = best[:, :, None] + trans[None]
            back[t] = reach.argmax(1)
            moved = np.take_along_axis(reach, back[t][:, None, :].astype(np.int64), 1)[:, 0] + e[:, t]
            best = np.where((t < sizes)[:, None], moved, best)
        path = np.zeros((n, length), dtype=np.int64)
        tag = best.argmax(1)
        for t in range(length - 1, -1, -1):
            path[:, t] = np.where(t < sizes, tag, 0)
            if t:
                tag = np.where(t < sizes, back[t][np.arange(n), tag], tag)
        gain = np.take_along_axis(e, path[..., None], 2)[..., 0] - e[..., 0]
        out = []
        for i in np.arange(n):
            found = spans_of(path[i, :sizes[i]]) if path[i].any() else []
            out.append([(a, k, b, float(gain[i, a:b].sum())) for a, k, b in found])
        return out
