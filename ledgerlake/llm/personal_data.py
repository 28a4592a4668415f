"""Personal data: exact base rules, and spans added by a character BiLSTM with a CRF.

Base kinds (email, ip, card, phone) are found by their patterns, leftmost and without
overlap.  The tagger (``tagger.py``) adds spans of the kinds in ``ADDED``, which no base
rule describes.  It is trained in numpy from labelled spans: windows of a bounded sample
of documents (``SAMPLE_DOCS`` documents, the smallest hashes of doc_id; at most
``SAMPLE_WINDOWS`` windows each), where the base rules label what they find and forms of
every kind, written by the fixed rules in ``planted``, are set between words.

Every kind holds a digit, an ``@`` or a bracketed ``at``: text is tagged within ``REACH``
characters of such a mark, which is all of the text that can hold a span; a span
without one is not a span.  The marked stretches are cut into windows of ``WINDOW``
characters that overlap by half.  Every window is decoded by itself.  The spans of all
windows of a text are then reconciled at once: parts of a span that a window's edge
cut are united, spans that overlap a base match, also a failed one, go, a shape check per
kind drops what cannot be one (a wrong checksum, say), and among those that still overlap
the choice with the highest total score is taken (weighted interval scheduling).

On Spark: one job brings the sample's windows to the driver, then one pass over all
documents; nothing is shuffled.  A task holds one text and a batch of windows.

Defined cases: NULL and empty texts have no spans; very long texts are scanned whole, window
by window; repeated rows and NULL doc_ids are scanned like others; an empty table gives no
rows (and a tagger trained on planted forms alone); other columns are ignored.  Offsets are
code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows
from ledgerlake.llm.tagger import Tagger

#: Base kinds in the order that breaks ties, then the kinds that are added.
BASE = ("email", "ip", "card", "phone")
ADDED = ("masked_email", "local_phone", "ssn", "iban")
KINDS = BASE + ADDED

WINDOW = 96
REACH = 40
HIDDEN = 12
EPOCHS = 18
#: Training: documents of the sample, windows of each, and made windows.
SAMPLE_DOCS = 150
SAMPLE_WINDOWS = 3
MADE = 2000
#: Windows that a task decodes at once, and documents that wait for it.
BATCH = 1024
_MARK = re.compile(r"[0-9@]|[(\[] ?at ?[)\]]")

Span = tuple[int, int, int]  # start, kind number, end


# --- base rules ------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts at the first digit of a run, so later digits need not be tried.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address grows to the left of its ``@``, at most to the end of the one before."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def base_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind number, end, holds) of every match of a base pattern."""
    out = [(a, 0, b, True) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.groups())
        out.append((m.start(), 1, m.end(), all(len(p) < 4 and int(p or 0) < 256 for p in parts)))
    for m in _CARD.finditer(text):
        d = _digits(m.group()) if m.end() - m.start() < 40 else ""
        out.append((m.start(), 2, m.end(), 14 <= len(d) <= 19 and luhn(d)))
    for m in _PHONE.finditer(text):
        out.append((m.start(), 3, m.end(), 10 <= len(_digits(m.group())) <= 15))
    return sorted(out)


def base_spans(text: str) -> list[Span]:
    return [m[:3] for m in base_matches(text) if m[3]]


# --- labelled spans --------------------------------------------------------------------

def _number(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def iban_check(country: str, rest: str) -> str:
    """The two check digits of an account number."""
    value = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{98 - value % 97:02d}"


def planted(rng: random.Random, kind: str, words: list[str]) -> str:
    """A made-up value of a kind (fixed forms)."""
    word = lambda: re.sub(r"[^A-Za-z]", "", rng.choice(words)).lower() or "anna"
    if kind == "email":
        return (word() + rng.choice(["", ".", "_", "."]) + rng.choice([word(), _number(rng, 2)])
                + "@" + word() + rng.choice(["", _number(rng, 1)])
                + rng.choice([".com", ".org", ".example.com", ".net", ".de"]))
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == "card":
        d = rng.choice("3456") + _number(rng, 14)
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = rng.choice(["", "", " ", "-"])
        return sep.join(d[i:i + 4] for i in range(0, 16, 4)) if sep else d
    if kind == "phone":
        return rng.choice([
            f"+{rng.randrange(1, 99)} ({_number(rng, 3)}) {_number(rng, 3)}-{_number(rng, 4)}",
            f"+{rng.randrange(1, 99)} {_number(rng, 3)} {_number(rng, 3)} {_number(rng, 4)}",
            f"+{rng.randrange(10, 99)}-{_number(rng, 3)}-{_number(rng, 7)}"])
    if kind == "masked_email":
        at = rng.choice([" (at) ", "(at)", " [at] ", "[at]"])
        dot = rng.choice([" (dot) ", "(dot)", " [dot] ", "[dot]", "."])
        return f"{word()}{rng.choice(['', '.' + word(), _number(rng, 2)])}{at}{word()}{dot}" \
               + rng.choice(["com", "org", "net", "de"])
    if kind == "local_phone":
        return rng.choice([f"({_number(rng, 3)}) {_number(rng, 3)}-{_number(rng, 4)}",
                           f"{_number(rng, 3)}-{_number(rng, 3)}-{_number(rng, 4)}",
                           f"{_number(rng, 3)}.{_number(rng, 3)}.{_number(rng, 4)}"])
    if kind == "ssn":
        return f"{rng.randrange(1, 666):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}"
    country = rng.choice(["DE", "FR", "ES", "GB", "NL", "IT"])
    rest = _number(rng, rng.choice([14, 18, 18, 20]))
    flat = country + iban_check(country, rest) + rest
    return flat if rng.random() < 0.4 else " ".join(flat[i:i + 4] for i in range(0, len(flat), 4))


#: Kinds as they are drawn: base kinds need no learning but as what the others are not.
DRAWN = [KINDS.index(k) for k in BASE + 2 * ADDED + 2 * ("masked_email",)]


def plain_number(rng: random.Random) -> str:
    """Digits that are nobody's data: years, amounts, dates, versions, hashes, times."""
    return rng.choice([
        str(rng.randrange(1900, 2100)), _number(rng, rng.randrange(1, 8)),
        f"{rng.randrange(1, 999)},{_number(rng, 3)}.{_number(rng, 2)}",
        f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}",
        f"{rng.randrange(1, 13):02d}/{rng.randrange(1, 29):02d}/{rng.randrange(1990, 2030)}",
        f"{rng.randrange(1, 9)}.{rng.randrange(20)}", f"{rng.randrange(1, 9)}.{rng.randrange(9)}.{rng.randrange(30)}",
        f"{rng.randrange(24):02d}:{rng.randrange(60):02d}", f"{rng.randrange(100)}%",
        "%x" % rng.getrandbits(128), f"{_number(rng, 3)}-{_number(rng, 4)}",
        f"{_number(rng, 4)}-{_number(rng, 4)}", "@" + rng.choice("abcdefgh") * 3, _number(rng, 9),
        f"{rng.randrange(1, 99)}-{rng.randrange(1, 99)}", _number(rng, rng.randrange(20, 30))])


#: Plain words, used where the sample has too few.
WORDS = ("the house and a river near old town where people met to talk about work for "
         "their families la casa del pueblo con una calle larga le jardin de ma soeur est "
         "grand der weg nach hause war weit und dunkel").split()


def clipped(spans: list[Span], lo: int) -> list[Span]:
    """The parts of spans that lie in the window at ``lo``."""
    return [(max(a - lo, 0), k, min(b - lo, WINDOW)) for a, k, b in spans
            if a < lo + WINDOW and b > lo]


def labelled(windows: list[tuple[str, list[Span]]], n: int, seed: int = 0
             ) -> tuple[list[str], list[list[Span]]]:
    """Training windows and their spans.

    The sample's windows as they are (base spans labelled), then ``n`` made ones: words of
    the sample around a planted value or a plain number.
    """
    rng = random.Random(seed)
    texts = [w for w, _ in windows if w]
    spans = [s for w, s in windows if w]
    words = [x for w in texts for x in w.split() if not re.search(r"[0-9@]", x)] + WORDS
    while len(words) < 1000:
        words += WORDS
    for i in range(n):
        text, found = "", []
        for _ in range(rng.choice([1, 1, 2])):
            text += " ".join(rng.choice(words) for _ in range(rng.randrange(0, 6)))
            text += rng.choice([" ", " ", " ", "\n", ", ", ": ", " | ", " (", " \""]) if text else ""
            if rng.random() < 0.35:
                text += plain_number(rng)
            else:
                kind = rng.choice(DRAWN)
                value = planted(rng, KINDS[kind], words)
                if rng.random() < 0.05:
                    value = value.upper()
                found.append((len(text), kind, len(text) + len(value)))
                text += value
            text += rng.choice([" ", " ", ". ", ", ", "\n", "\n", "!! ", "$$$ ", " | ", ") "])
        text += " ".join(rng.choice(words) for _ in range(rng.randrange(0, 5)))
        # The cut may fall into a value, as the edge of a window does.
        lo = rng.randrange(0, max(1, len(text) - WINDOW + 1))
        texts.append(text[lo:lo + WINDOW])
        spans.append(clipped(found, lo))
    return texts, spans


def sample_windows(text: str, seed: int, most: int = SAMPLE_WINDOWS
                   ) -> list[tuple[str, list[Span]]]:
    """At most ``most`` windows of a text with base spans: around marks first, then anywhere."""
    rng = random.Random(seed)
    base = base_spans(text)
    at = [m.start() for m in _MARK.finditer(text)]
    at = rng.sample(at, min(len(at), most - 1))
    at += [rng.randrange(max(len(text), 1)) for _ in range(most - len(at))]
    out = []
    for p in at:
        lo = max(0, min(p - rng.randrange(WINDOW), len(text) - WINDOW))
        out.append((text[lo:lo + WINDOW], clipped(base, lo)))
    return out


def fit(documents: DataFrame, docs: int = SAMPLE_DOCS, made: int = MADE) -> Tagger:
    """Train on windows of at most ``docs`` documents (all that reaches the driver)."""
    rank = F.struct(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    picked = documents.filter("text IS NOT NULL AND doc_id IS NOT NULL").select(
        "doc_id", "text").orderBy(rank).limit(docs)

    def cut(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            for w, spans in sample_windows(text, doc_id):
                yield doc_id, w, [x for span in spans for x in span]

    got = sorted(map(tuple, map_rows(picked, cut, "doc_id long, w string, s array<int>").collect()))
    windows = [(w, [tuple(s[i:i + 3]) for i in range(0, len(s), 3)]) for _, w, s in got]
    texts, spans = labelled(windows, made)
    return Tagger.fresh(len(KINDS), HIDDEN).train(texts, spans, EPOCHS)


# --- scanning --------------------------------------------------------------------------

def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Parts of a text within REACH of a mark."""
    lo = hi = None
    for m in _MARK.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if hi is not None and a <= hi:
            hi = b
            continue
        if hi is not None:
            yield lo, hi
        lo, hi = a, b
    if hi is not None:
        yield lo, hi


def windows_of(lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Windows of a stretch, overlapping by half; the last one ends with it."""
    at = lo
    while True:
        yield at, min(at + WINDOW, hi)
        if at + WINDOW >= hi:
            return
        at += WINDOW // 2


def apart(text: str, a: int, b: int) -> bool:
    """Whether no letter or digit touches a span, also not across one ``-`` or ``.``."""
    left, right = text[max(a - 2, 0):a], text[b:b + 2]
    return not (re.search(r"\w$|[0-9][-.]$", left) or re.match(r"\w|[-.][0-9]", right))


def shaped(kind: str, value: str) -> bool:
    """Whether a value can be of an added kind (exact checks)."""
    digits = _digits(value)
    if kind == "masked_email":
        return re.fullmatch(r"[\w.%+-]+ ?[(\[] ?at ?[)\]] ?[\w.-]+(?: ?[(\[] ?dot ?[)\]] ?[\w-]+|\.[\w-]+)+",
                            value.lower()) is not None
    if kind == "local_phone":
        return (re.fullmatch(r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}", value) is not None)
    if kind == "ssn":
        return (re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", value) is not None
                and digits[:3] not in ("000", "666") and digits[0] != "9"
                and digits[3:5] != "00" and digits[5:] != "0000")
    flat = value.replace(" ", "")
    return (re.fullmatch(r"[A-Z]{2}[0-9]{2}[0-9A-Z]{10,30}", flat) is not None
            and flat.isascii() and int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1)


def reconcile(found: list[tuple[int, int, int, float, bool, bool]], text: str,
              base: list[tuple]) -> list[Span]:
    """One set of spans without overlaps from the spans of all windows of a text.

    ``found``: start, kind, end, score, whether the window's edge cut it on the left, on
    the right.  ``base``: matches (start, kind, end, ...) that nothing may overlap.
    """
    whole: dict[Span, float] = {}
    parts: list[list] = []
    for a, k, b, score, left, right in sorted(found):
        if not left and not right:
            whole[(a, k, b)] = max(score, whole.get((a, k, b), score))
        # A cut span also unites with the next ones of its kind that overlap it.
        for p in parts:
            if p[1] == k and a <= p[2] and p[4] and b >= p[2]:
                p[2], p[3], p[4] = b, p[3] + score, right
        if right and not left:
            parts.append([a, k, b, score, True])
    for a, k, b, score, still in parts:
        if not still:
            whole[(a, k, b)] = max(score, whole.get((a, k, b), score))
    starts = [m[0] for m in base]
    ends, top = [], 0
    for m in base:
        top = max(top, m[2])
        ends.append(top)

    def free(a: int, b: int) -> bool:
        i = bisect_right(starts, b - 1) - 1
        return i < 0 or ends[i] <= a

    able = sorted(((a, k, b), s) for (a, k, b), s in whole.items()
                  if k >= len(BASE) and s > 0 and free(a, b) and apart(text, a, b)
                  and shaped(KINDS[k], text[a:b]))
    if not able:
        return []
    able.sort(key=lambda x: (x[0][2], x[0]))
    stops = [x[0][2] for x in able]
    best: list[tuple[float, int | None, int]] = [(0.0, None, 0)]  # total, span taken, go on at
    for i, ((a, _, _), s) in enumerate(able):
        before = bisect_right(stops, a, 0, i)
        take = best[before][0] + s
        best.append((take, i, before) if take > best[i][0] else (best[i][0], None, i))
    out, i = [], len(able)
    while i:
        _, taken, i = best[i]
        if taken is not None:
            out.append(able[taken][0])
    return sorted(out)


def scan_texts(rows: Iterable[tuple], model: Tagger) -> Iterator[tuple]:
    """(doc_id, text) rows to (doc_id, base spans, added spans), in order."""
    waiting: list[list] = []  # doc_id, text, base matches, found, windows left
    queue: list[tuple[list, int, int, bool, bool]] = []
    held = 0

    def decode() -> None:
        texts = [doc[1][a:b] for doc, a, b, _, _ in queue]
        distinct = list(dict.fromkeys(texts))
        spans = dict(zip(distinct, model.decode(distinct)))
        for (doc, a, b, first, last), t in zip(queue, texts):
            for x, k, y, score in spans[t]:
                doc[3].append((a + x, k, a + y, score, x == 0 and not first,
                               a + y == b and not last))
        queue.clear()

    def done() -> Iterator[tuple]:
        for doc_id, text, base, found in waiting:
            # A failed card is only a run of digits, which may be of another kind.
            taken = [m for m in base if m[3] or m[1] != BASE.index("card")]
            yield doc_id, [m[:3] for m in base if m[3]], reconcile(found, text, taken)
        waiting.clear()

    for doc_id, text in rows:
        text = text or ""
        doc = [doc_id, text, base_matches(text), []]
        waiting.append(doc)
        held += len(text)
        for lo, hi in stretches(text):
            for a, b in windows_of(lo, hi):
                queue.append((doc, a, b, a == lo, b == hi))
                if len(queue) >= BATCH:
                    decode()
        if held > 4_000_000 or len(waiting) >= 4 * BATCH:
            if queue:
                decode()
            held = 0
            yield from done()
    if queue:
        decode()
    yield from done()


def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(documents: DataFrame, model: Tagger) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document row."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, base, added in scan_texts(rows, model):
            yield (doc_id, *[sum(s[1] == k for s in base) for k in range(len(BASE))],
                   hashlib.sha256(named(base).encode()).hexdigest(), named(base + added))

    return map_rows(documents.select("doc_id", "text"), run,
                    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                    "base_sha256 string, spans string")
