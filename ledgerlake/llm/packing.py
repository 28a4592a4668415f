"""Best-fit packing of token pieces into sequences (best-two-fit).

Tokenisation: ids of the given tokenizer, then the end id.  White space never enters a
token of this vocabulary (its pre-tokenizer drops it and no token spans it), so the ids
of a plain text are the ids of its words put together; each Python worker asks the
tokenizer's model for a distinct word once and remembers the answer in a bounded cache.

Packing: a document longer than a sequence is cut into full pieces and one rest.  Pieces
are dealt into partitions of about ``GROUP`` pieces (round robin, so neither a source nor
a size can make one large), and each task packs its partition from (piece, length) rows
alone, texts stay behind.  A bin is filled greedily with the longest piece that fits.  If
a gap remains, the bin's smallest piece is taken out and the two unpacked pieces that
fill the expanded gap most tightly (and better than before) take its place.  A partition
leaves about one sequence partly empty.

NULL and empty texts are one end id.  Repeated rows are packed one by one.  NULL doc_ids
and extra columns are carried or ignored like any other value.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import CACHE_WORDS, map_rows
from ledgerlake.session import materialize

SEQUENCE = 4096
END_ID = 1
GROUP = 20_000


#: Characters for which lower-casing, normal form and word pattern below agree with the
#: tokenizer's own (fixed: ASCII and the Latin letters up to U+017F without the dotted I).
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿĀ-įı-ſ]*")
#: The vocabulary's pre-tokenizer pattern for plain text (fixed value).
PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes as they are, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Ids(dict):
    """Lower-cased plain word -> its token ids as little-endian unsigned 32-bit bytes.

    ``of`` gives the ids of a whole text.  Plain text is cut at white space and each
    distinct word is tokenised once; other text goes through the tokenizer as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = []
        for p in PRETOKEN.findall(word):
            p = p if p.isascii() else p.encode().decode("latin-1").translate(self.letters)
            out += [t.id.to_bytes(4, "little") for t in self.model.tokenize(p)]
        ids = self[word] = b"".join(out)
        return ids

    def of(self, text: str) -> bytes:
        if "<|" not in text and PLAIN.fullmatch(text):
            return b"".join(map(self.__getitem__, text.lower().split()))
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()


_IDS: dict[str, Ids] = {}


def ids_by(path: str) -> Ids:
    """The word cache of this Python worker; tasks that follow one another share it."""
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


def pieces(documents: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID
           ) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = ids_by(tokenizer)
        end = end_id.to_bytes(4, "little")
        for doc_id, text in rows:
            data = ids.of(text or "") + end
            for k, lo in enumerate(range(0, len(data), 4 * sequence)):
                part = data[lo:lo + 4 * sequence]
                yield doc_id, k, lo // 4, len(part) // 4, zlib.crc32(part)

    return map_rows(documents.select("doc_id", "text"), run,
                    "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- best-two-fit ----------------------------------------------------------------------

class Pool:
    """Unpacked pieces by length."""

    def __init__(self, lengths: Iterable[int]):
        self.by: dict[int, list[int]] = {}
        for i, n in enumerate(lengths):
            self.by.setdefault(n, []).append(i)
        self.sizes = sorted(self.by)

    def longest(self, most: int) -> int | None:
        k = bisect_right(self.sizes, most)
        return self.sizes[k - 1] if k else None

    def take(self, n: int) -> int:
        at = self.by[n]
        i = at.pop()
        if not at:
            del self.by[n]
            self.sizes.pop(bisect_left(self.sizes, n))
        return i

    def put(self, n: int, i: int) -> None:
        if n not in self.by:
            insort(self.sizes, n)
        self.by.setdefault(n, []).append(i)

    def best_pair(self, room: int, above: int) -> tuple[int, int] | None:
        """Two lengths with the largest sum that is at most ``room`` and over ``above``."""
        s, best, found = self.sizes, above, None
        lo, hi = 0, bisect_right(s, room) - 1
        while lo <= hi and hi >= 0:
            if lo == hi and len(self.by[s[lo]]) < 2:
                break
            total = s[lo] + s[hi]
            if total > room:
                hi -= 1
                continue
            if total > best:
                best, found = total, (s[lo], s[hi])
                if total == room:
                    break
            lo += 1
        return found


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices into ``lengths``; every length is between 1 and ``capacity``."""
    pool = Pool(lengths)
    bins = []
    while pool.sizes:
        room, now = capacity, []
        while (n := pool.longest(room)) is not None:
            now.append(pool.take(n))
            room -= n
        if room and len(now) > 1:
            small = lengths[now[-1]]  # greedy filling takes falling lengths
            pair = pool.best_pair(room + small, small)
            if pair:
                pool.put(small, now.pop())
                now += [pool.take(pair[1]), pool.take(pair[0])]
        bins.append(now)
    return bins


def pack(parts: DataFrame, sequence: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """``parts`` (columns of ``pieces``) with sequence_id and offset."""
    parts = materialize(parts, "pieces")
    groups = max(1, -(-parts.count() // group))

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        rows = sorted(rows, key=lambda r: (r[3], r[0] is None, r[0] or 0, r[1], r[4]))
        for b, bin_ in enumerate(best_two_fit([r[3] for r in rows], sequence)):
            at = 0
            for i in bin_:
                yield *rows[i], (part << 32) + b, at
                at += rows[i][3]

    return map_rows(parts.repartition(groups), run,
                    "doc_id long, piece int, start long, length long, ids_crc32 long, "
                    "sequence_id long, offset long")
