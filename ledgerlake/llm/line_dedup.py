"""Line dedup by pairwise alignment: patience diff against the first holder of a line.

1. Every line with a word is hashed (128 bits); lines that only one document holds
   are dropped by an aggregation with a map-side part, so a line that a third of all
   documents share is a handful of partial rows.
2. Overlapping documents are found through rare pieces: lines of ``MIN_WORDS`` words
   or more and, around shorter lines, the shortest runs of adjacent shared lines that
   reach ``MIN_WORDS`` words together (at most ``MIN_WORDS`` lines); texts do not share
   either by chance.  Each common block is made of such pieces.  A piece pairs each later
   document with the *first* document that holds it, so a piece held by n documents
   gives n - 1 pairs, not n * (n - 1) / 2, whatever its frequency; no line is left
   out and there is no cap on holders.  So a line goes exactly if it stands in a block
   that any earlier document holds.
3. Both documents' shared lines are aligned with patience diff (lines unique in both
   are anchors; the stretches between them are aligned in the same way).
4. Aligned runs without a gap are common blocks; a block of ``MIN_WORDS`` words or
   more is deleted from the later document.  Lines that are left are looked up in the
   whole earlier document, so blocks in another order and further copies of a block go,
   too, until the pair has no common block.  Since every block is held by its first
   document, nothing is deleted everywhere.

Documents are ordered by (doc_id, digest of the text); rows with equal doc_id and text
are one document and are treated alike.  A NULL doc_id sorts before all others.  NULL
and empty texts have no lines and stay as they are.  Blank lines are never deleted and
do not split a block.  Extra columns pass through ``dedup_lines`` untouched.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows, text_digest, whole_row
from ledgerlake.session import materialize

MIN_WORDS = 5
#: Word separators inside a line (fixed: ASCII white space).
WORD = "[^\\x20\\x09-\\x0D]+"


# --- patience diff ---------------------------------------------------------------------

def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs (sorted by the first) that rises in the second, too."""
    tails: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        back[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(b)
            at.append(i)
        else:
            tails[k], at[k] = b, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned index pairs of two sequences, rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        ca, cb = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {x: j for j, x in enumerate(b[b0:b1], b0) if cb[x] == 1}
        pairs = [(i, where[a[i]]) for i in range(a0, a1) if ca[a[i]] == 1 and a[i] in where]
        if pairs:
            last = (a0, b0)
            for i, j in increasing(pairs):
                out.append((i, j))
                todo.append((last[0], i, last[1], j))
                last = (i + 1, j + 1)
            todo.append((last[0], a1, last[1], b1))
        else:  # no line is unique in both: the k-th copy meets the k-th copy
            copies: dict = {}
            for j in range(b0, b1):
                copies.setdefault(b[j], []).append(j)
            used: Counter = Counter()
            pairs = []
            for i in range(a0, a1):
                places = copies.get(a[i], ())
                if used[a[i]] < len(places):
                    pairs.append((i, places[used[a[i]]]))
                    used[a[i]] += 1
            out += increasing(pairs)
    return sorted(out)


def runs_of(lines: list[tuple], k: int, min_words: int) -> Iterator[tuple]:
    """Hashes of the shortest runs of adjacent lines with line ``k`` and ``min_words`` words.

    No run can lose an end other than ``k``, so it has ``min_words`` lines at most; each
    block of ``min_words`` words or more with line ``k`` contains one.
    """
    first, left = k, lines[k][2]
    while True:
        last, words = k, left
        while words < min_words and last + 1 < len(lines) \
                and lines[last + 1][0] == lines[last][0] + 1:
            last += 1
            words += lines[last][2]
        if words >= min_words and (first == k or words - lines[first][2] < min_words):
            yield tuple(x[3] for x in lines[first:last + 1])
        if left >= min_words or first == 0 or lines[first - 1][0] != lines[first][0] - 1:
            return
        first -= 1
        left += lines[first][2]


def common_blocks(early: list[tuple], late: list[tuple], min_words: int) -> list[int]:
    """Line numbers of ``late`` in common blocks of ``min_words`` words or more.

    Lines are (place among the lines with a word, line number, words, hash).  Lines that
    the alignment leaves are looked up in the whole earlier sequence, in any order and as
    often as they come.
    """
    pairs = patience([x[3] for x in early], [x[3] for x in late])
    out: list[int] = []
    block: list[int] = []
    last = None
    for i, j in [*pairs, (None, None)]:
        if i is not None and last and early[i][0] == early[last[0]][0] + 1 \
                and late[j][0] == late[last[1]][0] + 1:
            block.append(j)
        else:
            if sum(late[k][2] for k in block) >= min_words:
                out += [late[k][1] for k in block]
            block = [] if j is None else [j]
        last = (i, j)
    gone = set(out)
    known = {x[3] for x in early}
    rest = [k for k, x in enumerate(late) if x[1] not in gone and x[3] in known]
    if rest:
        held = {r for k in range(len(early)) for r in runs_of(early, k, min_words)}
        out += [late[k][1] for k in rest
                if any(r in held for r in runs_of(late, k, min_words))]
    return sorted(out)


# --- Spark -----------------------------------------------------------------------------

def lines_of(documents: DataFrame) -> DataFrame:
    """id, digest, place, line, words, hash of every line with a word."""
    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            data = text.encode()
            digest = hashlib.md5(data).digest()
            place = 0
            for line, x in enumerate(data.split(b"\n")):
                words = len(x.split())  # bytes.split() cuts at ASCII white space
                if words:
                    yield doc_id, digest, place, line, words, hashlib.md5(x).digest()
                    place += 1

    return map_rows(documents.filter(F.col("text").isNotNull()).select("doc_id", "text"), run,
                    "id long, digest binary, place int, line int, words int, hash binary")


def shared_lines(documents: DataFrame) -> DataFrame:
    """key, first (the first holder's key), place, line, words, hash of each shared line."""
    lines = materialize(lines_of(documents), "lines").select(
        F.struct("id", "digest").alias("key"), "place", "line", "words", "hash")
    holders = (lines.groupBy("hash").agg(F.min("key").alias("first"), F.max("key").alias("last"))
               .filter("first != last").select("hash", "first"))
    return materialize(lines.join(holders, "hash"), "shared-lines")


def run_pairs(own: DataFrame, min_words: int) -> DataFrame:
    """late, early: a document and the first holder of one of its runs of several lines."""
    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc, digest, *x in rows:
            lines = list(zip(*x))
            for r in {r for k, line in enumerate(lines) if line[2] < min_words
                      for r in runs_of(lines, k, min_words)}:
                yield doc, digest, hashlib.md5(b"".join(r)).digest()

    short = own.filter(F.exists("lines", lambda x: x["words"] < min_words))
    runs = materialize(map_rows(
        short.select("key.id", "key.digest",
                     *[F.col(f"lines.{c}").alias(c) for c in ("place", "line", "words", "hash")]),
        run, "id long, digest binary, run binary"), "line-runs").select(
            F.struct("id", "digest").alias("key"), "run")
    holders = (runs.groupBy("run").agg(F.min("key").alias("first"), F.max("key").alias("last"))
               .filter("first != last").select("run", "first"))
    return (runs.join(holders, "run").filter(F.col("key") != F.col("first"))
            .select(F.col("key").alias("late"), F.col("first").alias("early")))


def deletions(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """key, lines (sorted line numbers to delete), sources (earlier doc_ids)."""
    shared = shared_lines(documents)
    # A document's own lines: bounded by its text, not by the corpus.
    own = (shared.groupBy("key")
           .agg(F.sort_array(F.collect_set(F.struct("place", "line", "words", "hash"))).alias("lines")))
    pairs = (shared.filter((F.col("words") >= min_words) & (F.col("key") != F.col("first")))
             .select(F.col("key").alias("late"), F.col("first").alias("early"))
             .union(run_pairs(own, min_words)).distinct())
    both = (pairs.join(own.select(F.col("key").alias("early"), F.col("lines").alias("early_lines")),
                       "early")
            .join(own.select(F.col("key").alias("late"), F.col("lines").alias("late_lines")), "late")
            .select(F.col("late.id"), F.col("late.digest"), F.col("early.id").alias("early_id"),
                    *[F.col(f"{s}_lines.{c}").alias(f"{s}_{c}")
                      for s in ("early", "late") for c in ("place", "line", "words", "hash")]))

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc, digest, early_id, *x in rows:
            gone = common_blocks(list(zip(*x[:4])), list(zip(*x[4:])), min_words)
            if gone:
                yield doc, digest, early_id, gone

    found = map_rows(both, run, "id long, digest binary, early_id long, lines array<int>")
    return (found.groupBy("id", "digest")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("lines"),
                 F.array_sort(F.collect_set("early_id")).alias("sources")))


def rewritten(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """row (all columns of a document as a struct), text (rewritten), gone (line numbers or
    NULL), sources (earlier doc_ids or NULL) of every document row."""
    gone = deletions(documents, min_words)
    docs = documents.select(whole_row(documents).alias("row"), F.col("doc_id").alias("doc"),
                            text_digest(F.col("text")).alias("key"))
    # A partition of ``gone`` (line numbers) is hashed; texts stream past it unsorted.
    joined = docs.join(gone.hint("shuffle_hash"), docs["doc"].eqNullSafe(gone["id"])
                       & (docs["key"] == gone["digest"]), "left")
    text = F.col("row.text")
    lines = F.split(text, "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "lines")
    # One split for all lines of a text: the array is the argument of a lambda.
    kept = F.element_at(F.transform(F.array(lines), lambda ls: F.array_join(
        F.transform(stay, lambda i: F.get(ls, i)), "\n")), 1)
    return joined.select("row", F.when(F.col("lines").isNull(), text).otherwise(kept).alias("text"),
                         F.col("lines").alias("gone"), "sources")


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with the text rewritten, plus n_lines, deleted_lines and deleted_from.

    Columns of ``documents`` with one of these three names are replaced.
    """
    lines = F.split("row.text", "\n", -1)
    report = {"n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
              "deleted_lines": F.coalesce("gone", F.array().cast("array<int>")),
              "deleted_from": F.coalesce("sources", F.array().cast("array<long>"))}
    return rewritten(documents, min_words).select(
        *[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
          for c in documents.columns if c not in report],
        *[v.alias(c) for c, v in report.items()])
