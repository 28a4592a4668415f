"""Near-duplicate documents: BagMinHash signatures, banding, exact multiset overlap.

A document is the multiset of its ``SHINGLE``-word shingles (lower-cased ``\\w+`` words; a
text of fewer words is one shingle).  Two documents are linked when the weighted
Jaccard similarity of their multisets is ``THRESHOLD`` or more; a class is a
connected component of links.

Signature (BagMinHash): the weight axis of a shingle is cut into dyadic intervals
[0,1), [1,2), [2,4), [4,8) ...; each interval carries a Poisson process in time whose
rate is its width.  A point has a time, a register and a place in its interval, all
derived from (shingle, interval, number of the point); it counts for a document if its
place lies below the shingle's weight there.  A register keeps its first point, so two
documents agree in a register with exactly the probability of their weighted Jaccard
similarity.  Points are drawn in rounds; a process ends once its next point comes
after the latest register, so long documents need about one point a shingle.

Banding: ``BANDS`` bands of ``ROWS`` registers.  A pair at the threshold shares a band
with probability 1 - (1 - 0.8^4)^32 > 1 - 5e-8.

Work is done on distinct texts (128-bit digests): copies collapse in an aggregation and
are never compared.  Inside a band bucket not all pairs are emitted:

* *star*: every text of a bucket is verified against the bucket's most central text
  (the one with the smallest share of shingles that no other candidate has), which is
  linear in the bucket; verified links are joined into components;
* *rest*: in buckets that still hold several components, a pair of different components is
  found by what its texts do not share with the bucket's centre.  The edits of a text are
  the shingles it has beyond the centre's and those of the centre that it lacks.  The
  difference of two texts is the difference of their edits, so a text that is not linked to
  the centre can be linked to another one only if enough edits of the other one, about
  half of them, are its own, too (``open_texts``).  Texts with too many edits that nobody
  shares drop out; the others meet under their rarest shared edits, and are verified: first
  with one text of every edit, which is linear and joins most components, then in all pairs
  whose texts are still in different ones.

Both steps together lose no linked pair that shares a band: a pair is either verified,
or provably below the threshold, or inside one component already.  The number of edits
that texts share, not the size of a bucket, decides how many pairs are looked at.

NULL texts are no evidence: such a row is its own class and always stays.  Empty
texts are copies of one another; a text without a word is a duplicate only of its own
copies.  Repeated rows and rows with a repeated or NULL doc_id are rows like others.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import (WordHash, map_rows, mix64, shingle_hashes, text_digest,
                                   whole_row)
from ledgerlake.llm.components import components
from ledgerlake.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 4
#: Shingles that one signing batch holds at most (a longer document is a batch of its own).
BATCH = 200_000
_WORD = re.compile(r"\w+")


# --- multisets -------------------------------------------------------------------------

def multiset(text: str, words: WordHash, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (sorted) and their counts."""
    h = np.fromiter(map(words.__getitem__, _WORD.findall(text.lower())), np.uint64)
    return np.unique(shingle_hashes(h, k), return_counts=True)


def unfolded(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A plain set with the multiset's Jaccard similarity: one hash per (shingle, i-th copy)."""
    if counts.size and counts.max() > 1:
        first = np.repeat(np.cumsum(counts) - counts, counts)
        nth = (np.arange(len(first)) - first).astype(np.uint64)
        return mix64(np.repeat(shingles, counts) ^ mix64(nth))
    return mix64(shingles ^ mix64(np.zeros(1, dtype=np.uint64)))


def similarity(a: str, b: str, k: int = SHINGLE) -> float:
    """Exact weighted Jaccard similarity of two texts (0 when neither has a word)."""
    words = WordHash()
    x, y = unfolded(*multiset(a, words, k)), unfolded(*multiset(b, words, k))
    both = len(np.intersect1d(x, y))
    return both / max(len(x) + len(y) - both, 1)


# --- BagMinHash ------------------------------------------------------------------------

def bag_signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """Signatures (documents, m) of several multisets at once; every bag must be non-empty."""
    doc, key, rate, low, weight = [], [], [], [], []
    for d, (shingles, counts) in enumerate(bags):
        left, k = np.arange(len(shingles)), 0
        while len(left):  # interval k is [2^(k-1), 2^k), interval 0 is [0, 1)
            lo = 0 if k == 0 else 1 << (k - 1)
            left = left[counts[left] > lo]
            doc.append(np.full(len(left), d))
            key.append(mix64(shingles[left] ^ mix64(np.full(1, 1000 + k, dtype=np.uint64))))
            rate.append(np.full(len(left), max(lo, 1)))
            low.append(np.full(len(left), lo))
            weight.append(counts[left])
            k += 1
    doc, key, rate, low, weight = map(np.concatenate, (doc, key, rate, low, weight))
    n_docs = len(bags)
    best = np.full(n_docs * m, np.inf)
    sign = np.zeros(n_docs * m, dtype=np.uint64)
    time = np.zeros(len(doc))
    point = 0
    while len(doc):
        h = mix64(key ^ mix64(np.full(1, point, dtype=np.uint64)))
        time = time - np.log1p(-(h >> np.uint64(11)).astype(np.float64) / 2.0 ** 53) / rate
        g = mix64(h)
        reg = doc * m + (g % np.uint64(m)).astype(np.int64)
        place = low + ((g >> np.uint64(24)).astype(np.float64) / 2.0 ** 40 * rate).astype(np.int64)
        hit = np.flatnonzero((time < best[reg]) & (place < weight))
        if len(hit):
            hit = hit[np.lexsort((h[hit], time[hit]))][::-1]  # the earliest is written last
            best[reg[hit]], sign[reg[hit]] = time[hit], h[hit]
        on = time < best.reshape(n_docs, m).max(axis=1)[doc]
        doc, key, rate, low, weight, time = (x[on] for x in (doc, key, rate, low, weight, time))
        point += 1
    return sign.reshape(n_docs, m)


def band_keys(signs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) keys as signed 64-bit integers."""
    h = np.zeros((len(signs), bands), dtype=np.uint64)
    s = signs.reshape(len(signs), bands, rows)
    for i in range(rows):
        h = mix64(h ^ s[:, :, i])
    return mix64(h ^ mix64(np.arange(bands, dtype=np.uint64))).view(np.int64)


def sign_texts(rows: Iterable[tuple], bands: int, per_band: int) -> Iterator[tuple]:
    """(digest, text) to (digest, band keys); texts without a word yield nothing."""
    words = WordHash()

    def flush(part: list[tuple]) -> Iterator[tuple]:
        keys = band_keys(bag_signatures([b for _, b in part], bands * per_band), bands, per_band)
        for (d, _), k in zip(part, keys):
            yield d, k.tolist()

    part, size = [], 0
    for digest, text in rows:
        bag = multiset(text, words)
        if not len(bag[0]):
            continue
        part.append((digest, bag))
        size += len(bag[0]) + bands * per_band
        if size >= BATCH:
            yield from flush(part)
            part, size = [], 0
    if part:
        yield from flush(part)


# --- Spark -----------------------------------------------------------------------------

def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of digests whose exact similarity reaches the threshold."""
    x = pairs.join(sets.select(F.col("digest").alias("a"), F.col("items").alias("x")), "a")
    x = x.join(sets.select(F.col("digest").alias("b"), F.col("items").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    return (x.withColumn("both", both)
            .filter(F.col("both") >= F.lit(threshold) * (F.size("x") + F.size("y") - F.col("both")))
            .select("a", "b"))


def links(documents: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS,
          rows: int = ROWS) -> DataFrame:
    """Edges (a, b) of digests that span the classes."""
    texts = documents.filter(F.col("text").isNotNull()).select(
        text_digest(F.col("text")).alias("digest"), "text")
    signed = map_rows(texts, lambda r: sign_texts(r, bands, rows),
                      "digest binary, bands array<long>")
    # Copies have the same keys: they collapse before the buckets are formed.
    buckets = signed.select("digest", F.explode("bands").alias("band")).distinct()
    buckets = materialize(buckets, "near-buckets")
    shared = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialize(buckets.join(shared, "band"), "near-shared")
    candidates = members.select("digest").distinct()

    def sets_of(rs: Iterable[tuple]) -> Iterator[tuple]:
        words = WordHash()
        for digest, text in rs:
            yield (digest, int.from_bytes(digest[:8], "big", signed=True),
                   int.from_bytes(digest[8:], "big", signed=True),
                   unfolded(*multiset(text, words)).view(np.int64).tolist())

    one = texts.join(candidates, "digest", "left_semi").dropDuplicates(["digest"])
    sets = materialize(map_rows(one, sets_of, "digest binary, hi long, lo long, items array<long>"),
                       "near-sets")
    # A bucket of two is settled by one comparison.  In larger ones, shingles that only
    # one of their texts holds can be shared with none of the others.
    large = members.filter("size > 2").select("digest").distinct()
    crowd = sets.join(large, "digest", "left_semi")
    lone = (crowd.select("hi", "lo", F.explode("items").alias("item"))
            .groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("hi").alias("hi"),
                                 F.min("lo").alias("lo"))
            .filter("n = 1").groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("u")))
    sizes = (sets.select("digest", "hi", "lo", F.size("items").cast("long").alias("n"))
             .join(lone, ["hi", "lo"], "left")
             .select("digest", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("common")))
    # In a large bucket, a text that shares too little with all others has no link at all.
    members = materialize(members.join(sizes, "digest").filter(
        (F.col("size") == 2) | (F.col("common") >= threshold * F.col("n"))), "near-members")
    rank = F.struct((-F.col("common") / F.col("n")).alias("r"), F.col("digest").alias("d"))
    centre = members.groupBy("band").agg(F.min(rank).alias("c")).select(
        "band", F.col("c.d").alias("b"))
    star = (members.join(centre, "band").filter("digest != b")
            .select(F.col("digest").alias("a"), "b").distinct())
    found = materialize(verified(star, sets, threshold), "near-star")
    label = materialize(components(found).select(F.col("node").alias("digest"), "label"),
                        "near-labels")
    # The rest: buckets that still hold several components.
    placed = (members.filter("size > 2").join(label, "digest", "left")
              .select("band", "digest", F.coalesce("label", "digest").alias("label"),
                      (F.col("n") - F.col("common")).alias("lone")))
    mixed = (placed.groupBy("band").agg(F.min("label").alias("l0"), F.max("label").alias("l1"))
             .filter("l0 != l1").select("band"))
    # Centres of one component are stood for by the most central of them.
    chosen = (members.groupBy("band").agg(F.min(rank).alias("c"))
              .join(label.withColumnRenamed("digest", "d"), F.col("c.d") == F.col("d"), "left")
              .select("band", "c", F.coalesce("label", "c.d").alias("of")))
    most = chosen.groupBy("of").agg(F.min("c").alias("m")).select("of", F.col("m.d").alias("centre"))
    held = materialize(placed.join(mixed, "band").join(chosen, "band").join(most, "of")
                       .select("band", "centre", "digest", "label", "lone"), "near-mixed")
    rest = (fewest_centres(held).filter(F.col("digest") != F.col("centre"))
            .select("centre", "digest", "label", "lone").distinct())
    near, meet = open_texts(rest, sets, threshold)
    known = label.select(F.col("digest").alias("a"), F.col("label").alias("b")).unionByName(near)
    # First one text of every shared edit against the others: linear, and it joins most
    # components.  Then all pairs whose texts are still in different ones.
    first = verified(meetings(meet, first_holders(meet), threshold), sets, threshold)
    known = materialize(known.unionByName(first), "near-first")
    now = materialize(components(known).select(F.col("node").alias("digest"),
                                               F.col("label").alias("now")), "near-now")
    still = (meet.join(now, "digest", "left").withColumn("label", F.coalesce("now", "label"))
             .drop("now"))
    still = materialize(still, "near-still")
    return known.unionByName(verified(meetings(still, still, threshold), sets, threshold))


def fewest_centres(held: DataFrame) -> DataFrame:
    """``held`` (band, centre, digest, ...) with one centre for buckets of much the same texts.

    Any text can be the centre of any bucket, as long as a bucket has one.  A bucket takes,
    of the centres that half of its texts are compared with anyway, the one with the most
    texts; so texts that meet in many bands are not compared with a new centre in each.
    """
    meets = held.select("centre", "digest").distinct()
    texts = meets.groupBy("centre").agg(F.count(F.lit(1)).alias("texts"))
    size = held.groupBy("band").agg(F.count(F.lit(1)).alias("size"))
    cover = (held.select("band", "digest").join(meets, "digest")
             .groupBy("band", "centre").agg(F.count(F.lit(1)).alias("both")))
    best = (cover.join(size, "band").filter("2 * both >= size").join(texts, "centre")
            .groupBy("band").agg(F.max(F.struct("texts", "centre")).alias("best"))
            .select("band", F.col("best.centre").alias("centre")))
    return held.drop("centre").join(best, "band")


def open_texts(rest: DataFrame, sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) with centres, and the texts by the shared edits under which they may meet.

    ``rest``: centre, digest, label of the texts of mixed buckets, and how many shingles of
    each no other text has.  Let n be the sizes of
    texts u, v and the centre c, h their numbers of edits, and r = (1 - t) / (1 + t) for the
    threshold t.  u and v are linked if the difference of their edits is at most
    r * (n_u + n_v), and u is not linked to c if h_u > r * (n_u + n_c); so a link of such a
    u with v needs more than (h_v + r * (n_c - n_v)) / 2 shared edits.  Two texts that are
    both linked to c are in one component by that.  An edit that only one text of
    the centre has is shared with none; of v's other edits, all but this number, the rarest
    first, must hold one that u has.
    """
    r = (1 - threshold) / (1 + threshold)
    x = sets.select("digest", F.col("items").alias("x"))
    c = sets.select(F.col("digest").alias("centre"), F.col("items").alias("c"))
    extra, lacks = F.array_except("x", "c"), F.array_except("c", "x")
    edits = lambda items, more: F.transform(items, lambda i: F.struct(
        F.lit(more).alias("more"), i.alias("item")))
    both = (F.col("n") + F.col("m") - F.col("h")) / 2
    least = F.greatest(F.lit(1), F.floor((F.col("h") + F.lit(r) * (F.col("m") - F.col("n"))) / 2
                                         - 1e-6) + 1).cast("int")
    texts = materialize(
        rest.join(c, "centre").join(x, "digest")
        .select("centre", "digest", "label", "lone", F.size("x").alias("n"), F.size("c").alias("m"),
                F.concat(edits(extra, True), edits(lacks, False)).alias("e"))
        .withColumn("h", F.size("e"))
        .withColumn("apart", both < F.lit(threshold) * (F.col("n") + F.col("m") - both))
        .withColumn("able", F.col("h") - F.col("lone") >= least), "near-edits")
    near = texts.filter("NOT apart").select(F.col("digest").alias("a"), F.col("centre").alias("b"))
    # Two texts apart from the centre must both be able to share enough; others are needed
    # only if a text that is linked to the centre is.
    wide = texts.filter("able AND NOT apart").select("centre").distinct()
    needed = texts.filter("able").unionByName(
        texts.filter("apart AND NOT able").join(wide, "centre", "left_semi"))
    tokens = needed.select("centre", "digest", "label", "n", "m", "h", "apart",
                           F.explode("e").alias("e"))
    holders = F.count(F.lit(1)).over(Window.partitionBy("centre", "e"))
    shared = tokens.withColumn("texts", holders).filter("texts > 1")
    # Edits in one order, the rarest first; two texts that share o of them meet first at a
    # place that leaves o - 1 in both, so only the first places need to be joined.
    # ``few``: the edits that any link needs of a text that is apart.
    few = F.greatest(F.lit(1), F.floor((F.col("h") - F.lit(r) * (F.col("m") + F.col("n"))) / 2
                                       - 1e-6) + 1).cast("int")
    placed = materialize(shared.groupBy("centre", "digest", "label", "n", "m", "h", "apart")
              .agg(F.array_sort(F.collect_list(F.struct("texts", "e"))).alias("s"))
              .withColumn("size", F.size("s")).withColumn("last", F.col("size") - least + 1)
              .withColumn("upto", F.when(F.col("apart"), F.greatest(
                  F.col("last"), F.col("size") - few + 1)).otherwise(F.col("last")))
              .filter("upto > 0")
              .select("centre", "digest", "label", "n", "h", "apart", "size", "last",
                      F.posexplode(F.slice("s", 1, F.col("upto"))).alias("at", "s"))
              .select("centre", F.col("s.e").alias("e"), "digest", "label", "n", "h", "apart",
                      "size", "last", "at"), "near-shared-edits")
    return near, placed


def open_pairs(rest: DataFrame, sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) with centres, and pairs (a, b) that may reach the threshold, in one pass."""
    near, meet = open_texts(rest, sets, threshold)
    return near, meetings(meet, meet, threshold)


def first_holders(meet: DataFrame) -> DataFrame:
    """One text of every (centre, edit): the closest to the centre that can be met there."""
    rest = [c for c in meet.columns if c not in ("centre", "e", "h", "digest")]
    best = F.min(F.struct("apart", "h", "digest", *[c for c in rest if c != "apart"]))
    return (meet.filter("at < last").groupBy("centre", "e").agg(best.alias("b"))
            .select("centre", "e", "b.*"))


def meetings(us: DataFrame, vs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of different components that meet under an edit and may be linked."""
    r = (1 - threshold) / (1 + threshold)
    u, v = us.filter("apart").alias("u"), vs.filter("at < last").alias("v")
    left = F.least(F.col("u.size") - F.col("u.at"), F.col("v.size") - F.col("v.at"))
    wanted = (F.col("u.h") + F.col("v.h") - F.lit(r) * (F.col("u.n") + F.col("v.n"))) / 2 - 1e-6
    pairs = u.join(v, (F.col("u.centre") == F.col("v.centre")) & (F.col("u.e") == F.col("v.e"))
                   & (F.col("u.label") != F.col("v.label"))
                   & (~F.col("v.apart") | ((F.col("u.digest") < F.col("v.digest"))
                                           & (F.col("u.at") < F.col("u.last"))))
                   & (left >= wanted)
                   & (F.least("u.n", "v.n") >= threshold * F.greatest("u.n", "v.n"))).select(
        F.col("u.digest").alias("a"), F.col("v.digest").alias("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """digest, class (a digest): the class of every distinct text that has a link."""
    return components(materialize(links(documents, threshold), "near-links")).select(
        F.col("node").alias("digest"), F.col("label").alias("class"))


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: doc_id, class_id (its smallest doc_id), class_texts, kept.

    ``kept`` marks the rows whose doc_id is the class's smallest; among rows that share
    it, those with the smallest digest.
    """
    docs = documents.select("doc_id", text_digest(F.col("text")).alias("digest"))
    ids = docs.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("digest IS NOT NULL")
    linked = classes(documents, threshold)
    per_text = (ids.join(linked, "digest", "left")
                .withColumn("class", F.coalesce("class", "digest")))
    first = (per_text.groupBy("class")
             .agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_texts"),
                  F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("best"))
             .select("class", "class_id", "class_texts", F.col("best.digest").alias("best")))
    text_class = (per_text.join(first, "class")
                  .select(F.col("digest").alias("k"), "class_id", "class_texts", "best"))
    out = docs.join(text_class, docs["digest"] == text_class["k"], "left")
    return out.select(
        "doc_id", F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
        .alias("class_id"),
        F.coalesce("class_texts", F.lit(1)).cast("long").alias("class_texts"),
        (F.col("k").isNull() | ((F.col("digest") == F.col("best"))
                                & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("kept"))


def keep_one(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents (all their columns) with one row of each class; NULL texts all stay."""
    docs = documents.select(whole_row(documents).alias("row"), F.col("doc_id").alias("id"),
                            text_digest(F.col("text")).alias("digest"))
    texts = (documents.select("doc_id", text_digest(F.col("text")).alias("digest"))
             .filter("digest IS NOT NULL").groupBy("digest")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("d")))
    best = (texts.join(classes(documents, threshold), "digest", "left")
            .groupBy(F.coalesce("class", "digest").alias("class"))
            .agg(F.min(F.struct("d", "digest")).alias("best"))
            .select(F.col("best.d.doc_id").alias("best_id"),
                    F.col("best.digest").alias("best_digest")))
    stay = docs.join(best, docs["id"].eqNullSafe(best["best_id"])
                     & (docs["digest"] == best["best_digest"]), "left_semi")
    return (stay.dropDuplicates(["id", "digest"]).select("row")
            .unionByName(docs.filter("digest IS NULL").select("row")).select("row.*"))
