"""Benchmark decontamination with SimHash over item-sized windows (DataFrame functions only).

1. Windows.  An item of n words is compared with every document window of n words, at
   whatever word it starts.  Both have m = n - SHINGLE + 1 shingles, so a window with a
   similarity of t holds at least 2 t m / (1 + t) places (8/9 of m for 0.8) with a shingle
   of its item.  Document shingles meet the item shingles in a join, and only windows with
   fewer such places are left out; this bound is exact, so no window at the threshold is
   lost, in whatever order the item's parts stand.  The item side is broadcast only if a
   count shows ``BROADCAST_SHINGLES`` rows at most, beyond that Spark shuffles both sides.
2. Fingerprints.  64-bit SimHash of a window's words, each weighted by its count.
3. Multi-index.  Fingerprints are cut into 8 blocks of 8 bits.  Two fingerprints within
   ``RADIUS`` = 23 bits have a block within 23 // 8 = 2 bits; every item is stored under
   all 37 such block values, so the block join finds all windows within the radius.
   Windows at the similarity threshold differ by about 9 bits, 23 is 5 standard deviations
   more.
4. Verification.  Weighted Jaccard similarity of the multisets of ``SHINGLE``-word
   shingles, each shingle with the weight of its count, ``THRESHOLD`` or more.

Words are ``[\\p{L}\\p{N}]+`` of the lower-cased text.  Items of fewer than SHINGLE words
(also NULL and empty ones) have no shingle and match nothing.  NULL and empty documents
are clean.  Rows with equal doc_id and text, and NULL doc_ids, are handled like others.

``contaminated``, ``item_ids`` and ``similarity`` follow from all matching windows.
``n_windows`` counts those that start where a shared shingle puts the start of an item
(``placed``), as the SQL statement does; it is 0 if only others match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import text_digest, whole_row
from ledgerlake.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
BLOCKS, BLOCK_BITS, RADIUS = 8, 8, 23
#: Item shingles up to which their table is broadcast (about 50 MB).
BROADCAST_SHINGLES = 1_000_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def shingles_of(words: Column) -> Column:
    """64-bit hashes of the SHINGLE-word shingles, in order; none for fewer words."""
    last = F.size(words) - SHINGLE
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)])))


def simhash(words: Column) -> Column:
    """64-bit SimHash of a word array; a bit is set if most words' hashes have it."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def ones(bit: Column) -> Column:
        return F.aggregate(hashes, F.lit(0), lambda n, h: n + (
            F.call_function("shiftrightunsigned", h, bit).bitwiseAND(1)).cast("int"))

    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.when(
        ones(b) * 2 > F.size(words), F.call_function("shiftleft", F.lit(1).cast("bigint"), b))
        .otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda f, b: f.bitwiseOR(b))


def blocks_of(fingerprint: Column) -> Column:
    return F.array(*[F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(
        fingerprint, b * BLOCK_BITS).bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("value"))
        for b in range(BLOCKS)])


def near_blocks(radius: int = RADIUS) -> list[int]:
    """Bit patterns that differ from 0 in at most radius // BLOCKS places."""
    return [x for x in range(1 << BLOCK_BITS) if x.bit_count() <= radius // BLOCKS]


def overlap(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays taken as multisets."""
    def times(xs: Column, s: Column) -> Column:
        return F.size(F.filter(xs, lambda x: x == s))

    both = F.aggregate(F.array_distinct(a), F.lit(0),
                       lambda n, s: n + F.least(times(a, s), times(b, s)))
    return both / (F.size(a) + F.size(b) - both)


def items_of(benchmark: DataFrame) -> DataFrame:
    """One row per distinct word sequence: words, n, shingles, item_ids."""
    return (benchmark.select("item_id", words_of(F.col("text")).alias("words"))
            .groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
            .withColumn("n", F.size("words")).filter(F.col("n") >= SHINGLE)
            .withColumn("shingles", shingles_of(F.col("words")))
            .withColumn("item", F.xxhash64(F.to_json("words"))))


def starts_of(places: Column, n: Column, size: Column, threshold: float) -> Column:
    """Starts of all windows of n words with enough of the sorted ``places``.

    Places j to j + need - 1 lie together in the windows that start at ``low`` to ``high``.
    """
    m = n - (SHINGLE - 1)
    need = F.greatest(F.lit(1), F.ceil(m * (2 * threshold / (1 + threshold)) - 1e-9).cast("int"))
    last = F.size(places) - need

    def run(j: Column) -> Column:
        low = F.greatest(F.lit(0), F.get(places, j + need - 1) - m + 1)
        high = F.least(F.get(places, j), size - n)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.when(last < 0, F.array().cast("array<int>")).otherwise(
        F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), last), run))))


def windows_of(docs: DataFrame, seeds: DataFrame, small: bool, threshold: float) -> DataFrame:
    """id, digest, start, n, placed, words of every window that can reach the threshold.

    ``docs`` has id, digest and text.  Shingles are met without the words; the texts of
    documents with a window are read again.
    """
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("size") - F.col("n")))
    words = docs.select("id", "digest", words_of(F.col("text")).alias("words"))
    hits = (words.select("id", "digest", F.size("words").alias("size"),
                         F.posexplode(shingles_of(F.col("words"))).alias("pos", "shingle"))
            .join(F.broadcast(seeds) if small else seeds, "shingle").filter("n <= size")
            .withColumn("start", start))
    # Places of one document: bounded by its text and the item sizes, not by the corpus.
    wanted = (hits.groupBy("id", "digest", "size", "n")
              .agg(F.array_sort(F.collect_set("pos")).alias("places"),
                   F.collect_set("start").alias("seeded"))
              .withColumn("starts", starts_of(F.col("places"), F.col("n"), F.col("size"), threshold))
              .filter(F.size("starts") > 0)
              .select("id", "digest", "n", *[f("starts", "seeded").alias(c) for c, f in (
                  ("placed", F.array_intersect), ("others", F.array_except))]))
    wanted = materialize(wanted, "bench-windows").groupBy("id", "digest").agg(
        F.collect_list(F.struct("n", "placed", "others")).alias("windows"))
    w = wanted.alias("w")

    def each(starts: Column, n: Column, placed: bool) -> Column:
        return F.transform(starts, lambda s: F.struct(
            s.alias("start"), n.alias("n"), F.lit(placed).alias("placed")))

    every = F.flatten(F.transform("windows", lambda x: F.concat(
        each(x["placed"], x["n"], True), each(x["others"], x["n"], False))))
    return (docs.alias("d").join(w, F.col("d.id").eqNullSafe(F.col("w.id"))
                                 & (F.col("d.digest") == F.col("w.digest")))
            .select("d.id", "d.digest", "d.text", "windows").dropDuplicates(["id", "digest"])
            .select("id", "digest", words_of(F.col("text")).alias("words"),
                    F.explode(every).alias("at"))
            .select("id", "digest", "at.start", "at.n", "at.placed",
                    F.slice("words", F.col("at.start") + 1, F.col("at.n")).alias("words")))


def matches(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
            radius: int = RADIUS, broadcast_shingles: int = BROADCAST_SHINGLES) -> DataFrame:
    """id, digest, start (word), n, placed, item_ids, similarity of every matching window."""
    items = materialize(items_of(benchmark), "bench-items")
    seeds = (items.select("n", F.posexplode("shingles").alias("at", "shingle"))
             .select("shingle", "at", "n").distinct())
    docs = (documents.filter(F.col("text").isNotNull())
            .select(F.col("doc_id").alias("id"), text_digest(F.col("text")).alias("digest"), "text"))
    cut = windows_of(docs, seeds, seeds.count() <= broadcast_shingles, threshold)
    # Equal windows need one look each; what follows works on distinct word sequences.
    cut = materialize(cut.withColumn("window", text_digest(F.to_json("words"))), "bench-cut")
    one = (cut.select("window", "n", "words").dropDuplicates(["window"])
           .withColumn("fp", simhash(F.col("words"))))
    index = (items.withColumn("fp", simhash(F.col("words")))
             .select("item", "n", F.col("fp").alias("item_fp"), F.explode(blocks_of(F.col("fp")))
                     .alias("x"))
             .select("item", "n", "item_fp", "x.block", F.explode(F.transform(
                 F.array(*[F.lit(v) for v in near_blocks(radius)]),
                 lambda v: F.col("x.value").bitwiseXOR(v))).alias("value")))
    probe = (one.select("window", "n", "fp", F.explode(blocks_of(F.col("fp"))).alias("x"))
             .select("window", "n", "fp", "x.block", "x.value"))
    near = (probe.join(index, ["n", "block", "value"])
            .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
            .select("window", "item").distinct())
    same = (near.join(one.select("window", "words"), "window")
            .join(items.select("item", "item_ids", F.col("shingles").alias("wanted")), "item")
            .withColumn("similarity", overlap(F.col("wanted"), shingles_of(F.col("words"))))
            .filter(F.col("similarity") >= threshold)
            .select("window", "item_ids", "similarity"))
    return (cut.select("id", "digest", "start", "n", "placed", "window").join(same, "window")
            .drop("window"))


def contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD
                 ) -> DataFrame:
    """id, digest, n_windows, item_ids, similarity (the largest) of each tainted document."""
    return (matches(documents, benchmark, threshold).groupBy("id", "digest")
            .agg(F.countDistinct(F.when(F.col("placed"), F.struct("start", "n"))).alias("n_windows"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids"))))
                 .alias("item_ids"),
                 F.max("similarity").alias("similarity")))


def judge(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, contaminated, n_windows, item_ids, similarity of every document row."""
    found = contaminated(documents, benchmark, threshold)
    d = documents.select("doc_id", text_digest(F.col("text")).alias("digest")).alias("d")
    f = found.alias("f")
    return (d.join(f, F.col("d.doc_id").eqNullSafe(F.col("f.id"))
                   & (F.col("d.digest") == F.col("f.digest")), "left")
            .select("d.doc_id", F.col("f.digest").isNotNull().alias("contaminated"),
                    F.coalesce("f.n_windows", F.lit(0)).cast("long").alias("n_windows"),
                    F.coalesce("f.item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
                    F.coalesce("f.similarity", F.lit(0.0)).alias("similarity")))


def keep_clean(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD
               ) -> DataFrame:
    """The documents (all their columns) without a matching window."""
    f = contaminated(documents, benchmark, threshold).select("id", "digest")
    d = documents.select(whole_row(documents).alias("row"), F.col("doc_id").alias("doc"),
                         text_digest(F.col("text")).alias("key"))
    return d.join(f, d["doc"].eqNullSafe(f["id"]) & (d["key"] == f["digest"]),
                  "left_anti").select("row.*")
