"""Sharding: longest-processing-time scheduling of groups with a heap (law ``bytes``).

Rows with equal texts form a group that stays together; its size is the sum of its
rows' sizes (UTF-8 bytes of the text plus 1).  Groups go, largest first, to the
least-loaded shard.

To schedule without bringing the groups to the driver, groups are counted by size class
(sizes below 4096 exactly, larger ones by their leading 12 bits, so within 0.05 %), and the
heap deals *numbers of groups of a class*.  Classes of more than ``SALT_GROUPS`` groups
are cut into salted parts.  The driver therefore sees at most 2048 classes per power of
two plus one part per SALT_GROUPS groups.  Inside a part, groups are numbered by digest
and take the shards in the order of the quotas.

Slots are numbered from 0 in every shard without a shard-wide sort: rows per (block,
shard) are counted, a block being at most BLOCK_ROWS rows of a written partition; prefix
sums give each block its first slot, and rows count on from there.

NULL texts count as empty ones (size 1, one group with them).  Repeated rows and NULL
doc_ids are rows like others.  Other columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import text_digest
from ledgerlake.session import materialize

SHARDS = 16
SALT_GROUPS = 100_000
BLOCK_ROWS = 50_000


def lpt_quotas(classes: list[tuple[float, int]], shards: int) -> list[list[int]]:
    """How many groups of each class every shard gets; classes (mean size, groups) by falling size.

    Equal to giving the groups one by one to the least-loaded shard: shards are first
    filled up to a common level, whole rounds follow, and the heap deals the rest.
    """
    loads = [0.0] * shards
    out = []
    for size, n in classes:
        quota = [0] * shards
        top = max(loads)
        gaps = [int((top - x) // size) for x in loads]
        if sum(gaps) <= n:  # all shards reach the level of the fullest, then whole rounds
            rounds = max(0, (n - sum(gaps)) // shards - 1)
            quota = [g + rounds for g in gaps]
        else:  # the groups do not reach it: the highest level they fill
            low, high = min(loads), top
            for _ in range(60):
                mid = (low + high) / 2
                if sum(int(max(mid - x, 0) // size) for x in loads) <= n:
                    low = mid
                else:
                    high = mid
            quota = [int(max(low - x, 0) // size) for x in loads]
        heap = [(x + q * size, i) for i, (x, q) in enumerate(zip(loads, quota))]
        heapq.heapify(heap)
        for _ in range(n - sum(quota)):
            load, i = heap[0]
            quota[i] += 1
            heapq.heapreplace(heap, (load + size, i))
        loads = [x + q * size for x, q in zip(loads, quota)]
        out.append(quota)
    return out


def assign(documents: DataFrame, shards: int = SHARDS, salt_groups: int = SALT_GROUPS
           ) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document row."""
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = materialize(documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text_digest(text).alias("digest")), "shard-rows")
    size_bits = F.length(F.bin("bytes"))
    drop = F.greatest(size_bits - 12, F.lit(0))
    groups = (rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
              .withColumn("class", F.call_function(
                  "shiftleft", F.call_function("shiftright", F.col("bytes"), drop), drop)))
    groups = materialize(groups, "shard-groups")
    parts = (groups.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("class").alias("c"),
                     F.ceil(F.col("n") / salt_groups).cast("int").alias("salts")))
    salted = groups.join(parts, groups["class"] == parts["c"]).select(
        "digest", "bytes", "class",
        F.pmod(F.xxhash64("digest"), F.col("salts")).cast("int").alias("salt"))
    hist = (salted.groupBy("class", "salt")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect())
    hist.sort(key=lambda r: (-r["bytes"] / r["n"], -r["class"], r["salt"]))
    quotas = lpt_quotas([(r["bytes"] / r["n"], r["n"]) for r in hist], shards)
    upto = []
    for r, quota in zip(hist, quotas):
        total, edges = 0, []
        for q in quota:
            total += q
            edges.append(total)
        upto.append((r["class"], r["salt"], edges))
    plan = spark.createDataFrame(upto, "class long, salt int, upto array<long>")
    rank = F.row_number().over(Window.partitionBy("class", "salt").orderBy("digest"))
    shard_of = (salted.withColumn("rank", rank).join(plan, ["class", "salt"])
                .select("digest", F.size(F.filter("upto", lambda x: x < F.col("rank")))
                        .alias("shard")))
    row = F.monotonically_increasing_id()
    # Rows are numbered in blocks of at most BLOCK_ROWS rows of one written partition.
    block = F.struct(F.spark_partition_id().alias("part"), F.expr(
        f"(monotonically_increasing_id() & {(1 << 33) - 1}) div {BLOCK_ROWS}").alias("nth"))
    placed = materialize(rows.join(shard_of, "digest").select(
        "doc_id", "size", "text_crc32", "shard", block.alias("block"), row.alias("row")),
        "shard-placed")
    counts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    first = counts.select(F.col("shard").alias("s"), F.col("block").alias("b"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    here = F.row_number().over(Window.partitionBy("block", "shard").orderBy("row"))
    return (placed.withColumn("here", here)
            .join(first, (F.col("shard") == F.col("s")) & (F.col("block") == F.col("b")))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                    F.col("shard").cast("int").alias("shard"),
                    (F.col("first") + F.col("here") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
