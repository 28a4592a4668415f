"""Merkle dataset manifest: digests go up and proofs come down by time-forward processing.

Every row of a table is a leaf: the sha256 of its fields.  The leaves of a language, in order
of doc_id, form a binary tree (a node without a neighbour goes up alone); the roots of
the languages, in order of language, form the tree on top.

Time-forward processing sends a digest to where it is needed as a message under the label
of the node that needs it, and takes messages from a priority queue in label order, so
nodes are evaluated without looking anything up.  A node's label is (last leaf under it,
level): children come before parents, and a parent follows its last child at once.
The queue has two parts.  Inside a block of ``1 << BITS`` neighbouring nodes it is a heap.
Between blocks it is a shuffle that sorts by label and spills to disk: the roots of
blocks are the messages, and the next round's blocks read them in order.  The reversed
sweep takes the labels in descending order and sends every child the proof of its parent
plus its sibling; block by block the proofs reach the leaves, which check them.

On Spark: texts are read once to make leaves of about 100 bytes, and those are sorted by
range once; places in a language are counts of the earlier sorted partitions plus the
place there, so a language with most of the rows is no task of its own.  A round works on
blocks of at most 256 nodes, and rounds shrink 256 times; their number follows from one
number, the size of the largest tree.  Nothing else reaches the driver.

Defined cases: NULL fields are ``-``; a NULL doc_id comes first and is never tampered with;
rows with equal doc_ids are ordered by leaf, so repeated rows are neighbours with equal
leaves; a NULL language is the first tree; a lone leaf is its subroot, its proof is empty;
empty and very long texts are hashed whole; an empty table gives no rows; other columns
are not part of a leaf.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows
from ledgerlake.session import materialize

#: The fields of a leaf, in order, and the divisor that picks tampered rows.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 7
#: A block has 1 << BITS neighbouring nodes at most.
BITS = 8

Node = tuple[int, int]  # level, index


# --- one tree, a block at a time -----------------------------------------------------------

def join_digests(parts: Iterable[bytes]) -> bytes:
    """H of digests as hex text."""
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def label(node: Node, n: int) -> tuple[int, int]:
    """(last base node under it, level) of a node over ``n`` base nodes."""
    level, i = node
    return min(n, (i + 1) << level) - 1, level


def height(n: int, bits: int) -> int:
    """Levels that a block climbs: to the root of a tree of ``n``, or the block's limit."""
    return min((max(n, 1) - 1).bit_length(), bits)


def climb(nodes: Iterable[tuple[int, bytes]], n: int, up: int
          ) -> Iterator[tuple[Node, list[tuple[int, bytes]]]]:
    """(node, its children (index, digest)) in label order, from one block's base nodes.

    ``nodes`` (index, digest) come in ascending order; the last pair yielded at level
    ``up`` is the block's root.  The heap holds the messages to nodes still waiting.
    """
    heap: list[tuple[tuple[int, int], Node, int, bytes]] = []

    def send(level: int, i: int, digest: bytes) -> None:
        if level < up:
            to = (level + 1, i >> 1)
            heapq.heappush(heap, (label(to, n), to, i, digest))

    for i, digest in nodes:
        send(0, i, digest)
        while heap and heap[0][0][0] <= i:
            to = heap[0][1]
            children = []
            while heap and heap[0][1] == to:
                _, _, j, d = heapq.heappop(heap)
                children.append((j, d))
            yield to, children
            send(to[0], to[1], join_digests(d for _, d in children))


def block_root(nodes: Sequence[tuple[int, bytes]], n: int, up: int) -> bytes:
    """The digest that a block hands to the next round."""
    root = nodes[0][1]
    for _, children in climb(nodes, n, up):
        root = join_digests(d for _, d in children)
    return root


#: A step of a proof: no sibling, or on which side it is.
ALONE, LEFT, RIGHT = b"\0", b"\1", b"\2"


def descend(nodes: Sequence[tuple[int, bytes]], n: int, up: int, proof: bytes
            ) -> Iterator[tuple[int, bytes]]:
    """(index, proof) of the base nodes of a block whose root has ``proof``.

    The reversed sweep: labels in descending order, each node hands its proof on.
    """
    if up == 0:
        yield nodes[0][0], proof
        return
    inner = list(climb(nodes, n, up))
    heap = [((0, 0), inner[-1][0], proof)]
    for node, children in reversed(inner):
        _, to, suffix = heapq.heappop(heap)
        assert to == node
        for k, (i, _) in enumerate(children):
            step = ALONE if len(children) == 1 else (
                RIGHT + children[1][1] if k == 0 else LEFT + children[0][1])
            if node[0] == 1:
                yield i, step + suffix
            else:
                last, level = label((node[0] - 1, i), n)
                heapq.heappush(heap, ((-last, -level), (node[0] - 1, i), step + suffix))


def siblings(proof: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(proof):
        if proof[at:at + 1] != ALONE:
            out.append(proof[at + 1:at + 33])
            at += 32
        at += 1
    return out


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and a proof lead to."""
    at = 0
    while at < len(proof):
        side, other = proof[at:at + 1], proof[at + 1:at + 33]
        if side == ALONE:
            leaf, at = join_digests([leaf]), at + 1
        else:
            leaf = join_digests([other, leaf] if side == LEFT else [leaf, other])
            at += 33
    return leaf


# --- leaves ----------------------------------------------------------------------------

def field(value: Column) -> Column:
    """``-`` if NULL, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(changed: dict[str, Column] | None = None) -> Column:
    """sha256 (32 bytes) of a row's fields."""
    columns = {f: F.col(f) for f in FIELDS} | (changed or {})
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns.values()]), 256))


def leaves(rows: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, tampered (NULL where nothing is changed), nth (any order)."""
    picked = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0)
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    other = leaf_digest({"n_chars": more})
    return rows.select(
        "doc_id", "lang", leaf_digest().alias("leaf"),
        F.when(picked & F.col("n_chars").isNotNull(), other).alias("tampered"),
        F.monotonically_increasing_id().alias("nth"))


def numbered(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` plus ``i`` (place in its group from 0) and ``n`` (the group's size).

    Sorted by range and written once; the place in a written partition is fixed with the
    row.  Rows of a group are counted per partition, and earlier partitions are added up.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    place = F.monotonically_increasing_id()
    rows = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                       .withColumn("place", place), name)
    rows = rows.withColumn("part", F.shiftright("place", 33)).withColumn(
        "key", F.struct(group))  # a struct is never NULL, so a NULL group joins like others
    per = rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("rows"),
                                          F.min("place").alias("first"))
    # One row per partition and group that it holds: bounded by partitions plus groups.
    whole = Window.partitionBy("key")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("part", "key", "first", F.sum("rows").over(whole).alias("n"),
                     F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return (rows.join(per, ["part", "key"])
            .select(*df.columns, (F.col("before") + F.col("place") - F.col("first")).alias("i"),
                    "n"))


# --- rounds ----------------------------------------------------------------------------

def _in_blocks(df: DataFrame, bits: int) -> DataFrame:
    """Rows of a block together and in order (``kind`` puts the block's proof first)."""
    block = F.shiftright("i", bits)
    return (df.withColumn("b", block).repartition("g", "b")
            .sortWithinPartitions(F.col("g").asc_nulls_first(), "b", "kind", "i"))


def climb_round(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """Nodes (g, i, n, digest) to the nodes that their blocks hand up."""
    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for (g, b), part in groupby(rows, key=lambda r: (r[0], r[1])):
            part = list(part)  # at most 1 << bits rows
            n = part[0][3]
            root = block_root([(i, d) for _, _, i, _, d in part], n, height(n, bits))
            yield g, b, (n + (1 << bits) - 1) >> bits, root

    rows = _in_blocks(nodes.withColumn("kind", F.lit(0)), bits).select("g", "b", "i", "n", "digest")
    kind = dict(nodes.dtypes)["g"]
    return map_rows(rows, run, f"g {kind}, i long, n long, digest binary")


def climb_all(nodes: DataFrame, name: str, bits: int = BITS) -> list[DataFrame]:
    """All rounds' nodes, the given ones first; the last has one node per tree."""
    most = nodes.agg(F.max("n")).first()[0] or 1  # the size of the largest tree
    rounds = [nodes]
    while most > 1:
        rounds.append(materialize(climb_round(rounds[-1].select("g", "i", "n", "digest"), bits),
                                  f"{name}-{len(rounds)}"))
        most = (most + (1 << bits) - 1) >> bits
    return rounds


def descend_round(nodes: DataFrame, proofs: DataFrame, bits: int = BITS,
                  finish: bool = False) -> DataFrame:
    """Proofs of blocks (g, i, proof, roots) become proofs of their nodes.

    ``finish``: nodes are leaves with doc_id and tampered, and proofs are checked.
    """
    own = ["doc_id", "tampered"] if finish else []
    none = F.lit(None)
    down = proofs.select("g", F.shiftleft("i", bits).alias("i"), F.lit(0).alias("kind"),
                         none.cast("long").alias("n"), none.cast("binary").alias("digest"),
                         "proof", "roots", *[none.cast(nodes.schema[c].dataType).alias(c)
                                             for c in own])
    up = nodes.select("g", "i", F.lit(1).alias("kind"), "n", "digest",
                      none.cast("binary").alias("proof"), none.cast("binary").alias("roots"), *own)

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for (g, b), part in groupby(rows, key=lambda r: (r[0], r[1])):
            head, *part = part  # the proof, then at most 1 << bits nodes
            proof, roots = head[6:8]
            n = part[0][4]
            found = dict(descend([(r[2], r[5]) for r in part], n, height(n, bits), proof))
            for r in part:
                mine = found[r[2]]
                if not finish:
                    yield g, r[2], mine, roots
                    continue
                subroot, root = roots[:32], roots[32:]
                folded = fold(r[5] if r[9] is None else r[9], mine)
                yield (r[8], r[5].hex(), subroot.hex(), root.hex(),
                       join_digests(siblings(mine)).hex(), folded.hex(), folded == root)

    cols = ["g", "b", "i", "kind", "n", "digest", "proof", "roots", *own]
    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
              "folded_root string, verified boolean") if finish else (
                  f"g {dict(nodes.dtypes)['g']}, i long, proof binary, roots binary")
    return map_rows(_in_blocks(up.unionByName(down), bits).select(*cols), run, schema)


def manifest(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    flat = rows.select(F.col("doc_id").cast("long").alias("doc_id"),
                       *[F.col(f) for f in FIELDS[1:]])
    made = materialize(leaves(flat), "merkle-leaves")
    base = numbered(made, "lang", ("doc_id", "leaf", "nth"), "merkle-order").select(
        F.col("lang").alias("g"), "i", "n", F.col("leaf").alias("digest"), "doc_id", "tampered")
    trees = climb_all(base, "merkle-up", bits)
    # The tree on top: one leaf per language.
    tops = trees[-1].select("g", "digest", F.lit(0).alias("all"))
    top = materialize(numbered(tops, "all", ("g",), "merkle-langs"), "merkle-top")
    rounds = climb_all(top.select(F.col("all").alias("g"), "i", "n", "digest"), "merkle-root", bits)
    proofs = rounds[-1].select("g", "i", F.lit(b"").alias("proof"), F.col("digest").alias("roots"))
    for nodes in reversed(rounds[:-1]):
        proofs = descend_round(nodes, proofs, bits)
    named = top.join(proofs.select("i", "proof", "roots"), "i")
    proofs = named.select("g", F.lit(0).cast("long").alias("i"), "proof",
                          F.concat("digest", "roots").alias("roots"))
    for nodes in reversed(trees[1:-1]):
        proofs = descend_round(nodes, proofs, bits)
    return descend_round(base, proofs, bits, finish=True)
