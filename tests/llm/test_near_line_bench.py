"""Near-dedup, line dedup and decontamination against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_brute import brute_classes, brute_leaks, every_block, jaccard

from ledgerlake.llm import decontaminate, line_dedup, near_dedup
from ledgerlake.llm.common import table
from ledgerlake.llm.components import components

SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(400)]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def docs(spark, rows, extra=True):
    """Documents with the given (doc_id, text) and columns that clash with inner names."""
    schema = "doc_id long, text string"
    if extra:
        schema += (", lines string, words int, digest string, n long, class string, id long"
                   ", row string, key string, _digest string")
        rows = [(*r, "x", 1, "d", 2, "c", 3, "r", "k", "_") for r in rows]
    return spark.createDataFrame(rows, schema)


def noisy(rng, words, edits):
    w = list(words)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.random()}"
    return " ".join(w)


def test_signature_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(1)
    s = np.unique(rng.integers(0, 1 << 63, 60, dtype=np.uint64))
    a = (s[:50], rng.integers(1, 40, 50))
    b = (s[10:60], np.concatenate([a[1][10:] // 2 + 1, rng.integers(1, 9, len(s) - 50)]))
    x, y = near_dedup.bag_signatures([a, b], 4096)
    ca, cb = Counter(dict(zip(*map(list, a)))), Counter(dict(zip(*map(list, b))))
    want = sum((ca & cb).values()) / sum((ca | cb).values())
    assert abs((x == y).mean() - want) < 0.03
    assert len(set(x.tolist())) > 100  # not one point for all registers


def test_near_dedup_whole_table(spark):
    d = table(spark, SF, "documents")
    rows = [(r[0], r[1]) for r in d.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(d).collect()}
    assert got == brute_classes(rows)


def test_near_dedup_crowd_and_chain(spark):
    rng = random.Random(3)
    base = rng.choices(WORDS, k=150)
    rows = [(i, noisy(rng, base, rng.choice([0, 1, 1, 2, 2, 3, 4, 8, 20]))) for i in range(120)]
    chain = rng.choices(WORDS, k=120)
    for i in range(12):  # each is near the one before, the ends are far apart
        rows.append((200 + i, " ".join(chain[4 * i:4 * i + 70])))
    got = near_dedup.near_duplicates(docs(spark, rows)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(rows)


def test_near_dedup_edges(spark):
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "..."), (6, "a b"), (7, "a b"), (7, "a b"),
            (None, "a b"), (8, "A b"), (9, "x " * 30000), (10, "x " * 30001), (None, None)]
    out = near_dedup.near_duplicates(docs(spark, rows))
    got = Counter((r["doc_id"], r["class_id"], r["kept"]) for r in out.collect())
    assert got == Counter({(1, 1, True): 1, (2, 2, True): 1, (3, 3, True): 1, (4, 3, False): 1,
                           (5, 5, True): 1, (6, 6, True): 1, (7, 6, False): 2, (None, 6, False): 1,
                           (8, 6, False): 1, (9, 9, True): 1, (10, 9, False): 1,
                           (None, None, True): 1})
    kept = near_dedup.keep_one(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, 5, 6, 9, None])
    empty = docs(spark, [])
    assert near_dedup.near_duplicates(empty).count() == near_dedup.keep_one(empty).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    rng.shuffle(edges)
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    want = {x: root(x) for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == want and len(got) == len(want)


# --- line dedup ------------------------------------------------------------------------

def test_line_dedup_whole_table(spark):
    d = table(spark, SF, "documents").select("doc_id", "text")
    rows = rows_of(d)
    got = line_dedup.dedup_lines(d).select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted(every_block(sorted(rows)))
    assert any(a != b for a, b in zip(sorted(rows), sorted(map(tuple, got))))


def test_line_dedup_keeps_every_long_line_somewhere(spark):
    rng = random.Random(2)
    pool = [" ".join(rng.choices(WORDS, k=rng.choice([1, 2, 6, 12]))) for _ in range(40)]
    rows = [(i, "\n".join(rng.choices([*pool, ""], k=rng.randrange(1, 14)))) for i in range(60)]
    got = [(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs(spark, rows)).collect()]
    assert sorted(got) == sorted(every_block(sorted(rows)))
    before = {x for _, t in rows for x in t.split("\n") if x.split()}
    assert before == {x for _, t in got for x in t.split("\n") if x.split()}


def near_copies(seed, n=70):
    """Copies of a text with some words replaced, often by the same words at the same places,
    so that many lie around the threshold of each other and of the first one."""
    rng = random.Random(seed)
    base = rng.choices(WORDS, k=120)
    edits = [(rng.randrange(120), rng.choice(WORDS)) for _ in range(14)]
    out = [(0, " ".join(base))]
    for i in range(1, n):
        w = list(base)
        for _ in range(rng.randrange(1, 8)):
            k, x = rng.choice(edits) if rng.random() < 0.7 else (rng.randrange(120), f"u{i}")
            w[k] = x
        out.append((i, " ".join(w)))
    return out


def test_texts_meet_one_holder_of_an_edit_first(spark):
    """40 texts apart from a centre and 40 linked to it share edits: no 1,600 pairs."""
    meet = spark.sql("""SELECT unhex('00') AS centre, named_struct('more', true, 'item', e) AS e,
        encode(cast(id AS string), 'utf-8') AS digest, unhex(if(id < 40, '01', '02')) AS label, 100 AS n,
        if(id < 40, 23, 3) AS h, id < 40 AS apart, 3 AS size, 3 AS last, cast(e AS int) AS at
        FROM (SELECT cast(id AS int) AS id FROM range(80)) JOIN range(2) AS t(e)""")
    assert near_dedup.meetings(meet, meet, 0.8).count() == 1600
    pairs = near_dedup.meetings(meet, near_dedup.first_holders(meet), 0.8).collect()
    assert len(pairs) == 40 and all(b"40" in tuple(r) for r in pairs)
    joined = meet.withColumn("label", F.unhex(F.lit("01")))  # after these links
    assert near_dedup.meetings(joined, joined, 0.8).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_open_pairs_hold_every_link_of_different_components(spark, seed):
    from itertools import combinations
    from ledgerlake.llm.near_dedup import multiset, open_pairs, unfolded
    from ledgerlake.llm.common import WordHash
    rows, words = near_copies(seed), WordHash()
    sets = [(bytes([i]), unfolded(*multiset(t, words)).view("int64").tolist()) for i, t in rows]
    holders = Counter(x for _, items in sets for x in items)
    rest = [(sets[0][0], d, d, sum(holders[x] == 1 for x in items)) for d, items in sets[1:]]
    near, pairs = open_pairs(
        spark.createDataFrame(rest, "centre binary, digest binary, label binary, lone int"),
        spark.createDataFrame(sets, "digest binary, items array<long>"), 0.8)
    linked = {(a, b) for (a, x), (b, y) in combinations(rows, 2) if jaccard(x, y) >= 0.8}
    centre = {bytes(r["a"])[0] for r in near.collect()}
    assert centre == {b for a, b in linked if a == 0}
    got = {(bytes(r["a"])[0], bytes(r["b"])[0]) for r in pairs.collect()}
    missing = {(a, b) for a, b in linked if a and not (a in centre and b in centre)} - got
    assert not missing and any(a and not (a in centre and b in centre) for a, b in linked)
    assert len(got) < 0.8 * len(rows) ** 2 / 2


def test_near_copies_around_the_threshold(spark):
    rows = [(1000 * s + i, t) for s in range(4) for i, t in near_copies(s, 40)]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_line_dedup_edges(spark):
    long = "one two three four five six"
    rows = [(1, f"{long}\nand\n\nseven eight nine ten eleven"), (2, f"x\n{long}\nand"), (3, None),
            (4, ""), (5, "and"), (2, f"x\n{long}\nand"), (None, "only here are five words")]
    d = docs(spark, rows)
    out = line_dedup.dedup_lines(d)
    assert out.columns == [*d.columns, "n_lines", "deleted_lines", "deleted_from"]
    got = Counter((r["doc_id"], r["text"], r["n_lines"], tuple(r["deleted_lines"]),
                   tuple(r["deleted_from"])) for r in out.collect())
    assert got == Counter({(1, rows[0][1], 4, (), ()): 1, (2, "x", 3, (1, 2), (1,)): 2,
                           (3, None, 0, (), ()): 1, (4, "", 1, (), ()): 1, (5, "and", 1, (), ()): 1,
                           (None, rows[-1][1], 1, (), ()): 1})
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def deduped(spark, rows):
    return sorted((r["doc_id"], r["text"])
                  for r in line_dedup.dedup_lines(docs(spark, rows)).collect())


def test_line_dedup_crossed_and_repeated_blocks(spark):
    p = [f"p{i} is a line of the passage" for i in range(10)]
    q = [f"q{i} is a line of the other" for i in range(20)]
    rows = [(1, p + q), (2, q + p), (3, ["new"] + p + ["x"] + p), (4, [q[0], "mid", q[0]]),
            (5, [q[0], "between", q[1], "end"])]
    rows = [(d, "\n".join(t)) for d, t in rows]
    got = deduped(spark, rows)
    assert got == every_block(rows)
    assert dict(got)[2] == "" and dict(got)[3] == "new\nx"


def test_line_dedup_short_lines_and_other_holders(spark):
    verse = [f"a{i} b{i} c{i} d{i}" for i in range(15)]
    long = "one two three four five six"
    rows = [(1, verse), (2, ["top", *verse, "", "tail"]), (3, verse[4:5]), (4, [long]),
            (5, ["x", long, "", "y"]), (6, ["x", "z"]), (7, ["new", "x", long, "y", "z"])]
    rows = [(d, "\n".join(t)) for d, t in rows]
    got = deduped(spark, rows)
    assert got == every_block(rows)
    assert dict(got)[2] == "top\n\ntail" and dict(got)[7] == "new\nz"
    rng = random.Random(21)
    pool = [" ".join(rng.choices(WORDS, k=rng.choice([1, 1, 2, 3, 4, 6]))) for _ in range(9)]
    rows = [(i, "\n".join(rng.choices([*pool, ""], k=rng.randrange(1, 12)))) for i in range(60)]
    assert deduped(spark, rows) == every_block(rows)


def test_patience_is_a_common_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    same = list(range(50)) + [1, 2, 3]
    assert line_dedup.patience(same, same) == [(i, i) for i in range(53)]


# --- decontamination -------------------------------------------------------------------

def test_decontaminate_whole_table(spark):
    d, b = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = brute_leaks(rows_of(d.select("doc_id", "text")), rows_of(b.select("item_id", "text")))
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.judge(d, b).collect()}
    assert got == want and any(want.values()) and not all(want.values())


def test_decontaminate_edges(spark):
    rng = random.Random(8)
    item = rng.choices(WORDS, k=40)
    b = spark.createDataFrame(
        [(1, " ".join(item), "x"), (2, None, "x"), (3, "", "x"), (4, "too short", "x"),
         (5, " ".join(item).upper(), "x"), (None, " ".join(rng.choices(WORDS, k=9)), "x")],
        "item_id long, text string, digest string")
    noise = rng.choices(WORDS, k=3000)
    rows = [(1, " ".join(noise + item + noise)), (2, " ".join(item[:20])), (3, None), (4, ""),
            (5, " ".join(item[3:] + ["z"])), (6, ", ".join(item)), (6, ", ".join(item)),
            (None, " ".join(item)), (7, " ".join(["q"] + item[1:])), (8, " ".join(noise))]
    d = docs(spark, rows)
    got = Counter((r["doc_id"], r["contaminated"], tuple(r["item_ids"]))
                  for r in decontaminate.judge(d, b).collect())
    assert got == Counter({(1, True, (1, 5)): 1, (2, False, ()): 1, (3, False, ()): 1,
                           (4, False, ()): 1, (5, False, ()): 1, (6, True, (1, 5)): 2,
                           (None, True, (1, 5)): 1, (7, True, (1, 5)): 1, (8, False, ()): 1})
    one, two = (decontaminate.matches(d, b, broadcast_shingles=k).collect() for k in (10 ** 6, 0))
    assert sorted(map(repr, one)) == sorted(map(repr, two)) and one
    clean = decontaminate.keep_clean(d, b)
    assert clean.columns == d.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 3, 4, 5, 8]
    assert decontaminate.judge(docs(spark, []), b).count() == 0
    assert decontaminate.keep_clean(d, b.limit(0)).count() == len(rows)


def test_decontaminate_parts_in_another_order(spark):
    rng = random.Random(12)
    items = [(k, " ".join(rng.choices(WORDS, k=n))) for k, n in enumerate((40, 59, 59))]
    words = [t.split() for _, t in items]
    noise = rng.choices(WORDS, k=300)
    moved = [words[0][20:] + words[0][:20], words[1][12:] + words[1][:12],
             words[2][30:45] + words[2][:15] + words[2][15:30] + words[2][45:]]
    rows = [(10 * k + j, " ".join(before + m + after)) for k, m in enumerate(moved)
            for j, (before, after) in enumerate([([], []), (noise, noise), (noise, [])])]
    rows += [(90, " ".join(noise)), (91, " ".join(noise + moved[0][:25] + noise))]
    d, b = docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(rows, items)
    assert want[1] == [0] and want[11] == [1] and not want[91]
    got = {r["doc_id"]: r for r in decontaminate.judge(d, b).collect()}
    assert {k: r["item_ids"] for k, r in got.items()} == want
    assert all(r["contaminated"] == bool(want[k]) for k, r in got.items())


def test_decontaminate_cuts_every_window_at_the_threshold(spark):
    rng = random.Random(13)
    item = rng.choices(WORDS, k=40)
    text = rng.choices(WORDS, k=90) + item + rng.choices(WORDS, k=90)

    def bag_of(w):
        return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))

    def sim(s):
        x, y = bag_of(text[s:s + 40]), bag_of(item)
        return sum((x & y).values()) / sum((x | y).values())

    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["start"]: r["similarity"] for r in
           decontaminate.matches(docs(spark, [(1, " ".join(text))]), b).collect()}
    assert got == {s: sim(s) for s in range(len(text) - 39) if sim(s) >= 0.8} and len(got) > 1


@pytest.mark.parametrize("bits", [0, 7, 23])
def test_multi_index_finds_every_fingerprint_in_the_radius(bits):
    rng = random.Random(bits)
    near = set(decontaminate.near_blocks())
    for _ in range(200):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), bits):
            y ^= 1 << b
        assert any((x >> 8 * k & 255) ^ (y >> 8 * k & 255) in near for k in range(8))


def test_native_plan(spark):
    d, b = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    plan = decontaminate.judge(d, b)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
