"""Packing, sharding, quality rules and the pipeline against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
from llm_brute import brute_classes, brute_leaks, every_block
from pyspark.sql import functions as F

from ledgerlake.llm import packing, quality_rules, queries, sharding
from ledgerlake.llm.common import table

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# --- packing ---------------------------------------------------------------------------

def reference_ids(text):
    from tokenizers import Tokenizer
    if not hasattr(reference_ids, "t"):
        reference_ids.t = Tokenizer.from_file(queries.tokenizer_path())
    return reference_ids.t.encode(text or "", add_special_tokens=False).ids + [1]


def check_packed(rows, docs):
    want = Counter()
    for d, t in docs:
        ids = reference_ids(t)
        for k, lo in enumerate(range(0, len(ids), 4096)):
            part = ids[lo:lo + 4096]
            want[d, k, lo, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(r[:5] for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r[5]].append((r[6], r[3]))
    total = 0
    for places in by.values():
        places.sort()
        at = 0
        for offset, n in places:
            assert offset == at
            at += n
        assert at <= 4096
        total += at
    return len(by), -(-total // 4096)


def test_pack_whole_table(spark):
    docs = rows_of(table(spark, SF, "documents").select("doc_id", "text"))
    used, least = check_packed(rows_of(queries.op6_pack(spark, SF)), docs)
    assert used <= least + 1


def test_pack_edges(spark):
    docs = [(1, None), (2, ""), (3, "x " * 5000), (3, "x " * 5000), (None, "a"), (4, "y " * 4095),
            (5, "<|endoftext|> Σας İ b \x1c é́ don't 12"), (6, " \n\t")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs],
                               "doc_id long, text string, length int, piece int")
    out = packing.pack(packing.pieces(df, queries.tokenizer_path()))
    check_packed(rows_of(out), docs)
    assert packing.pack(packing.pieces(df.limit(0), queries.tokenizer_path())).count() == 0


def test_pack_in_many_groups(spark):
    parts = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        (F.col("id") % 4096 + 1).alias("length"), F.lit(0).cast("long").alias("ids_crc32"))
    rows = rows_of(packing.pack(parts, group=500))
    by = defaultdict(int)
    for r in rows:
        by[r[5]] += r[3]
    assert len(rows) == 3000 and max(by.values()) <= 4096
    assert len(by) <= -(-sum(by.values()) // 4096) + 12


def test_best_two_fit():
    # Greedy takes 6 and 3 of room 10; with 3 out, 2 + 2 fill the gap of 4.
    lengths = [6, 3, 2, 2]
    assert [sorted(lengths[i] for i in b) for b in packing.best_two_fit(lengths, 10)] == [
        [2, 2, 6], [3]]
    rng = random.Random(1)
    for _ in range(100):
        lengths = [rng.randrange(1, 51) for _ in range(rng.randrange(1, 80))]
        bins = packing.best_two_fit(lengths, 50)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 50 for b in bins)
        pool = packing.Pool(lengths)
        room, above = rng.randrange(2, 60), rng.randrange(0, 30)
        sums = [a + b for i, a in enumerate(lengths) for b in lengths[:i] if above < a + b <= room]
        pair = pool.best_pair(room, above)
        assert (sum(pair) if pair else None) == max(sums, default=None)


# --- sharding --------------------------------------------------------------------------

def check_shards(rows, docs, shards=16):
    assert Counter((r[0], r[1], r[2]) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert {r[3] for r in rows} <= {"bytes"} and {r[6] for r in rows} <= {None}
    slots = defaultdict(list)
    together = defaultdict(set)
    loads = [0] * shards
    for r in rows:
        slots[r[4]].append(r[5])
        together[r[1], r[2]].add(r[4])
        loads[r[4]] += r[1]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in together.values())
    return loads


def test_shard_whole_table(spark):
    docs = rows_of(table(spark, SF, "documents").select("doc_id", "text"))
    loads = check_shards(rows_of(queries.op10_shard(spark, SF)), docs)
    assert max(loads) - min(loads) < 2 * max(len(t.encode()) for _, t in docs)


def test_shard_edges_and_salted_classes(spark):
    docs = [(1, None), (2, ""), (None, "a"), (3, "a"), (3, "a"), (4, "é" * 60000)]
    docs += [(100 + i, f"{i:05d}") for i in range(1000)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs],
                               "doc_id long, text string, size int, class int")
    loads = check_shards(rows_of(sharding.assign(df)), docs)
    assert sorted(loads)[-2] - min(loads) <= 20
    check_shards(rows_of(sharding.assign(df, salt_groups=50)), docs)
    assert sharding.assign(df.limit(0)).count() == 0


def test_quotas_equal_one_by_one_lpt():
    import heapq
    rng = random.Random(3)
    for _ in range(200):
        classes = sorted(((rng.randrange(1, 60), rng.randrange(1, 60))
                          for _ in range(rng.randrange(1, 8))), reverse=True)
        shards = rng.choice([1, 2, 5, 16])
        heap = [0] * shards
        loads = [0] * shards
        quotas = sharding.lpt_quotas(classes, shards)
        for (size, n), quota in zip(classes, quotas):
            assert sum(quota) == n
            loads = [x + q * size for x, q in zip(loads, quota)]
            for _ in range(n):
                heapq.heapreplace(heap, heap[0] + size)
            assert sorted(loads) == sorted(heap)


# --- quality ---------------------------------------------------------------------------

def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    rep = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            rep.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(rep),
            len(words) < 10 or 100 * len(rep) > 20 * len(words))


def test_quality_whole_table(spark):
    docs = dict(rows_of(table(spark, SF, "documents").select("doc_id", "text")))
    for r in queries.op8_quality_rules(spark, SF).collect():
        base = brute_base(docs[r["doc_id"]])
        assert tuple(r)[1:7] == base
        assert not (r["base_failed"] and r["kept"])


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    even = lab.filter(F.col("doc_id") % 2 == 0)
    model = quality_rules.fit(d, even)
    odd = {r["doc_id"]: r["quality"] for r in lab.filter(F.col("doc_id") % 2 == 1).collect()}
    got = [(odd[r["doc_id"]], r["kept"]) for r in quality_rules.judge(d, model).collect()
           if r["doc_id"] in odd and not r["base_failed"]]
    assert sum(bool(q) == k for q, k in got) >= 0.97 * len(got) and len(got) > 100


def test_quality_chain_sees_both_labels_in_a_document(spark):
    sf = "/root/testdata/sf0.01"
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    w, t = quality_rules.fit(d, lab)
    texts = [[r["text"] for r in d.join(lab, "doc_id").filter(F.col("quality") == q)
              .filter(F.length("text") < 5000).orderBy("doc_id").limit(60).collect()]
             for q in (0, 1)]
    right = lines = mixed = 0
    for bad, good in zip(*texts):
        for parts in ((good, bad), (bad, good)):
            want = [y for p in parts for y in [int(p is good)] * len(
                quality_rules.line_vectors(p)[0])]
            got = quality_rules.viterbi(quality_rules.line_vectors("\n".join(parts))[0], w, t)
            right += sum(a == b for a, b in zip(got, want))
            lines += len(want)
            mixed += 0 < sum(got) < len(got)
    assert right >= 0.9 * lines and mixed >= 0.9 * 2 * min(map(len, texts))


def test_quality_training_is_bounded_in_lines(spark):
    good, bad = "A calm sentence of words. " * 3, "# $ | < > & * %"
    long = spark.createDataFrame([(1, "\n".join([good] * 100_000)), (2, "\n".join([bad] * 30))],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    model = quality_rules.fit(long, labels)
    assert len(quality_rules.line_vectors("a\n" * 500, quality_rules.TRAIN_LINES)[0]) == 100
    assert quality_rules.viterbi(quality_rules.line_vectors(f"{good}\n{bad}")[0], *model)[0] == 1


def test_quality_edges(spark):
    texts = [None, "", "\x1c \x85 a b", "a b c d e a b c d e f", " \t\n", "same line\nsame line\n",
             "w " * 40000, "é|é " * 12, "a\x0bb\x0cc\rd e f g h i j k"]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(None, "x", 5), (3, texts[3], 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    model = (np.zeros((2, quality_rules.N_FEATURES)), np.zeros((2, 2)))
    want = Counter((r[0], *brute_base(r[1]), not brute_base(r[1])[-1]) for r in rows)
    got = Counter((*tuple(r)[:7], r["kept"]) for r in quality_rules.judge(df, model).collect())
    assert got == want
    kept = quality_rules.keep_good(df, model)
    assert kept.columns == df.columns
    assert Counter(r[0] for r in kept.collect()) == Counter(r[0] for r in want.elements() if r[-1])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    w, t = quality_rules.fit(df, labels)
    assert not w.any() and not t.any()
    assert quality_rules.judge(df.limit(0), model).count() == 0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(100):
        n = rng.integers(1, 8)
        x = rng.normal(size=(n, quality_rules.N_FEATURES))
        w, t = rng.normal(size=(2, quality_rules.N_FEATURES)), rng.normal(size=(2, 2))
        e = x @ w.T

        def score(p):
            return sum(e[i, k] for i, k in enumerate(p)) + sum(t[a, b] for a, b in zip(p, p[1:]))
        best = max(product((0, 1), repeat=int(n)), key=score)
        assert abs(score(quality_rules.viterbi(x.tolist(), w, t)) - score(best)) < 1e-9


# --- pipeline --------------------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline as cp
    from ledgerlake.session import materialize
    docs = table(spark, SF, "documents")
    columns = docs.columns
    bench = rows_of(table(spark, SF, "benchmark").select("item_id", "text"))
    now = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for k, (name, stage) in enumerate(cp.STAGES):
        out = materialize(stage(spark, docs, SF), "stage")
        if k == 0:
            kept = {r["doc_id"] for r in queries.op8_quality_rules(spark, SF).collect()
                    if r["kept"]}
            want = [r for r in now if r[0] in kept]
        elif k == 1:
            want = [r for r, old in zip(every_block(now), now) if r[1].split() or r == old]
        elif k == 2:
            classes = brute_classes(now)
            want = [r for r in now if classes[r[0]] == r[0]]
        elif k == 3:
            leaks = brute_leaks(now, bench)
            want = [r for r in now if not leaks[r[0]]]
        if k < 4:
            assert out.columns == columns
            got = [(r["doc_id"], r["text"]) for r in out.collect()]
            assert sorted(got) == sorted(want), name
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
            docs, now = out, got
        else:
            check_packed(rows_of(out), now)


def test_pipeline_runs(spark):
    import corpus_pipeline as cp
    out = cp.run(spark, SF)
    assert out.count() > 0 and cp.ORACLE_SQL is None
