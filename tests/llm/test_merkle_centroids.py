"""Merkle manifest and centroid clustering against plain Python versions."""
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from ledgerlake.llm import centroids, merkle

DOC = "doc_id long, source string, lang string, n_chars long, text string, place string, g int"
VEC = "vec_id long, embedding array<double>, label int, q string"


# --- plain versions --------------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    d, source, lang, n, text = row[:5]
    n = None if n is None else n + more
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}"
               for v in (d, source, lang, n, text)])


def plain_tree(digests):
    """Levels from the leaves up."""
    levels = [digests]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i:i + 2]) for i in range(0, len(now), 2)])
    return levels


def plain_path(levels, i):
    """[(place among its run, run size, sibling or None)] up to the root."""
    out = []
    for level in levels[:-1]:
        pair = level[i - i % 2:i - i % 2 + 2]
        out.append((i % 2, pair[1 - i % 2] if len(pair) == 2 else None))
        i //= 2
    return out


def plain_manifest(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[lang] = plain_tree([plain_leaf(r) for r in by_lang[lang]])
    top = plain_tree([trees[x][-1][0] for x in order])
    out = []
    for t, lang in enumerate(order):
        for i, r in enumerate(by_lang[lang]):
            path = plain_path(trees[lang], i) + plain_path(top, t)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = plain_leaf(r, int(hit))
            for side, other in path:
                now = h(now) if other is None else h(other, now) if side else h(now, other)
            out.append((r[0], plain_leaf(r), trees[lang][-1][0], top[-1][0],
                        h(*[o for _, o in path if o]), now, now == top[-1][0]))
    return out


def plain_clusters(vectors, k=16, rounds=3):
    """(vec_id, cluster, distance, cluster inertia, inertia, digest) by full scans."""
    def near(q, c):
        return min((sum((a - b) ** 2 for a, b in zip(q, x)), j) for j, x in enumerate(c))

    kept = [(v, [math.floor(64 * x) for x in e]) for v, e in vectors
            if e is not None and len(e) == 64 and all(
                x is not None and math.isfinite(x) for x in e)]
    ranked = sorted(kept, key=lambda r: (r[0] is None, h(f"1:{r[0]}"), r[1]))
    c = [q for _, q in ranked[:k]]
    for _ in range(rounds):
        got = [near(q, c)[1] for _, q in kept]
        for j in range(len(c)):
            mine = [q for (_, q), g in zip(kept, got) if g == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    got = [near(q, c) for _, q in kept]
    per = {j: sum(d for d, g in got if g == j) for j in range(len(c))}
    return [(v, j, d, per[j], sum(per.values()), h(",".join(map(str, c[j]))))
            for (v, _), (d, j) in zip(kept, got)]


def key(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


def same(df, want):
    assert sorted(map(tuple, df.collect()), key=key) == sorted(want, key=key)


# --- Merkle ----------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 16, 17, 40])
def test_blocks_of_any_size_give_the_plain_tree(n):
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    levels = plain_tree([d.hex() for d in digests])
    for bits in (1, 2, 3, 8):
        rounds, sizes = [list(enumerate(digests))], [n]
        while sizes[-1] > 1:
            m, up = sizes[-1], merkle.height(sizes[-1], bits)
            now = [[x for x in rounds[-1] if x[0] >> bits == b]
                   for b in range((m + (1 << bits) - 1) >> bits)]
            rounds.append([(b, merkle.block_root(x, m, up)) for b, x in enumerate(now)])
            sizes.append(len(now))
        assert rounds[-1][0][1].hex() == levels[-1][0]
        proofs = {0: b""}
        for nodes, m in zip(rounds[-2::-1], sizes[-2::-1]):
            proofs = {i: p for b, proof in proofs.items() for i, p in merkle.descend(
                [x for x in nodes if x[0] >> bits == b], m, merkle.height(m, bits), proof)}
        for i in range(n):
            assert [s.hex() for s in merkle.siblings(proofs[i])] == [
                o for _, o in plain_path(levels, i) if o]
            assert merkle.fold(digests[i], proofs[i]).hex() == levels[-1][0]


def test_queue_of_a_climb_stays_as_small_as_the_height(monkeypatch):
    most = []
    push = merkle.heapq.heappush
    monkeypatch.setattr(merkle.heapq, "heappush",
                        lambda q, x: (push(q, x), most.append(len(q)))[0])
    merkle.block_root([(i, b"%032d" % i) for i in range(256)], 256, 8)
    assert max(most) <= 9


def random_docs(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([None, i, i, 3 - i, 7]), rng.choice([None, "src", ""]),
             rng.choice([None, "en", "en", "en", "en", "é", "", "zz"]),
             rng.choice([None, 0, -5, 2 ** 63 - 1, 12]),
             rng.choice([None, "", "a", "ß€😀\x00 x", "y" * 3000]), "p", 1) for i in range(n)]


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_manifest_of_odd_rows(spark, bits):
    rows = random_docs(120)
    rows += rows[:20]  # repeated rows
    df = spark.createDataFrame(rows, DOC).repartition(5)
    same(merkle.manifest(df, bits), plain_manifest(rows))


def test_manifest_of_few_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], DOC)).count() == 0
    one = [(None, None, None, None, None, "p", 1)]
    same(merkle.manifest(spark.createDataFrame(one, DOC)), plain_manifest(one))
    long = [(1, "s", "en", 3, "word " * 400_000, "p", 1), (2, "s", "en", 0, "", "p", 1)]
    same(merkle.manifest(spark.createDataFrame(long, DOC)), plain_manifest(long))


def test_a_changed_row_is_not_verified(spark):
    rows = [(i, "s", "en", 5, "t", "p", 1) for i in range(60)]
    got = {r["doc_id"]: r["verified"] for r in
           merkle.manifest(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 7 != 0 for i in range(60)}


# --- centroids -------------------------------------------------------------------------

def random_vectors(n, seed, scale=0.1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(9, 64)) * scale
    return [(i, (middle[rng.integers(9)] + rng.normal(size=64) * scale / 3).tolist())
            for i in range(n)]


def frame(spark, vectors):
    return spark.createDataFrame([(v, e, 1, "x") for v, e in vectors], VEC).repartition(4)


def test_clusters_of_random_vectors(spark):
    vectors = random_vectors(400, 3)
    same(centroids.cluster(frame(spark, vectors)), plain_clusters(vectors))


def test_clusters_with_ties_and_odd_rows(spark):
    rng = random.Random(5)
    coarse = [(i, [rng.choice([0.0, 1 / 64, -1 / 64]) for _ in range(4)] * 16) for i in range(150)]
    odd = [(900, None), (901, []), (902, [0.0] * 63), (903, [0.0] * 65), (None, [0.5] * 64),
           (904, [float("nan")] + [0.0] * 63), (905, [None] + [0.0] * 63),
           (906, [float("inf")] + [0.0] * 63), (907, [-0.0] * 64)]
    vectors = coarse + odd + coarse[:30] + [(None, [0.5] * 64)]
    same(centroids.cluster(frame(spark, vectors)), plain_clusters(vectors))


def test_few_vectors_and_none(spark):
    assert centroids.cluster(frame(spark, [(1, None)])).count() == 0
    assert centroids.cluster(spark.createDataFrame([], VEC)).count() == 0
    for n in (1, 2, 5):
        vectors = random_vectors(n, n)
        same(centroids.cluster(frame(spark, vectors)), plain_clusters(vectors))


def test_huge_components_are_held(spark):
    got = centroids.cluster(frame(spark, [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)]))
    assert [r["distance"] for r in got.collect()] == [0, 0, 0]


def test_rounds_agree_with_full_scans_and_skip_most_distances(monkeypatch):
    """Shallot passes on moving centroids: same nearest, far fewer distances."""
    x = np.array([[math.floor(64 * v) for v in e] for _, e in random_vectors(3000, 8)])
    rng = np.random.default_rng(1)
    c = x[rng.choice(len(x), 40, replace=False)]
    counted = []
    real = centroids.squared
    state = centroids.assign_first(x, centroids.Centroids(c))
    monkeypatch.setattr(centroids, "squared",
                        lambda a, b: (counted.append(len(a)), real(a, b))[1])
    for _ in range(6):
        before = c
        c = np.array([x[state[0] == j].mean(0).astype(int) if (state[0] == j).any() else c[j]
                      for j in range(len(c))])
        g = centroids.Centroids(c, before)
        counted.clear()
        state = centroids.shallot(x, *state[:4], g, False)
        full = ((x[:, None, :] - c[None]) ** 2).sum(2)
        assert (state[0] == full.argmin(1)).all()
        assert sum(counted) < 0.6 * full.size
        two = np.sort(full, 1)[:, :2]
        assert (state[2] ** 2 >= two[:, 0] - 1e-3).all()
        rest = full.copy()
        rest[np.arange(len(x)), state[0]] = np.iinfo(np.int64).max
        assert (state[3] <= np.sqrt(rest.min(1)) + 1e-6).all()


def test_queries_read_the_whole_tables(spark):
    from ledgerlake.llm import queries
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", "source", "lang", "n_chars", "text").collect()]
    same(queries.op13_merkle(spark, sf), plain_manifest(docs))
    vectors = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    same(queries.op12_centroids(spark, sf), plain_clusters(vectors))
