"""Centroid clustering: exact k-means rounds with Shallot search on integer vectors.

Vectors with exactly ``DIM`` components, none NULL or non-finite, are kept; a component x
becomes the integer floor(64 * x).  Every vector is assigned to the nearest centroid
(squared Euclidean distance in integers; ties: the smaller number), every non-empty
centroid becomes the componentwise floor of its vectors' mean, empty ones stay.

Shallot search: a vector keeps its centroid, its second-nearest one, an upper bound on the
distance to the first and a lower bound on the distance to all others.  When centroids
move, the bounds follow; a vector whose upper bound stays under the lower one (or under
half the gap to the next centroid) is left alone.  For the rest the exact distances to the
two remembered centroids are taken, and the search starts from the closer one: its
neighbours are visited in ascending order of their gap, as long as the gap is within
the ball of d(first) + d(second so far), which shrinks with every better second.
Distances of visited centroids are compared as integers; bounds carry a margin for
floating-point error, so they only ever leave out what cannot win.

On Spark: a round is one pass over the vectors with their bounds, written to the shared
folder, and one aggregation of counts and sums.  Only the centroids (k * DIM integers) and
one row of sums per centroid reach the driver; no vector is shuffled.

Defined cases: NULL, short, long, NULL-holding and non-finite vectors are left out;
integers are held to +-2^27 (distances then fit 63 bits); repeated rows are clustered like
any other; NULL ids are clustered and start last; with fewer vectors than k each starts a
centroid; equal starting ids are ordered by components; an inertia beyond 63 bits is NULL;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import materialize, ship_package

DIM = 64
SCALE = 64
K = 16
ROUNDS = 3
LIMIT = 1 << 27
#: Relative and absolute margin of the floating-point bounds.
MARGIN = 1e-9

STATE = ("vec_id long, q array<int>, cluster int, second int, upper double, lower double, "
         "distance long")


def integer_vectors(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """vec_id, q (integers) of the vectors that are kept."""
    x = F.col("embedding")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                     & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    held = lambda v: F.greatest(F.lit(float(-LIMIT)), F.least(
        F.lit(float(LIMIT)), F.floor(v.cast("double") * F.lit(float(SCALE))).cast("double")))
    return (vectors.filter(F.size(x) == dim).filter(sound)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda v: held(v).cast("int")).alias("q")))


def starts(kept: DataFrame, k: int = K) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``1:<vec_id>`` (at most k rows come here)."""
    rank = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(rank.asc_nulls_last(), "q").limit(k).select("q").collect()
    return np.array([r["q"] for r in rows], dtype=np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to those of ``c`` (or to one vector)."""
    gap = x - c
    return np.einsum("ij,ij->i", gap, gap)


class Centroids:
    """The centroids of a round: gaps, neighbours in ascending order, and how far they moved."""

    def __init__(self, c: np.ndarray, before: np.ndarray | None = None):
        self.c, k = c, len(c)
        gap = np.sqrt(np.array([squared(c, one) for one in c], dtype=np.float64).reshape(k, k))
        self.order = np.empty((k, max(k - 1, 0)), dtype=np.int64)
        for i in range(k):
            by_gap = np.lexsort((np.arange(k), gap[i]))
            self.order[i] = by_gap[by_gap != i]
        self.gap = np.take_along_axis(gap, self.order, axis=1)
        self.half = self.gap[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        move = np.zeros(k) if before is None else np.sqrt(squared(c, before).astype(np.float64))
        far = np.argsort(move)
        self.move = move
        # The farthest move among the others of each centroid.
        self.drift = np.full(k, move[far[-1]])
        self.drift[far[-1]] = move[far[-2]] if k > 1 else 0.0


def assign_first(x: np.ndarray, g: Centroids) -> tuple[np.ndarray, ...]:
    """Centroid, second, upper and lower bound, distance of vectors without a history."""
    n, k = len(x), len(g.c)
    best, second = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    top = np.iinfo(np.int64).max
    d1, d2 = np.full(n, top), np.full(n, top)
    for j in range(k):
        keep_closest(np.arange(n), np.full(n, j), squared(x, g.c[j]), best, second, d1, d2)
    lower = np.sqrt(d2.astype(np.float64)) if k > 1 else np.full(n, np.inf)
    return best, second, np.sqrt(d1.astype(np.float64)), lower, d1


def keep_closest(rows: np.ndarray, j: np.ndarray, d: np.ndarray, best: np.ndarray,
                 second: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> None:
    """Put centroid j at distance d into first or second place of ``rows`` (in place)."""
    first = (d < d1[rows]) | ((d == d1[rows]) & (j < best[rows]))
    next_ = ~first & ((d < d2[rows]) | ((d == d2[rows]) & (j < second[rows])))
    up = rows[first]
    second[up], d2[up] = best[up], d1[up]
    best[up], d1[up] = j[first], d[first]
    second[rows[next_]], d2[rows[next_]] = j[next_], d[next_]


def shallot(x: np.ndarray, best: np.ndarray, second: np.ndarray, upper: np.ndarray,
            lower: np.ndarray, g: Centroids, exact: bool) -> tuple[np.ndarray, ...]:
    """The same five columns after the centroids moved; ``exact``: all distances are wanted."""
    best, second = best.astype(np.int64), second.astype(np.int64)
    upper, lower = upper + g.move[best], lower - g.drift[best]
    distance = np.zeros(len(x), dtype=np.int64)
    safe = np.maximum(lower, g.half[best])
    todo = np.arange(len(x)) if exact else np.flatnonzero(~(upper * (1 + MARGIN) + MARGIN < safe))
    distance[todo] = squared(x[todo], g.c[best[todo]])
    upper[todo] = np.sqrt(distance[todo].astype(np.float64))
    todo = todo[~(upper[todo] * (1 + MARGIN) + MARGIN < safe[todo])]
    if len(g.c) == 1 or not len(todo):
        return best, second, upper, lower, distance
    y, a, s = x[todo], best[todo], second[todo]
    d1, d2 = distance[todo], squared(y, g.c[s])
    swap = (d2 < d1) | ((d2 == d1) & (s < a))
    a, s = np.where(swap, s, a), np.where(swap, a, s)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    home, other, base = a.copy(), s.copy(), np.sqrt(d1.astype(np.float64))
    live = np.arange(len(todo))
    for r in range(len(g.c) - 1):
        ball = base[live] + np.sqrt(d2[live].astype(np.float64))
        live = live[g.gap[home[live], r] <= ball * (1 + MARGIN) + MARGIN]
        if not len(live):
            break
        j = g.order[home[live], r]
        new = j != other[live]  # its distance is known already
        rows, j = live[new], j[new]
        keep_closest(rows, j, squared(y[rows], g.c[j]), a, s, d1, d2)
    best[todo], second[todo], distance[todo] = a, s, d1
    upper[todo], lower[todo] = np.sqrt(d1.astype(np.float64)), np.sqrt(d2.astype(np.float64))
    return best, second, upper, lower, distance


def _pass(df: DataFrame, g: Centroids, first: bool, exact: bool) -> DataFrame:
    """One assignment of all vectors, batch by batch."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            x = b["q"].flatten().to_numpy().astype(np.int64).reshape(b.num_rows, -1)
            if first:
                got = assign_first(x, g)
            else:
                old = (b[c].to_numpy() for c in ("cluster", "second", "upper", "lower"))
                got = shallot(x, *old, g, exact)
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["q"], *[pa.array(v, t) for v, t in zip(got, kinds)]],
                names=["vec_id", "q", "cluster", "second", "upper", "lower", "distance"])

    return df.mapInArrow(run, STATE)


def means(state: DataFrame, c: np.ndarray) -> np.ndarray:
    """The next centroids: floors of the exact means; an empty one stays."""
    rows = state.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col("q")[i].cast("long")) for i in range(c.shape[1])]).alias("sums")
    ).collect()  # one row per centroid
    out = c.copy()
    for r in rows:
        out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return out


def fit(kept: DataFrame, k: int = K, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The assigned vectors (columns of ``STATE``) and the centroids they are assigned to."""
    c = starts(kept, k)
    if not len(c):
        return kept.sparkSession.createDataFrame([], STATE), c
    state = materialize(_pass(kept, Centroids(c), True, rounds == 0), "centroids-0")
    for r in range(1, rounds + 1):
        before, c = c, means(state, c)
        state = materialize(_pass(state, Centroids(c, before), False, r == rounds),
                            f"centroids-{r}")
    return state, c


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    state, c = fit(integer_vectors(vectors, dim), k, rounds)
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["s"])
            for r in state.groupBy("cluster").agg(whole.alias("s")).collect()}
    fits = lambda v: v if v < 1 << 63 else None
    rows = [(j, fits(s), fits(sum(sums.values())),
             hashlib.sha256(",".join(map(str, c[j].tolist())).encode()).hexdigest())
            for j, s in sorted(sums.items())]
    per = state.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # Proven bound: one row per centroid.
    return (state.select("vec_id", "cluster", "distance")
            .join(F.broadcast(per), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                    "centroid_sha256"))
