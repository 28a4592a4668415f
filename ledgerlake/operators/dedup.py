"""Keep-first deduplication by key.

Equivalent to ``row_number() over (partition by key order by ts asc nulls last) = 1``
but written as an aggregation: ``min(struct(ts is null, ts, <payload>))`` per key.
The aggregate runs a partial (map-side) step, so a key copied millions of times
is collapsed before the shuffle instead of landing whole in one window task.
Ties on ``ts`` resolve on the payload values, so the result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, key: str | Sequence[str] = "row_hash",
                order: str = "ingested_at", keep: Sequence[str] | None = None) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in (keep if keep is not None else df.columns) if c not in keys and c != order]
    best = F.min(F.struct(F.col(order).isNull().alias("_null_ts"), F.col(order).alias("_ts"),
                          *[F.col(c) for c in payload])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload])


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              keep: Sequence[str] | None = None, made_of: dict[str, Column] | None = None
              ) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    ``order`` columns are compared left to right, NULLs lowest; include a unique
    column last for a deterministic tie-break.  Aggregation-based for the same
    skew reason as ``dedup_first``.  ``made_of``: order columns that the rows do not have, as
    expressions; they are made while rows are compared, so no sort carries them.
    """
    keys, made = list(keys), made_of or {}
    payload = [c for c in (keep if keep is not None else df.columns)
               if c not in keys and c not in order]
    best = F.max(F.struct(*[made.get(c, F.col(c)).alias(f"_o{i}") for i, c in enumerate(order)],
                          *[F.col(c) for c in payload])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order)],
                      *[F.col(f"_best.{c}").alias(c) for c in payload])
