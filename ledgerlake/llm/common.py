"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerlake.session import ship_package

MASK64 = (1 << 64) - 1
#: Entries that a per-task word cache may hold before it starts anew (bounds memory).
CACHE_WORDS = 800_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_digest(text: Column) -> Column:
    """16 bytes that stand for a text; NULL stays NULL."""
    return F.unhex(F.md5(text.cast("binary")))


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that helper columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def map_rows(df: DataFrame, fn: Callable[[Iterable[tuple]], Iterator[tuple]], schema: str
             ) -> DataFrame:
    """Run ``fn`` (an iterator of row tuples to an iterator of row tuples) in each task.

    Rows travel as Arrow batches; output rows are regrouped into batches of at
    most 2000, so a task never holds more than a few batches.
    """
    ship_package(df.sparkSession)
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                for lo in range(0, b.num_rows, 512):
                    yield from zip(*(c.to_pylist() for c in b.slice(lo, 512).columns))

        def pack(part: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*part))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow)

        part: list[tuple] = []
        for r in fn(rows()):
            part.append(r)
            if len(part) == 2000:
                yield pack(part)
                part = []
        if part:
            yield pack(part)

    return df.mapInArrow(run, out)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), elementwise on uint64."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """word -> 64-bit hash, remembered; starts anew when it holds CACHE_WORDS words."""

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the k-word shingles of hashed words; fewer than k words make one."""
    if len(words) == 0:
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, dtype=np.uint64)
        for i in range(k):
            h = mix64(h ^ words[i:i + n])
    return h
