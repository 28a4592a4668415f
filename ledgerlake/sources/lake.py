"""Reading the lake's own Parquet datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.sources.exports import read_parquet_or_empty


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | str,
                recursive: bool = False) -> DataFrame:
    """A Hive-partitioned bronze dataset (``source=/year_month=`` folders).

    The explicit schema (partition columns included) plays the part of
    union-by-name: files written before a column existed read it as NULL, and no
    file's own types are merged.  Partition filters on ``source`` / ``year_month``
    prune folders.  ``recursive`` reads every Parquet file below ``path`` without
    partition columns (the symbol lookup over all trades files).  An absent path
    is an empty dataset.
    """
    options = {"recursiveFileLookup": "true"} if recursive else {"basePath": path}
    return read_parquet_or_empty(spark, path, schema, **options)


def subfolders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Folders ``<path>/<prefix>*``, sorted; none without the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p)
                  if s.isDirectory() and s.getPath().getName().startswith(prefix))


def read_generations(spark: SparkSession, path: str, prefix: str = "batch=") -> DataFrame:
    """Union by name over writes whose columns or types differ.

    Every folder ``<path>/<prefix>*`` is one write, so its files are alike and one footer
    tells its layout.  Layouts are united by name: a column that a layout lacks is NULL there, and numbers take the wider type
    (int with bigint, float with double, bigint with decimal or double).  Partition
    folders below a write stay columns, so filters on them prune in every scan.
    """
    folders = subfolders(spark, path, prefix)
    if not folders:
        raise FileNotFoundError(f"no {prefix}* folder in {path}")
    layouts: dict[str, tuple[T.StructType, list[str]]] = {}
    for f in folders:  # reads one footer each
        schema = spark.read.parquet(f).schema
        layouts.setdefault(schema.json(), (schema, []))[1].append(f)
    scans = [reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(f) for f in group])
             for schema, group in layouts.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
