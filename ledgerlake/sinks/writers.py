"""Writes: partitioned bronze datasets (K1-K3, K6) and the gold export."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.hashing import packed, unpacked
from ledgerlake.plans.ingest import partition_counts
from ledgerlake.session import COMPRESSION

BANK_PARTITIONS = ("source", "year_month")
TRADE_PARTITIONS = ("source", "year_month")
PRICE_PARTITIONS = ("year_month",)


def write_bronze(df: DataFrame, path: str, partition_cols: Sequence[str] = BANK_PARTITIONS,
                 mode: str = "overwrite", max_records_per_file: int = 5_000_000,
                 partition_mode: str = "dynamic") -> None:
    """Write a bronze batch as Hive-partitioned Parquet.

    ``overwrite`` replaces only the partitions present in the batch (dynamic
    partition overwrite), so a re-upload of one month leaves the other months
    intact (``partition_mode="static"``: replaces the folder); ``append`` keeps earlier files
    and leaves duplicates to silver.
    No shuffle by partition value: a month holding most of the rows would land
    in one task.  Each task writes its own rows per partition, and files are
    capped at ``max_records_per_file`` rows.
    """
    cols = list(partition_cols)
    (df.write.mode(mode)
       .option("partitionOverwriteMode", partition_mode)
       .option("maxRecordsPerFile", max_records_per_file)
       .option("compression", COMPRESSION)
       .partitionBy(*cols)
       .parquet(path))


def plan_write(df: DataFrame, partition_cols: Sequence[str] = BANK_PARTITIONS) -> DataFrame:
    """Dry run: the partitions a write would touch and their row counts (K6)."""
    return partition_counts(df, partition_cols)


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Full-refresh materialisation of a model (K4): a managed table or a Parquet folder."""
    w = df.write.mode("overwrite")
    if path is None:
        w.saveAsTable(name)
    else:
        w.parquet(path)


def write_laid_out(df: DataFrame, name: str, keys: Sequence[str], order: Sequence[str],
                   buckets: int, path: str | None = None) -> None:
    """Full-refresh catalog table, dealt by ``keys`` into buckets and sorted in each.

    Rows are dealt once when the table is written; a reader that groups, joins or windows by
    the keys needs no exchange.  One file per bucket, so the order within it is kept.
    A ``row_hash`` is shipped as bytes.
    """
    hashes = [c for c in ("row_hash",) if c in df.columns and c not in keys]
    dealt = df.select(*[c for c in df.columns if c not in hashes],
                      *[p for c in hashes for p in packed(c)]).repartition(buckets, *keys)
    rows = dealt.select(*[unpacked(c).alias(c) if c in hashes else F.col(c) for c in df.columns])
    w = (rows.write.mode("overwrite").format("parquet").option("compression", COMPRESSION)
         .bucketBy(buckets, *keys).sortBy(*keys, *order))
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(name)


class Exported(dict):
    """Written tables by name, read back; ``rows``: how many rows each write had."""

    def __init__(self, spark: SparkSession) -> None:
        super().__init__()
        self.spark = spark
        self.rows: dict[str, int] = {}

    def add(self, other: Exported) -> None:
        self.update(other)
        self.rows.update(other.rows)


def export_gold(spark: SparkSession, tables: Mapping[str, DataFrame | None], path: str
                ) -> Exported:
    """Write each gold table to <path>/<table> as Parquet; the written tables, read back.

    A missing table (None) is skipped and logged.  Rows are counted by the write itself
    (observed in its last stage, where a repeated task counts once).
    """
    out = Exported(spark)
    for name, df in tables.items():
        if df is None:
            logging.getLogger(__name__).warning("gold export: no table %s, skipped", name)
            continue
        target = f"{path.rstrip('/')}/{name}"
        seen = Observation(f"export-{name}-{uuid.uuid4().hex[:8]}")
        (df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
         .option("compression", COMPRESSION).parquet(target))
        out[name] = spark.read.schema(df.schema).parquet(target)
        out.rows[name] = seen.get["rows"]
    return out


def export_counts(exported: Exported) -> DataFrame:
    """(table_name, rows) of an export, as its writes counted them."""
    return exported.spark.createDataFrame(list(exported.rows.items()), "table_name string, rows long")


def tables_from_catalog(spark: SparkSession, names: Sequence[str], database: str | None = None
                        ) -> dict[str, DataFrame | None]:
    """Look up gold tables in the catalog; absent ones map to None."""
    out: dict[str, DataFrame | None] = {}
    for n in names:
        full = f"{database}.{n}" if database else n
        out[n] = spark.table(full) if spark.catalog.tableExists(full) else None
    return out


def write_export_files(lines: DataFrame, path: str, file_col: str = "file",
                       line_col: str = "line_no", text_col: str = "text") -> None:
    """Write text export files, one per ``file_col`` value, lines in ``line_col`` order.

    Each export file is a bounded unit (one statement), written by one task into
    ``<path>/<file_col>=<name>/``; the sort within the task keeps the line order.
    """
    (lines.repartition(F.col(file_col))
          .sortWithinPartitions(file_col, line_col)
          .select(file_col, text_col)
          .write.mode("overwrite").partitionBy(file_col).text(path))
