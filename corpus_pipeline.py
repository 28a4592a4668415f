"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet in the shared folder and reads it again as the next stage's documents.  All
stages but the last return the columns of ``documents``.

Rows that are NULL, empty, repeated or without an id go through as the operators'
docstrings say: NULL and empty texts fail the quality rules, so later stages do not
see them in a run.  A document that line dedup leaves without a word goes (its lines
stay in earlier documents); n_chars follows the rewritten text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, line_dedup, near_dedup, packing, quality_rules
from ledgerlake.llm.common import table
from ledgerlake.llm.queries import tokenizer_path
from ledgerlake.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_rules.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.rewritten(docs)
    changed = F.col("gone").isNotNull()
    out = out.filter(~(changed & ~F.regexp_like("text", F.lit(line_dedup.WORD))))
    new = {"text": F.col("text"), "n_chars": F.when(changed, F.length("text")).otherwise(
        F.col("row.n_chars") if "n_chars" in docs.columns else F.lit(None))}
    return out.select(*[new.get(f.name, F.col(f"row.`{f.name}`")).cast(f.dataType).alias(f.name)
                        for f in docs.schema])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, tokenizer_path()))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-dedup", near),
          ("decontamination", benchmark), ("packing", pack)]

#: No stage but plain filters can be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
