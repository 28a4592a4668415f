"""Row fingerprints for cross-file / cross-run deduplication.

A row hash is sha256 over '|'-joined canonical text of the key columns.  The
canonical text of each part is its typed value (dates as yyyy-MM-dd, money as
fixed-scale decimal text), never a double's text, and a NULL part is written as
a marker so a missing value cannot shift the other parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL marker of the hash text.
SEP = "|"
NULL_MARK = "∅"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def canonical_text(col) -> Column:
    return F.coalesce(_c(col).cast("string"), F.lit(NULL_MARK))


def hash_text(parts) -> Column:
    return F.concat_ws(SEP, *[canonical_text(p) for p in parts])


def packed(name: str) -> list[Column]:
    """A hash column for a shuffle: hex digits as bytes, half as long; other text as it is."""
    raw = F.unhex(F.col(name))
    is_hex = F.coalesce(F.lower(F.hex(raw)) == F.col(name), F.lit(False))
    return [F.when(is_hex, raw).alias(f"_{name}_bytes"),
            F.when(~is_hex, F.col(name)).alias(f"_{name}_text")]


def unpacked(name: str) -> Column:
    """The column that ``packed`` was made of."""
    return F.coalesce(F.lower(F.hex(F.col(f"_{name}_bytes"))), F.col(f"_{name}_text"))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)
