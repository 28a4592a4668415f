"""ledgerlake: household-finance lakehouse jobs expressed as Spark DataFrame plans.

Layers:
  sources/   raw exports and driver tables -> bronze-shaped DataFrames
  functions/ column expressions (numeric semantics, predicates, hashing)
  operators/ reusable relational operators (dedup, as-of join, ledger fold, checks)
  plans/     silver and gold models wired from the operators
  sinks/     partitioned bronze writes, gold export
  streaming/ incremental silver with Structured Streaming
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
