"""hearth: a Spark-native rental-listings analytics library.

Subpackages:
  sources    readers/writers, adapters over the driver tables, pages (frontier, text, gate)
  functions  column expressions (text, reply JSON on VARIANT, numeric rules, hash split, let-binding)
  operators  DataFrame → DataFrame operators (dedup, cleaning, quantiles, profiling, reports, validation,
             encoding, features, upsert, replies, alerts, metrics, deals, model)
  plans      the named query catalogue and its DuckDB oracle SQL
  streaming  micro-batch upsert, stateful current view, alert streams

Every function takes and returns Spark DataFrames (or Column expressions) and stays lazy, except where a
bounded value must be known to build the plan (a model fit, quantile split points, a snapshot path).
"""

__version__ = "0.1.0"
