"""featurelab: table work around machine learning, as Spark jobs.

Sub-packages
------------
sources    readers and writers (parquet tables, CSV folders, JSON Lines,
           binary / whole-text files, append-only logs)
functions  column-expression helpers (null rules, stable hashing, rounding)
operators  DataFrame -> DataFrame operators (validation, encoding, splits,
           balancing, as-of joins, metrics, gates, registry, scoring, text)
plans      the registered queries, each paired with an oracle SQL string
streaming  Structured Streaming jobs (file-triggered scoring, feature sync)
"""

__version__ = "0.1.0"
