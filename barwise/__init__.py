"""barwise — daily-bar analytics expressed as Spark DataFrame plans.

Sub-packages:
  sources    typed readers for landing feeds and the test-fixture adapter
  functions  small column helpers (null-safe arithmetic, parsing, dates)
  operators  reusable relational building blocks (windows, EWM, as-of joins,
             keyed upserts, ranking, aggregates, metrics, folds)
  plans      the end-to-end jobs (registry, ingestion, features, training,
             prediction, serving sync, read queries)
  streaming  incremental file-triggered ingestion with Structured Streaming
"""

__version__ = "0.1.0"
