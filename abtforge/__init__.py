"""abtforge: analytic-base-table pipelines written as Spark DataFrame, SQL and MLlib jobs.

Layers
------
sources    tables, files, views, catalog listing, seed dimensions
functions  column expressions (keys, splits, row-wise maths, numeric coercion, decisions)
operators  DataFrame -> DataFrame building blocks (clean, wide compaction, joins, quality,
           profiling, splits, leakage checks, metrics, model, runs, decisions, features)
plans      stand-in tables derived from the driver data set and the registered queries
streaming  incremental file ingest with Structured Streaming
"""

__version__ = "0.1.0"
