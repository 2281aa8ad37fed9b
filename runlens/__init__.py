"""runlens: run-telemetry analytics on Spark.

Reads landed telemetry of batch-application runs (applications, attempts,
executors, stages, environments, cluster snapshots, ETL runs), cleans and
types it with native column expressions, computes per-attempt statistics and
derived metrics, keeps results current incrementally, and answers the
monitoring and alert queries built on them.
"""

__version__ = "0.1.0"
