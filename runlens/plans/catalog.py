"""Registered queries: one per operator of the inventory.

``QUERIES[key](spark, sf_dir)`` returns a DataFrame over the whole derived
views (no row caps, no id subsets); ``ORACLE[key]`` is the same question in
DuckDB SQL over the raw tables (views inlined as CTEs).  Doubles are rounded
to 4 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def round4(c):
    """Round a DOUBLE to 4 places with plain IEEE steps (x*1e4 + 0.500001,
    floor, /1e4) so another engine taking the same steps gets the identical
    double.  The slack rounds a mean that lies on a tie up also where the
    order of summation left it one unit below.  From 1e14 on a DOUBLE has no
    fourth place, and is returned as it is."""
    scaled = F.floor(c * F.lit(10000.0) + F.lit(0.500001)).cast("double") / F.lit(10000.0)
    return F.when(F.abs(c) < F.lit(1e14), scaled).otherwise(c)


def rounded(df: DataFrame) -> DataFrame:
    """Round every top-level DOUBLE column (for cross-engine comparison) and
    give timestamps as TIMESTAMP_NTZ: the UTC wall-clock value (the session
    zone is UTC), which is collected without conversion to the client's
    local zone and compares with zone-less timestamps elsewhere."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = round4(c.cast("double"))
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        QUERIES[key].__doc__ = fn.__doc__
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


# The individual query groups register themselves on import.
from runlens.plans import q_aggs, q_core, q_dash, q_docs, q_etl, q_functions, q_incremental, q_ingest, q_jobs, q_sources, q_yarn  # noqa: E402,F401
