"""Alerts and dashboard queries.

Each alert is two DataFrames: a condition (rows that fire) and a report.
Times are compared with an explicit as-of parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.constants import ALERT_EXCLUDED_ERROR_TYPES, ALERT_QUIET_HOURS, ALERT_RECENT_ERRORS


def severe_errors(errors: DataFrame, asof: Column, lookback: str = "1 day", time_col: str = "time_processed",
                  type_col: str = "type", excluded: list[str] = ALERT_EXCLUDED_ERROR_TYPES) -> DataFrame:
    """K1: errors in (asof - lookback, asof] whose type is not excluded (a
    document without a type is kept)."""
    lo = asof - F.expr(f"INTERVAL {lookback}")
    t = F.col(time_col)
    return errors.where((t > lo) & (t <= asof) & ~F.coalesce(F.col(type_col).isin(*excluded), F.lit(False)))


def errors_by_host(errors: DataFrame, host_col: str = "host", type_col: str = "type") -> DataFrame:
    """Error counts per (host, type) plus per-host totals (``rollup``)."""
    return errors.rollup(host_col, type_col).agg(
        F.count(F.lit(1)).alias("n_errors"),
        (F.grouping(type_col) == 1).alias("is_host_total"),
        F.grouping(host_col).alias("__g_host"),
    ).where(F.col("__g_host") == 0).drop("__g_host")


def recent(errors: DataFrame, n: int = ALERT_RECENT_ERRORS, time_col: str = "time_processed",
           tie: str = "err_id") -> DataFrame:
    """The ``n`` most recent rows (top-k, total order)."""
    return errors.orderBy(F.desc(time_col), F.desc(tie)).limit(n)


def error_report(errors: DataFrame, host_col: str = "host", type_col: str = "type",
                 time_col: str = "time_processed") -> DataFrame:
    """K2: per host (and a grand total with host NULL): number of errors,
    latest error time and the distinct error types.  Errors are first reduced
    to one row per (host, type), so the grand total's group holds types, not
    errors."""
    each = errors.groupBy(host_col, type_col).agg(F.count(F.lit(1)).alias("__n"), F.max(time_col).alias("__latest"))
    return each.rollup(host_col).agg(
        F.sum("__n").alias("n_errors"),
        F.max("__latest").alias("latest"),
        F.when(F.count(type_col) > 0, F.array_join(F.array_sort(F.collect_set(type_col)), ",")).alias("types"),
    )


def latest_by_host(store: DataFrame, host_col: str = "host", end_col: str = "end_time",
                   processed_col: str = "time_processed") -> DataFrame:
    """Per host, the latest end time and latest processing time."""
    return store.groupBy(host_col).agg(
        F.max(end_col).alias("max_end_time"), F.max(processed_col).alias("max_time_processed")
    )


def quiet_hosts(store: DataFrame, asof: Column, hours: int = ALERT_QUIET_HOURS, host_col: str = "host",
                end_col: str = "end_time", processed_col: str = "time_processed") -> DataFrame:
    """K3: per host, whether nothing was processed in the last ``hours``."""
    lat = latest_by_host(store, host_col, end_col, processed_col)
    return lat.withColumn(
        "quiet", F.col("max_time_processed") < F.timestamp_add("HOUR", F.lit(-hours), asof)
    )


def histogram(df: DataFrame, value: Column | str, width: float, cap: float | None = None,
              group: list[str] | None = None) -> DataFrame:
    """K6: counts per bucket floor(x / width) * width, values above ``cap``
    left out."""
    v = F.col(value) if isinstance(value, str) else value
    kept = df.where(v.isNotNull() if cap is None else v <= F.lit(cap))
    bucket = (F.floor(v / F.lit(width)) * F.lit(width)).alias("bucket")
    return kept.groupBy(*(group or []), bucket).agg(F.count(F.lit(1)).alias("n"))


def running_level(events: DataFrame, keys: list[str], time_col: str, delta_col: str,
                  bucket: str = "1 day", level_col: str = "level") -> DataFrame:
    """Level of a +/- series at every change point, per key, computed as
    a two-level prefix sum so that no key is sorted in a single task:

    1. deltas netted per (key, time) (partial + final aggregation);
    2. a running sum inside each (key, time bucket);
    3. bucket totals, prefix-summed per key over the (few) buckets;
    4. level = running sum in bucket + sum of all earlier buckets.
    """
    b = F.window(time_col, bucket).start
    # netted per (key, bucket, time): grouping by the bucket too makes the
    # window below and the bucket totals reuse this aggregate's partitioning
    netted = events.groupBy(*keys, b.alias("__b"), time_col).agg(F.sum(delta_col).alias("__d"))
    inner = Window.partitionBy(*keys, "__b").orderBy(time_col).rowsBetween(Window.unboundedPreceding, 0)
    local = netted.withColumn("__local", F.sum("__d").over(inner))
    totals = local.groupBy(*keys, "__b").agg(F.sum("__d").alias("__tot"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__off", F.coalesce(F.sum("__tot").over(before), F.lit(0))).drop("__tot")
    return local.join(offsets, [*keys, "__b"]).select(
        *keys, time_col, (F.col("__local") + F.col("__off")).alias(level_col)
    )
