"""Derived run metrics (M1-M8) and the per-attempt report.

All arithmetic is column expressions; divisions go through ``try_divide``
(ANSI mode raises on division by zero).  Durations are whole milliseconds
(BIGINT), cost and ratios are DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.constants import GIB
from runlens.functions import hdfs_blocks, millis_between
from runlens.operators.intervals import interval_union
from runlens.operators.typed_agg import executor_aggregate, typed_aggregate

KEYS = ["app_id", "attempt_id"]


def executor_metrics(executors: DataFrame, attempts: DataFrame, keys: list[str] = KEYS,
                     carry: list[str] | None = None) -> DataFrame:
    """M1: executor lifetime and cost.

    Missing ``addTime``/``removeTime`` default to the attempt's start/end.
    Adds x_startTime, x_stopTime, x_durationMilliseconds, x_durationHours,
    x_coreCost (cores x ms), x_storageCost (GiB x ms) and hour variants.
    ``carry`` names attempt columns to bring along (same join).
    """
    bounds = attempts.select(*keys, F.col("startTime").alias("__a_start"), F.col("endTime").alias("__a_end"),
                             *(carry or []))
    ex = executors.join(bounds, keys, "left")
    start = F.coalesce(F.col("addTime"), F.col("__a_start"))
    stop = F.coalesce(F.col("removeTime"), F.col("__a_end"))
    ms = millis_between(stop, start)
    hours = ms / F.lit(3600000.0)
    gib = F.col("maxMemory") / F.lit(float(GIB))
    return (
        ex.withColumn("x_startTime", start)
        .withColumn("x_stopTime", stop)
        .withColumn("x_durationMilliseconds", ms)
        .withColumn("x_durationHours", hours)
        .withColumn("x_coreCost", F.col("totalCores") * ms)
        .withColumn("x_storageCost", gib * ms)
        .withColumn("x_coreCost_hours", F.col("totalCores") * hours)
        .withColumn("x_storageCost_GbHours", gib * hours)
        .drop("__a_start", "__a_end")
    )


def stage_metrics(stages: DataFrame) -> DataFrame:
    """M2: scheduling overhead, duration, throughput, CPU ms, per-task sizes.

    A stage without completion or first-task time gets overhead 0, duration 0
    and throughputs -1.  A zero-length complete stage has NULL throughput.
    Per-task averages are NULL when no task completed.
    """
    complete = F.col("completionTime").isNotNull() & F.col("firstTaskLaunchedTime").isNotNull()
    overhead = millis_between("firstTaskLaunchedTime", "submissionTime")
    duration = millis_between("completionTime", "firstTaskLaunchedTime")
    tasks = F.col("numCompleteTasks")
    return (
        stages.withColumn("x_scheduling_overhead", F.when(complete, overhead).otherwise(F.lit(0)))
        .withColumn("x_duration", F.when(complete, duration).otherwise(F.lit(0)))
        .withColumn("x_executorCpuTime_ms", F.col("executorCpuTime") / F.lit(1e6))
        .withColumn(
            "throughput_bytes",
            F.when(complete, F.try_divide(F.col("inputBytes").cast("double"), duration)).otherwise(F.lit(-1.0)),
        )
        .withColumn(
            "throughput_records",
            F.when(complete, F.try_divide(F.col("inputRecords").cast("double"), duration)).otherwise(F.lit(-1.0)),
        )
        .withColumn(
            "x_average_task_input_bytes",
            F.when(tasks != 0, F.try_divide(F.col("inputBytes").cast("double"), tasks)),
        )
        .withColumn(
            "x_average_task_output_bytes",
            F.when(tasks != 0, F.try_divide(F.col("outputBytes").cast("double"), tasks)),
        )
    )


def stage_aggregate(stages: DataFrame, keys: list[str] = KEYS, nunique: str = "exact") -> DataFrame:
    """M2 then typed aggregation, columns prefixed ``stages_``."""
    return typed_aggregate(stage_metrics(stages), keys, prefix="stages_", nunique=nunique)


def summary_columns(duration: str = "duration") -> list:
    """M3-M8 over the joined aggregate columns (guarded by M3)."""
    ok = (
        (F.coalesce(F.col("executors_elements_count"), F.lit(0)) > 0)
        & (F.coalesce(F.col("stages_elements_count"), F.lit(0)) > 0)
        & F.col("stages_firstTaskLaunchedTime_min").isNotNull()
        & F.col("stages_completionTime_max").isNotNull()
    )
    dur = F.col(duration)
    parallel_work = F.col("executors_totalDuration_sum")
    parallel_part = F.coalesce(F.col("stages_union_ms"), F.lit(0).cast("bigint"))
    seq_part = dur - parallel_part
    est_seq = seq_part + parallel_work
    core_cost = F.col("executors_x_coreCost_sum")
    max_in = F.col("stages_inputBytes_max")
    max_out = F.col("stages_outputBytes_max")
    mem_sum = F.col("executors_maxMemory_sum")
    peak = max_in + max_out

    def g(expr, cond=None):
        return F.when(ok & cond, expr) if cond is not None else F.when(ok, expr)

    has_dur = dur != 0
    has_cost = core_cost != 0
    has_mem = mem_sum != 0
    return [
        g(parallel_work).alias("parallel_work"),
        g(parallel_part).alias("parallel_part"),
        g(seq_part).alias("seq_part"),
        g(est_seq).alias("est_seq_time"),
        g(core_cost).alias("core_cost"),
        g(F.coalesce(F.col("stages_overlap"), F.lit(False))).alias("stages_in_parallel"),
        g(F.col("stages_x_duration_sum")).alias("stages_sum"),
        g(millis_between("stages_completionTime_max", "stages_firstTaskLaunchedTime_min")).alias("stages_interval"),
        g(hdfs_blocks(max_in)).alias("stages_max_input_blocks"),
        g(hdfs_blocks(F.col("executors_totalInputBytes_sum"))).alias("executors_total_input_blocks"),
        g(mem_sum - max_in).alias("unused_storage_memory"),
        g(F.try_divide(est_seq.cast("double"), dur), has_dur).alias("estimated_speedup"),
        g(F.try_divide(parallel_part.cast("double"), dur), has_dur).alias("parallel_fraction"),
        g(F.try_divide(seq_part.cast("double"), dur), has_dur).alias("seq_fraction"),
        g(F.try_divide(hdfs_blocks(max_in).cast("double"), dur), has_dur).alias("average_throughput"),
        g(F.try_divide(parallel_work.cast("double"), core_cost), has_cost).alias("estimated_core_efficiency"),
        g(core_cost - parallel_work, has_cost).alias("unused_core_cost"),
        g((core_cost - parallel_work) / F.lit(3600000.0), has_cost).alias("x_unused_core_cost_hours"),
        g(peak, has_mem).alias("est_peak_memory_usage"),
        g(F.try_divide(peak.cast("double"), mem_sum), has_mem).alias("storage_memory_usage"),
        g(mem_sum - peak, has_mem).alias("x_unused_storage_memory_bytes"),
    ]


SUMMARY_FIELDS = [
    "parallel_work", "parallel_part", "seq_part", "est_seq_time", "core_cost", "stages_in_parallel",
    "stages_sum", "stages_interval", "stages_max_input_blocks", "executors_total_input_blocks",
    "unused_storage_memory", "estimated_speedup", "parallel_fraction", "seq_fraction", "average_throughput",
    "estimated_core_efficiency", "unused_core_cost", "x_unused_core_cost_hours", "est_peak_memory_usage",
    "storage_memory_usage", "x_unused_storage_memory_bytes",
]


def attempt_report(
    attempts: DataFrame,
    executors: DataFrame,
    stages: DataFrame,
    keys: list[str] = KEYS,
    nunique: str = "exact",
    parallelism: bool = True,
) -> DataFrame:
    """One row per attempt with executor aggregates (driver split off),
    stage aggregates, interval union and the summary metrics.

    Executors and stages are each aggregated to one row per attempt before
    any join, so the joins see attempt-sized inputs only.  With ``parallelism=False`` the interval union is
    skipped (its fields, and the summary fields derived from it, are NULL)
    for consumers that read only sizes and costs: a joined-in result is
    computed even when unread.
    """
    ex_metrics = executor_metrics(executors, attempts, keys)
    ex_aggs = executor_aggregate(ex_metrics, keys, nunique=nunique)
    st_aggs = stage_aggregate(stages, keys, nunique=nunique)
    joined = attempts.join(ex_aggs, keys, "left").join(st_aggs, keys, "left")
    if parallelism:
        par = interval_union(
            stages, keys, "firstTaskLaunchedTime", "completionTime", covered_col="stages_union_ms",
            overlap_col="stages_overlap",
        )
        joined = joined.join(par, keys, "left")
    else:
        joined = joined.withColumn("stages_union_ms", F.lit(None).cast("bigint")).withColumn(
            "stages_overlap", F.lit(None).cast("boolean")
        )
    return joined.select("*", *summary_columns())


def attempt_summary(attempts: DataFrame, executors: DataFrame, stages: DataFrame, keys: list[str] = KEYS,
                    parallelism: bool = True) -> DataFrame:
    """The summary block of ``attempt_report`` only (keys + M4-M8 fields).

    Column pruning removes every aggregate the summary does not read, and
    no distinct counts are computed, so this is much cheaper than the full
    report.  ``parallelism=False`` leaves out the interval union for callers
    that read no field derived from it.
    """
    return attempt_report(attempts, executors, stages, keys, nunique="none", parallelism=parallelism).select(*keys, *SUMMARY_FIELDS)
