"""Queries: run metrics, typed aggregation, interval union, summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import metrics as M
from runlens.operators.intervals import interval_union
from runlens.plans import views as V
from runlens.plans.catalog import register
from runlens.plans.oracle_views import r4

K = ["app_id", "attempt_id"]

# --------------------------------------------------------------------------
# shared oracle fragments
# --------------------------------------------------------------------------

EX_SQL = """
ex AS (
  SELECT e.*, coalesce(e.addTime, r.startTime) AS x_startTime, coalesce(e.removeTime, r.endTime) AS x_stopTime,
         epoch_ms(coalesce(e.removeTime, r.endTime)) - epoch_ms(coalesce(e.addTime, r.startTime)) AS x_ms
  FROM executors_v e LEFT JOIN runs_v r USING (app_id, attempt_id)
)"""

ST_SQL = """
st AS (
  SELECT s.*, completionTime IS NOT NULL AND firstTaskLaunchedTime IS NOT NULL AS complete,
         epoch_ms(firstTaskLaunchedTime) AS f_ms, epoch_ms(completionTime) AS c_ms,
         CASE WHEN completionTime IS NOT NULL AND firstTaskLaunchedTime IS NOT NULL
              THEN epoch_ms(completionTime) - epoch_ms(firstTaskLaunchedTime) ELSE 0 END AS x_duration
  FROM stages_v s
)"""

# Interval union by islands (an independent formulation from the library's).
PAR_SQL = """
iv AS (
  SELECT app_id, attempt_id, f_ms AS s, c_ms AS e,
         max(c_ms) OVER (PARTITION BY app_id, attempt_id ORDER BY f_ms, c_ms
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe
  FROM st WHERE f_ms IS NOT NULL AND c_ms IS NOT NULL
), isl AS (
  SELECT *, sum(CASE WHEN pe IS NULL OR s >= pe THEN 1 ELSE 0 END)
            OVER (PARTITION BY app_id, attempt_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM iv
), par AS (
  SELECT app_id, attempt_id, CAST(sum(len) AS BIGINT) AS parallel_part, bool_or(ovl) AS stages_in_parallel
  FROM (SELECT app_id, attempt_id, island, max(e) - min(s) AS len, count_if(pe IS NOT NULL AND s < pe) > 0 AS ovl
        FROM isl GROUP BY ALL)
  GROUP BY ALL
)"""

SUMMARY_SQL = f"""
WITH {EX_SQL}, {ST_SQL}, {PAR_SQL},
ex_agg AS (
  SELECT app_id, attempt_id,
         count(*) FILTER (WHERE id <> 'driver') AS n_ex,
         CAST(sum(totalDuration) FILTER (WHERE id <> 'driver') AS BIGINT) AS work,
         CAST(sum(totalCores * x_ms) FILTER (WHERE id <> 'driver') AS BIGINT) AS cost,
         CAST(sum(totalInputBytes) FILTER (WHERE id <> 'driver') AS BIGINT) AS in_sum,
         CAST(sum(maxMemory) FILTER (WHERE id <> 'driver') AS BIGINT) AS mem
  FROM ex GROUP BY ALL
), st_agg AS (
  SELECT app_id, attempt_id, count(*) AS n_st, CAST(sum(x_duration) AS BIGINT) AS stages_sum,
         min(f_ms) AS fmin, max(c_ms) AS cmax, max(inputBytes) AS in_max, max(outputBytes) AS out_max
  FROM st GROUP BY ALL
), j AS (
  SELECT r.app_id, r.attempt_id, r.duration AS d, x.*, s.*, coalesce(p.parallel_part, 0) AS pp,
         coalesce(p.stages_in_parallel, false) AS sip,
         coalesce(x.n_ex, 0) > 0 AND coalesce(s.n_st, 0) > 0 AND s.fmin IS NOT NULL AND s.cmax IS NOT NULL AS ok
  FROM runs_v r
  LEFT JOIN ex_agg x ON x.app_id = r.app_id AND x.attempt_id = r.attempt_id
  LEFT JOIN st_agg s ON s.app_id = r.app_id AND s.attempt_id = r.attempt_id
  LEFT JOIN par p ON p.app_id = r.app_id AND p.attempt_id = r.attempt_id
)
SELECT app_id, attempt_id,
  CASE WHEN ok THEN work END AS parallel_work,
  CASE WHEN ok THEN pp END AS parallel_part,
  CASE WHEN ok THEN d - pp END AS seq_part,
  CASE WHEN ok THEN d - pp + work END AS est_seq_time,
  CASE WHEN ok THEN cost END AS core_cost,
  CASE WHEN ok THEN sip END AS stages_in_parallel,
  CASE WHEN ok THEN stages_sum END AS stages_sum,
  CASE WHEN ok THEN cmax - fmin END AS stages_interval,
  CASE WHEN ok THEN CAST(ceil(in_max / 134217728.0) AS BIGINT) END AS stages_max_input_blocks,
  CASE WHEN ok THEN CAST(ceil(in_sum / 134217728.0) AS BIGINT) END AS executors_total_input_blocks,
  CASE WHEN ok THEN mem - in_max END AS unused_storage_memory,
  CASE WHEN ok AND d <> 0 THEN {r4("(d - pp + work) / d")} END AS estimated_speedup,
  CASE WHEN ok AND d <> 0 THEN {r4("pp / d")} END AS parallel_fraction,
  CASE WHEN ok AND d <> 0 THEN {r4("(d - pp) / d")} END AS seq_fraction,
  CASE WHEN ok AND d <> 0 THEN {r4("ceil(in_max / 134217728.0) / d")} END AS average_throughput,
  CASE WHEN ok AND cost <> 0 THEN {r4("work / cost")} END AS estimated_core_efficiency,
  CASE WHEN ok AND cost <> 0 THEN cost - work END AS unused_core_cost,
  CASE WHEN ok AND cost <> 0 THEN {r4("(cost - work) / 3600000.0")} END AS x_unused_core_cost_hours,
  CASE WHEN ok AND mem <> 0 THEN in_max + out_max END AS est_peak_memory_usage,
  CASE WHEN ok AND mem <> 0 THEN {r4("(in_max + out_max) / mem")} END AS storage_memory_usage,
  CASE WHEN ok AND mem <> 0 THEN mem - (in_max + out_max) END AS x_unused_storage_memory_bytes
FROM j
"""


def _inputs(spark, sf_dir):
    return V.runs_v(spark, sf_dir), V.executors_v(spark, sf_dir), V.stages_v(spark, sf_dir)


@register("attempt_summary", SUMMARY_SQL)
def attempt_summary(spark, sf_dir):
    """M3-M8: per attempt work, parallel part, cost, speed-up, efficiency, memory."""
    runs, ex, st = _inputs(spark, sf_dir)
    return M.attempt_summary(runs, ex, st)


@register(
    "speedup_ratios",
    f"SELECT app_id, attempt_id, estimated_speedup, parallel_fraction, seq_fraction, average_throughput "
    f"FROM ({SUMMARY_SQL}) WHERE estimated_speedup IS NOT NULL",
)
def speedup_ratios(spark, sf_dir):
    """M7: speed-up and fractions for attempts with a summary and a duration."""
    df = attempt_summary(spark, sf_dir)
    return df.where(F.col("estimated_speedup").isNotNull()).select(
        *K, "estimated_speedup", "parallel_fraction", "seq_fraction", "average_throughput"
    )


@register(
    "core_efficiency",
    f"SELECT app_id, attempt_id, core_cost, estimated_core_efficiency, unused_core_cost, x_unused_core_cost_hours "
    f"FROM ({SUMMARY_SQL}) WHERE estimated_core_efficiency IS NOT NULL",
)
def core_efficiency(spark, sf_dir):
    """M5: core cost and efficiency (no field of the interval union is read)."""
    df = M.attempt_summary(V.runs_v(spark, sf_dir), V.executors_v(spark, sf_dir), V.stages_v(spark, sf_dir), parallelism=False)
    return df.where(F.col("estimated_core_efficiency").isNotNull()).select(
        *K, "core_cost", "estimated_core_efficiency", "unused_core_cost", "x_unused_core_cost_hours"
    )


@register(
    "memory_usage",
    f"SELECT app_id, attempt_id, est_peak_memory_usage, storage_memory_usage, x_unused_storage_memory_bytes, "
    f"unused_storage_memory FROM ({SUMMARY_SQL}) WHERE est_peak_memory_usage IS NOT NULL",
)
def memory_usage(spark, sf_dir):
    """M6/M8: peak memory estimate and storage memory use (no interval union)."""
    df = M.attempt_summary(V.runs_v(spark, sf_dir), V.executors_v(spark, sf_dir), V.stages_v(spark, sf_dir), parallelism=False)
    return df.where(F.col("est_peak_memory_usage").isNotNull()).select(
        *K, "est_peak_memory_usage", "storage_memory_usage", "x_unused_storage_memory_bytes", "unused_storage_memory"
    )


@register(
    "interval_union",
    f"WITH {ST_SQL}, {PAR_SQL} SELECT * FROM par",
)
def q_interval_union(spark, sf_dir):
    """Covered ms of the union of stage intervals and the overlap flag."""
    return interval_union(V.stages_v(spark, sf_dir), K, "firstTaskLaunchedTime", "completionTime")


@register(
    "executor_metrics",
    f"""WITH {EX_SQL}
SELECT app_id, attempt_id, id, x_startTime, x_stopTime, x_ms AS x_durationMilliseconds,
       {r4("x_ms / 3600000.0")} AS x_durationHours, totalCores * x_ms AS x_coreCost,
       {r4("maxMemory / 1073741824.0 * x_ms")} AS x_storageCost,
       {r4("totalCores * (x_ms / 3600000.0)")} AS x_coreCost_hours,
       {r4("maxMemory / 1073741824.0 * (x_ms / 3600000.0)")} AS x_storageCost_GbHours
FROM ex""",
)
def q_executor_metrics(spark, sf_dir):
    """M1: executor lifetime (attempt bounds as defaults), core and storage cost."""
    runs, ex, _ = _inputs(spark, sf_dir)
    return M.executor_metrics(ex, runs).select(
        *K, "id", "x_startTime", "x_stopTime", "x_durationMilliseconds", "x_durationHours", "x_coreCost",
        "x_storageCost", "x_coreCost_hours", "x_storageCost_GbHours",
    )


@register(
    "stage_metrics",
    f"""WITH {ST_SQL}
SELECT app_id, attempt_id, stageId,
       CASE WHEN complete THEN f_ms - epoch_ms(submissionTime) ELSE 0 END AS x_scheduling_overhead,
       x_duration,
       {r4("executorCpuTime / 1e6")} AS x_executorCpuTime_ms,
       {r4("CASE WHEN complete THEN CASE WHEN x_duration <> 0 THEN inputBytes / x_duration END ELSE -1.0 END")}
         AS throughput_bytes,
       {r4("CASE WHEN complete THEN CASE WHEN x_duration <> 0 THEN inputRecords / x_duration END ELSE -1.0 END")}
         AS throughput_records,
       {r4("CASE WHEN numCompleteTasks <> 0 THEN inputBytes / numCompleteTasks END")} AS x_average_task_input_bytes,
       {r4("CASE WHEN numCompleteTasks <> 0 THEN outputBytes / numCompleteTasks END")} AS x_average_task_output_bytes
FROM st""",
)
def q_stage_metrics(spark, sf_dir):
    """M2: per-stage overhead, duration, throughput, CPU ms, per-task sizes."""
    return M.stage_metrics(V.stages_v(spark, sf_dir)).select(
        *K, "stageId", "x_scheduling_overhead", "x_duration", "x_executorCpuTime_ms", "throughput_bytes",
        "throughput_records", "x_average_task_input_bytes", "x_average_task_output_bytes",
    )
