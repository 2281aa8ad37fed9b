"""Queries: type-directed aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.operators import metrics as M
from runlens.operators.typed_agg import (
    EXTRA_NUMERIC_AGGS,
    EXTRA_STRING_AGGS,
    concat_first_seen,
    executor_aggregate,
    typed_aggregate,
    typed_aggregate_long,
)
from runlens.plans import views as V
from runlens.plans.catalog import register
from runlens.plans.oracle_views import r4
from runlens.plans.q_core import EX_SQL, ST_SQL, SUMMARY_SQL

K = ["app_id", "attempt_id"]

# Column kinds of the aggregated frames, in schema order (used to write the
# oracle SQL; the Spark side derives the same list from df.schema).
STAGE_COLS = [
    ("stageId", "int"), ("attemptId", "int"), ("submissionTime", "ts"), ("firstTaskLaunchedTime", "ts"),
    ("completionTime", "ts"), ("inputBytes", "bigint"), ("inputRecords", "bigint"), ("outputBytes", "bigint"),
    ("executorCpuTime", "bigint"), ("numCompleteTasks", "int"), ("x_scheduling_overhead", "bigint"),
    ("x_duration", "bigint"), ("x_executorCpuTime_ms", "double"), ("throughput_bytes", "double"),
    ("throughput_records", "double"), ("x_average_task_input_bytes", "double"),
    ("x_average_task_output_bytes", "double"),
]
EXECUTOR_COLS = [
    ("totalCores", "int"), ("maxMemory", "bigint"), ("totalDuration", "bigint"), ("totalInputBytes", "bigint"),
    ("addTime", "ts"), ("removeTime", "ts"), ("isExcluded", "bool"), ("failedTasks", "int"),
    ("x_startTime", "ts"), ("x_stopTime", "ts"), ("x_durationMilliseconds", "bigint"), ("x_durationHours", "double"),
    ("x_coreCost", "bigint"), ("x_storageCost", "double"), ("x_coreCost_hours", "double"),
    ("x_storageCost_GbHours", "double"),
]
RAW_EXECUTOR_COLS = EXECUTOR_COLS[:8]

NUM_AGGS = ["min", "max", "sum", "mean", "nunique", "count_zeroes", "count_not_null"]
DECIMAL_AGGS = [a for a in NUM_AGGS if a != "mean"]  # the engines type the mean of a decimal differently


def _sql_agg(col: str, kind: str, agg: str, where: str | None = None) -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    c = f'"{col}"'
    if kind == "ts":
        return {"min": f"min({c}){f}", "max": f"max({c}){f}"}[agg]
    present = f"count({c}){f} > 0"
    if kind == "bool":
        return {
            "any": f"bool_or({c}){f}",
            "all": f"bool_and({c}){f}",
            "sum": f"CASE WHEN {present} THEN CAST(count(CASE WHEN {c} THEN 1 END){f} AS BIGINT) END",
        }[agg]
    if agg == "min" or agg == "max":
        e = f"{agg}({c}){f}"
        return r4(e) if kind == "double" else f"CAST({e} AS VARCHAR)" if kind == "decimal" else e
    if agg == "sum":
        return r4(f"sum({c}){f}") if kind == "double" else f"CAST(sum({c}){f} AS VARCHAR)" if kind == "decimal" else f"CAST(sum({c}){f} AS BIGINT)"
    if agg == "mean":
        return r4(f"avg({c}){f}")
    if agg == "nunique":
        return f"CASE WHEN {present} THEN CAST(count(DISTINCT {c}){f} AS BIGINT) END"
    if agg == "count_zeroes":
        return f"CASE WHEN {present} THEN CAST(count(CASE WHEN {c} = 0 THEN 1 END){f} AS BIGINT) END"
    if agg == "count_not_null":
        return f"CASE WHEN {present} THEN CAST(count({c}){f} AS BIGINT) END"
    raise ValueError(agg)


def _aggs_for(kind: str) -> list[str]:
    return {"ts": ["min", "max"], "bool": ["any", "all", "sum"], "decimal": DECIMAL_AGGS}.get(kind, NUM_AGGS)


def typed_sql(cols, prefix: str = "", where: str | None = None, only: set[str] | None = None) -> str:
    parts = []
    for name, kind in cols:
        for agg in _aggs_for(kind):
            if only is None or agg in only:
                parts.append(f'{_sql_agg(name, kind, agg, where)} AS "{prefix}{name}_{agg}"')
    return ",\n  ".join(parts)


def _names(cols, prefix: str = "", only: set[str] | None = None) -> list[str]:
    return [f"{prefix}{n}_{a}" for n, k in cols for a in _aggs_for(k) if only is None or a in only]


def _stage_aggs(spark, sf_dir, nunique="exact"):
    return M.stage_aggregate(V.stages_v(spark, sf_dir), K, nunique=nunique)


def _executor_aggs(spark, sf_dir, nunique="exact"):
    runs, ex = V.runs_v(spark, sf_dir), V.executors_v(spark, sf_dir)
    return executor_aggregate(M.executor_metrics(ex, runs, K).drop("hostPort"), K, nunique=nunique)


STAGE_AGGS_SQL = f"""WITH {ST_SQL},
st2 AS (
  SELECT *, CASE WHEN complete THEN f_ms - epoch_ms(submissionTime) ELSE 0 END AS x_scheduling_overhead,
         executorCpuTime / 1e6 AS x_executorCpuTime_ms,
         CASE WHEN complete THEN CASE WHEN x_duration <> 0 THEN inputBytes / x_duration END ELSE -1.0 END
           AS throughput_bytes,
         CASE WHEN complete THEN CASE WHEN x_duration <> 0 THEN inputRecords / x_duration END ELSE -1.0 END
           AS throughput_records,
         CASE WHEN numCompleteTasks <> 0 THEN inputBytes / numCompleteTasks END AS x_average_task_input_bytes,
         CASE WHEN numCompleteTasks <> 0 THEN outputBytes / numCompleteTasks END AS x_average_task_output_bytes
  FROM st
)"""


STAGES_SQL = f"""{STAGE_AGGS_SQL}
SELECT app_id, attempt_id, count(*) AS stages_elements_count,
  {typed_sql(STAGE_COLS, "stages_")}
FROM st2 GROUP BY app_id, attempt_id"""


@register("stage_aggs", STAGES_SQL)
def stage_aggs(spark, sf_dir):
    """M2 stage metrics, then every numeric/time column aggregated by type."""
    return _stage_aggs(spark, sf_dir)


EXEC_AGGS_SQL = f"""WITH {EX_SQL},
ex2 AS (
  SELECT *, x_ms AS x_durationMilliseconds, x_ms / 3600000.0 AS x_durationHours, totalCores * x_ms AS x_coreCost,
         maxMemory / 1073741824.0 * x_ms AS x_storageCost, totalCores * (x_ms / 3600000.0) AS x_coreCost_hours,
         maxMemory / 1073741824.0 * (x_ms / 3600000.0) AS x_storageCost_GbHours
  FROM ex
)"""


EXECUTOR_AGGS_SQL = f"""{EXEC_AGGS_SQL}
SELECT app_id, attempt_id,
  CAST(count(*) FILTER (WHERE id <> 'driver') AS BIGINT) AS executors_elements_count,
  {typed_sql(EXECUTOR_COLS, "executors_", where="id <> 'driver'")},
  arg_max(totalCores, {{'a': addTime, 'b': id, 'c': totalCores, 'd': maxMemory, 'e': totalDuration, 'f': totalInputBytes}}) FILTER (WHERE id = 'driver') AS driver_totalCores,
  arg_max(maxMemory, {{'a': addTime, 'b': id, 'c': totalCores, 'd': maxMemory, 'e': totalDuration, 'f': totalInputBytes}}) FILTER (WHERE id = 'driver') AS driver_maxMemory,
  arg_max(x_coreCost, {{'a': addTime, 'b': id, 'c': totalCores, 'd': maxMemory, 'e': totalDuration, 'f': totalInputBytes}}) FILTER (WHERE id = 'driver') AS driver_x_coreCost
FROM ex2 GROUP BY app_id, attempt_id"""


@register("executor_aggs", EXECUTOR_AGGS_SQL)
def executor_aggs(spark, sf_dir):
    """A10: driver split off (last one wins) + typed aggregates of the other executors."""
    df = _executor_aggs(spark, sf_dir)
    return df.select(
        *[c for c in df.columns if c != "driver"],
        F.col("driver.totalCores").alias("driver_totalCores"),
        F.col("driver.maxMemory").alias("driver_maxMemory"),
        F.col("driver.x_coreCost").alias("driver_x_coreCost"),
    )


# raw executors with a nested struct and a decimal, for the type-directed form
NESTED_COLS = [*RAW_EXECUTOR_COLS, ("memoryMetrics.usedOnHeapStorageMemory", "bigint"),
               ("memoryMetrics.peak.ratio", "double"), ("charge", "decimal")]


@register(
    "agg_typed_wide",
    f"""WITH nested AS (
  SELECT *, maxMemory // 3 AS "memoryMetrics.usedOnHeapStorageMemory", totalDuration / 1000.0 AS "memoryMetrics.peak.ratio",
         CAST('90071992547409930.0' || CAST(failedTasks AS VARCHAR) AS DECIMAL(20,2)) AS charge FROM executors_v)
SELECT app_id, attempt_id, count(*) AS elements_count,
  {typed_sql(NESTED_COLS)}
FROM nested GROUP BY app_id, attempt_id""",
)
def agg_typed_wide(spark, sf_dir):
    """A1: generic type-directed aggregation of raw executors per attempt
    (wide), with nested structs and a decimal whose values are too close for
    a DOUBLE."""
    ex = V.executors_v(spark, sf_dir).drop("id", "hostPort")
    nested = ex.withColumns({
        "memoryMetrics": F.struct(F.expr("maxMemory div 3").alias("usedOnHeapStorageMemory"),
                                  F.struct((F.col("totalDuration") / 1000.0).alias("ratio")).alias("peak")),
        "charge": F.concat(F.lit("90071992547409930.0"), F.col("failedTasks").cast("string")).cast("decimal(20,2)")})
    # decimals as text: every digit is compared
    exact = {f"charge_{a}": F.col(f"charge_{a}").cast("string") for a in ("min", "max", "sum")}
    return typed_aggregate(nested, K).drop("charge_mean").withColumns(exact)


def _long_sql(cols, entity: str, source: str) -> str:
    branches = [f"SELECT app_id, attempt_id, '{entity}' AS entity, 'elements_count' AS field, 'count' AS agg, "
                f"CAST(elements_count AS DOUBLE) AS value FROM {source}"]
    for name, kind in cols:
        for agg in _aggs_for(kind):
            col = f"{name}_{agg}"
            if kind == "ts":
                v = f"CAST(epoch_ms({col}) AS DOUBLE)"
            elif kind == "bool" and agg != "sum":
                v = f"CAST(CAST({col} AS INTEGER) AS DOUBLE)"
            else:
                v = f"CAST({col} AS DOUBLE)"
            branches.append(
                f"SELECT app_id, attempt_id, '{entity}', '{name}', '{agg}', {r4(v)} FROM {source} WHERE {col} IS NOT NULL"
            )
    return "\nUNION ALL ".join(branches)


@register(
    "agg_typed_long",
    f"""WITH w AS (SELECT app_id, attempt_id, count(*) AS elements_count,
  {typed_sql(RAW_EXECUTOR_COLS)}
FROM executors_v GROUP BY app_id, attempt_id)
{_long_sql(RAW_EXECUTOR_COLS, "executors", "w")}""",
)
def agg_typed_long(spark, sf_dir):
    """A1 long form: (keys, entity, field, agg, value) rows of the wide result."""
    wide = typed_aggregate(V.executors_v(spark, sf_dir).drop("id", "hostPort"), K)
    return typed_aggregate_long(wide, K, "executors")


def _register_projection(key: str, doc: str, only: set[str], kinds: set[str], source: str = "stages"):
    cols = [c for c in (STAGE_COLS if source == "stages" else EXECUTOR_COLS) if c[1] in kinds]
    prefix = f"{source}_"
    base_sql = STAGE_AGGS_SQL if source == "stages" else EXEC_AGGS_SQL
    frame = "st2" if source == "stages" else "ex2"
    where = None if source == "stages" else "id <> 'driver'"
    sql = f"""{base_sql}
SELECT app_id, attempt_id, {typed_sql(cols, prefix, where=where, only=only)}
FROM {frame} GROUP BY app_id, attempt_id"""

    # distinct counts only when selected: a join to them is not pruned away
    nunique = "exact" if "nunique" in only else "none"

    def q(spark, sf_dir):
        df = _stage_aggs(spark, sf_dir, nunique) if source == "stages" else _executor_aggs(spark, sf_dir, nunique)
        return df.select(*K, *_names(cols, prefix, only))

    q.__doc__ = doc
    register(key, sql)(q)


NUMERIC_KINDS = {"int", "bigint", "double"}
_register_projection("agg_nunique", "A3: distinct non-null values per numeric stage column.", {"nunique"}, NUMERIC_KINDS)
_register_projection("agg_count_zeroes", "A4: zero values per numeric stage column.", {"count_zeroes"}, NUMERIC_KINDS)
_register_projection(
    "agg_count_not_null", "A5: non-null values per numeric stage column.", {"count_not_null"}, NUMERIC_KINDS
)
_register_projection("agg_time_bounds", "A6: first and last time per time column.", {"min", "max"}, {"ts"})
_register_projection("agg_bool", "A7: any/all/count of boolean executor columns.", {"any", "all", "sum"}, {"bool"}, "executors")


@register(
    "agg_rsd",
    f"""{STAGE_AGGS_SQL}
SELECT app_id, attempt_id,
  {r4("CASE WHEN avg(inputBytes) <> 0 THEN stddev_samp(inputBytes) / abs(avg(inputBytes)) END")} AS inputBytes_rsd,
  {r4("CASE WHEN avg(x_duration) <> 0 THEN stddev_samp(x_duration) / abs(avg(x_duration)) END")} AS x_duration_rsd,
  {r4("CASE WHEN avg(throughput_bytes) <> 0 THEN stddev_samp(throughput_bytes) / abs(avg(throughput_bytes)) END")}
    AS throughput_bytes_rsd
FROM st2 GROUP BY app_id, attempt_id""",
)
def agg_rsd(spark, sf_dir):
    """Relative standard deviation (NULL when the mean is 0 or one value)."""
    st = M.stage_metrics(V.stages_v(spark, sf_dir)).select(*K, "inputBytes", "x_duration", "throughput_bytes")
    return typed_aggregate(st, K, type_aggs=[((T.NumericType,), EXTRA_NUMERIC_AGGS)]).drop("elements_count")


@register(
    "agg_concat_unique",
    """SELECT app_id, attempt_id, string_agg(DISTINCT id, '|' ORDER BY id) AS id_concat_unique,
  CAST(count(id) AS BIGINT) AS id_count_not_null
FROM executors_v GROUP BY app_id, attempt_id""",
)
def agg_concat_unique(spark, sf_dir):
    """Unique executor ids joined with '|' (sorted), and the non-null count."""
    ex = V.executors_v(spark, sf_dir).select(*K, "id")
    return typed_aggregate(ex, K, type_aggs=[((T.StringType,), EXTRA_STRING_AGGS)]).drop("elements_count")


@register(
    "agg_concat_first_seen",
    """SELECT app_id, attempt_id, string_agg(id, '|' ORDER BY pos, id) AS id_concat_unique
FROM (SELECT app_id, attempt_id, id, min(maxMemory) AS pos FROM executors_v GROUP BY ALL) GROUP BY app_id, attempt_id""",
)
def agg_concat_first_seen(spark, sf_dir):
    """Unique executor ids joined with '|' in first-seen order (position:
    the memory, which numbers the rows of an attempt)."""
    return concat_first_seen(V.executors_v(spark, sf_dir), K, "id", F.col("maxMemory"))


@register(
    "attempt_report",
    f"""WITH s AS ({SUMMARY_SQL}),
e AS ({EXECUTOR_AGGS_SQL}),
t AS ({STAGES_SQL}),
d AS (SELECT app_id, attempt_id, count(*) FILTER (WHERE id = 'driver') > 0 AS has_driver FROM executors_v GROUP BY ALL)
SELECT r.app_id, r.attempt_id, r.name, r.duration, coalesce(d.has_driver, false) AS has_driver,
       e.* EXCLUDE (app_id, attempt_id), t.* EXCLUDE (app_id, attempt_id), s.* EXCLUDE (app_id, attempt_id)
FROM runs_v r
LEFT JOIN d ON d.app_id = r.app_id AND d.attempt_id = r.attempt_id
LEFT JOIN e ON e.app_id = r.app_id AND e.attempt_id = r.attempt_id
LEFT JOIN t ON t.app_id = r.app_id AND t.attempt_id = r.attempt_id
LEFT JOIN s ON s.app_id = r.app_id AND s.attempt_id = r.attempt_id""",
)
def attempt_report(spark, sf_dir):
    """Attempt row, every executor and stage aggregate, and the summary."""
    runs, ex, st = V.runs_v(spark, sf_dir), V.executors_v(spark, sf_dir), V.stages_v(spark, sf_dir)
    rep = M.attempt_report(runs.select(*K, "name", "startTime", "endTime", "duration"), ex.drop("hostPort"), st)
    aggs = [c for c in rep.columns if c.startswith(("executors_", "stages_")) and c not in ("stages_union_ms", "stages_overlap")
            and c not in M.SUMMARY_FIELDS]
    return rep.select(
        *K, "name", "duration", F.col("driver").isNotNull().alias("has_driver"), *aggs,
        F.col("driver.totalCores").alias("driver_totalCores"), F.col("driver.maxMemory").alias("driver_maxMemory"),
        F.col("driver.x_coreCost").alias("driver_x_coreCost"), *M.SUMMARY_FIELDS,
    )
