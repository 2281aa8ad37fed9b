"""Queries: dashboards (K6, K8-K12, W4) and error routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.functions import parse_gmt
from runlens.operators import alerts as AL
from runlens.operators import classify as C
from runlens.operators import cleanse as P
from runlens.operators import errors as ER
from runlens.operators import metrics as M
from runlens.operators.intervals import concurrent_level, level_time
from runlens.operators.typed_agg import executor_aggregate
from runlens.plans import views as V
from runlens.plans.catalog import register
from runlens.plans.oracle_views import r4
from runlens.plans.q_core import EX_SQL, SUMMARY_SQL
from runlens.plans.q_docs import cls_sql

K = ["app_id", "attempt_id"]
MIB = 1048576


def _summary(spark, sf_dir):
    runs, ex, st = V.runs_v(spark, sf_dir), V.executors_v(spark, sf_dir), V.stages_v(spark, sf_dir)
    return M.attempt_summary(runs, ex, st)


@register(
    "hist_duration",
    "SELECT floor(duration / 60000.0) * 60000.0 AS bucket, count(*) AS n FROM runs_v WHERE duration <= 1500000 GROUP BY 1",
)
def hist_duration(spark, sf_dir):
    """K6: run durations in 1-minute buckets up to 25 minutes."""
    return AL.histogram(V.runs_v(spark, sf_dir), "duration", 60000.0, cap=1500000)


@register(
    "hist_input_bytes",
    f"""SELECT floor(s / {64.0 * MIB}) * {64.0 * MIB} AS bucket, count(*) AS n
FROM (SELECT app_id, attempt_id, sum(inputBytes) AS s FROM stages_v GROUP BY ALL) WHERE s <= {512 * MIB} GROUP BY 1""",
)
def hist_input_bytes(spark, sf_dir):
    """K6: input bytes per run in 64 MiB buckets up to 512 MiB."""
    per_run = V.stages_v(spark, sf_dir).groupBy(*K).agg(F.sum("inputBytes").alias("s"))
    return AL.histogram(per_run, "s", 64.0 * MIB, cap=512 * MIB)


@register(
    "hist_zero_executors",
    """SELECT floor(z / 1.0) * 1.0 AS bucket, count(*) AS n FROM (
  SELECT app_id, attempt_id, count(*) FILTER (WHERE failedTasks = 0 AND id <> 'driver') AS z
  FROM executors_v GROUP BY ALL HAVING count(*) FILTER (WHERE id <> 'driver') > 0) GROUP BY 1""",
)
def hist_zero_executors(spark, sf_dir):
    """K8: runs by their number of executors with zero failed tasks (A4 then K6)."""
    agg = executor_aggregate(V.executors_v(spark, sf_dir).select(*K, "id", "failedTasks"), K, order_col="failedTasks",
                             nunique="none")
    agg = agg.where(F.col("executors_elements_count") > 0)
    return AL.histogram(agg, "executors_failedTasks_count_zeroes", 1.0)


_DYN = """dyn AS (SELECT app_id, attempt_id, arg_max(value, pos) AS v FROM props_v
             WHERE key = 'spark.dynamicAllocation.enabled' GROUP BY ALL),
exs AS (SELECT app_id, attempt_id, sum(totalInputBytes) FILTER (WHERE id <> 'driver') AS input_bytes,
               sum(totalCores) FILTER (WHERE id <> 'driver') AS cores FROM executors_v GROUP BY ALL)"""


@register(
    "alloc_comparison",
    f"""WITH {_DYN}
SELECT CASE WHEN lower(dyn.v) IN ('true','1','y','yes') THEN true WHEN lower(dyn.v) IN ('false','0','n','no') THEN false END
         AS dynamic_allocation,
       CAST(floor(exs.input_bytes / {256.0 * MIB}) AS BIGINT) AS input_bucket, count(*) AS n_runs,
       {r4('avg(r.duration)')} AS avg_duration_ms, {r4('avg(exs.cores)')} AS avg_cores
FROM runs_v r JOIN dyn USING (app_id, attempt_id) JOIN exs USING (app_id, attempt_id)
WHERE exs.input_bytes IS NOT NULL GROUP BY ALL""",
)
def alloc_comparison(spark, sf_dir):
    """K9: fixed vs dynamic allocation: runs, mean duration and cores per input-size bucket."""
    env = P.clean_environment(V.env_v(spark, sf_dir), typed_keys=["spark_dynamicAllocation_enabled"]).select(
        *K, F.col("typedProperties.spark_dynamicAllocation_enabled").alias("dynamic_allocation")
    )
    ex = V.executors_v(spark, sf_dir).where(F.col("id") != "driver").groupBy(*K).agg(
        F.sum("totalInputBytes").alias("input_bytes"), F.sum("totalCores").alias("cores")
    )
    j = V.runs_v(spark, sf_dir).select(*K, "duration").join(env, K).join(ex, K)
    return j.groupBy("dynamic_allocation", F.floor(F.col("input_bytes") / F.lit(256.0 * MIB)).alias("input_bucket")).agg(
        F.count(F.lit(1)).alias("n_runs"), F.avg("duration").alias("avg_duration_ms"), F.avg("cores").alias("avg_cores")
    )


@register(
    "small_files",
    f"""WITH sp AS (SELECT app_id, attempt_id, arg_max(value, pos) AS v FROM props_v
            WHERE key = 'spark.sql.shuffle.partitions' GROUP BY ALL),
st AS (SELECT app_id, attempt_id, count(*) AS n_stages, sum(inputBytes) AS input_bytes, sum(outputBytes) AS output_bytes
       FROM stages_v GROUP BY ALL)
SELECT sp.v AS shuffle_partitions, CAST(floor(st.input_bytes / {256.0 * MIB}) AS BIGINT) AS input_bucket, count(*) AS n_runs,
       {r4('avg(st.n_stages)')} AS avg_output_partitions, {r4('avg(st.output_bytes)')} AS avg_output_bytes
FROM sp JOIN st USING (app_id, attempt_id) GROUP BY ALL""",
)
def small_files(spark, sf_dir):
    """Output partitions and bytes vs input size, per shuffle-partition setting."""
    env = P.clean_environment(V.env_v(spark, sf_dir), typed_keys=[]).select(
        *K, F.col("sparkProperties")["spark_sql_shuffle_partitions"].alias("shuffle_partitions")
    )
    st = V.stages_v(spark, sf_dir).groupBy(*K).agg(
        F.count(F.lit(1)).alias("n_stages"), F.sum("inputBytes").alias("input_bytes"), F.sum("outputBytes").alias("output_bytes")
    )
    j = env.join(st, K)
    return j.groupBy("shuffle_partitions", F.floor(F.col("input_bytes") / F.lit(256.0 * MIB)).alias("input_bucket")).agg(
        F.count(F.lit(1)).alias("n_runs"), F.avg("n_stages").alias("avg_output_partitions"),
        F.avg("output_bytes").alias("avg_output_bytes"),
    )


@register(
    "parallelism_by_type",
    f"""WITH s AS ({SUMMARY_SQL}), c AS (SELECT app_id, CASE WHEN is_etl AND valid THEN type ELSE 'other' END AS app_type
                                    FROM ({cls_sql('runs_v')}))
SELECT app_type, count(*) AS n_runs, {r4('avg(est_seq_time / (seq_part + parallel_part))')} AS avg_speedup,
       {r4('avg(CASE WHEN core_cost <> 0 THEN parallel_work / core_cost END)')} AS avg_efficiency,
       {r4('avg(parallel_part / (seq_part + parallel_part))')} AS avg_parallel_fraction
FROM s JOIN c USING (app_id) WHERE s.estimated_speedup IS NOT NULL GROUP BY app_type""",
)
def parallelism_by_type(spark, sf_dir):
    """Mean speed-up, core efficiency and parallel fraction per application type."""
    e = C.enrich(V.runs_v(spark, sf_dir).select("app_id", "name"))
    types = e.select("app_id", F.coalesce(F.col("classification.type"), F.lit("other")).alias("app_type"))
    s = _summary(spark, sf_dir).where(F.col("estimated_speedup").isNotNull())
    return s.join(types, "app_id").groupBy("app_type").agg(
        F.count(F.lit(1)).alias("n_runs"), F.avg("estimated_speedup").alias("avg_speedup"),
        F.avg("estimated_core_efficiency").alias("avg_efficiency"),
        F.avg("parallel_fraction").alias("avg_parallel_fraction"),
    )


@register(
    "hist_efficiency",
    f"""WITH s AS ({SUMMARY_SQL})
SELECT {r4('floor((parallel_work / core_cost) / 0.05) * 0.05')} AS bucket, count(*) AS n FROM s
WHERE estimated_core_efficiency IS NOT NULL AND parallel_work / core_cost <= 1.0 GROUP BY 1""",
)
def hist_efficiency(spark, sf_dir):
    """Core efficiency in 0.05 buckets."""
    runs, ex, st = V.runs_v(spark, sf_dir), V.executors_v(spark, sf_dir), V.stages_v(spark, sf_dir)
    return AL.histogram(M.attempt_summary(runs, ex, st, parallelism=False), "estimated_core_efficiency", 0.05, cap=1.0)


@register(
    "by_cluster",
    f"""WITH s AS ({SUMMARY_SQL})
SELECT r.host, count(*) AS n_runs, {r4('avg(s.est_seq_time / (s.seq_part + s.parallel_part))')} AS avg_speedup, CAST(sum(s.core_cost) AS BIGINT) AS core_cost
FROM runs_v r JOIN s USING (app_id, attempt_id) WHERE r.host IN ('host-1', 'host-3') GROUP BY r.host""",
)
def by_cluster(spark, sf_dir):
    """Several clusters (hosts) filtered together, compared side by side."""
    runs = V.runs_v(spark, sf_dir).where(F.col("host").isin("host-1", "host-3"))
    listed = runs.select(*K)
    # filter first: only the listed runs' executors and stages are aggregated
    s = M.attempt_summary(runs, V.executors_v(spark, sf_dir).join(listed, K, "left_semi"),
                          V.stages_v(spark, sf_dir).join(listed, K, "left_semi"))
    return runs.select(*K, "host").join(s, K).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_runs"), F.avg("estimated_speedup").alias("avg_speedup"),
        F.sum("core_cost").cast("bigint").alias("core_cost"),
    )


def _executor_spans(spark, sf_dir):
    """Non-driver executor lifetimes with their run's user (executors whose
    run is unknown are left out); one join with the runs."""
    runs = V.runs_v(spark, sf_dir).withColumn("__has_run", F.lit(True))
    ex = M.executor_metrics(V.executors_v(spark, sf_dir), runs, carry=["user", "__has_run"])
    ex = ex.where((F.col("id") != "driver") & F.col("__has_run"))
    return ex.select("user", "x_startTime", "x_stopTime", "totalCores")


@register(
    "cores_by_user_time",
    f"""WITH {EX_SQL}
SELECT r."user", date_trunc('hour', ex.x_startTime) AS hour, CAST(sum(ex.totalCores) AS BIGINT) AS cores
FROM ex JOIN runs_v r USING (app_id, attempt_id) WHERE ex.id <> 'driver' GROUP BY ALL""",
)
def cores_by_user_time(spark, sf_dir):
    """Cores of executors started per user and hour."""
    sp = _executor_spans(spark, sf_dir)
    return sp.groupBy("user", F.date_trunc("hour", "x_startTime").alias("hour")).agg(
        F.sum("totalCores").cast("bigint").alias("cores")
    )


@register(
    "concurrent_cores",
    f"""WITH {EX_SQL},
ev AS (SELECT r."user", ex.x_startTime AS t, ex.totalCores AS d FROM ex JOIN runs_v r USING (app_id, attempt_id)
       WHERE ex.id <> 'driver'
       UNION ALL SELECT r."user", ex.x_stopTime, -ex.totalCores FROM ex JOIN runs_v r USING (app_id, attempt_id)
       WHERE ex.id <> 'driver'),
n AS (SELECT "user", t, sum(d) AS d FROM ev WHERE t IS NOT NULL GROUP BY ALL)
SELECT "user", t, CAST(sum(d) OVER (PARTITION BY "user" ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
  AS level FROM n""",
)
def concurrent_cores(spark, sf_dir):
    """Cores held per user at every change point (exact concurrency)."""
    sp = _executor_spans(spark, sf_dir)
    lv = concurrent_level(sp, ["user"], "x_startTime", "x_stopTime", F.col("totalCores").cast("bigint"))
    return lv.select("user", "t", F.col("level").cast("bigint").alias("level"))


@register(
    "core_time_by_user",
    f"""WITH {EX_SQL},
sp AS (SELECT r."user", epoch_ms(ex.x_startTime) AS a, epoch_ms(ex.x_stopTime) AS b, ex.totalCores AS c
       FROM ex JOIN runs_v r USING (app_id, attempt_id) WHERE ex.id <> 'driver' AND ex.x_startTime < ex.x_stopTime)
SELECT "user", make_timestamp(h * 3600000000) AS step_start,
       CAST(sum(c * (least(b, (h + 1) * 3600000) - greatest(a, h * 3600000))) AS BIGINT) AS core_ms,
       {r4("sum(c * (least(b, (h + 1) * 3600000) - greatest(a, h * 3600000))) / 3600000.0")} AS mean_cores
FROM sp, unnest(range(a // 3600000, (b + 3599999) // 3600000)) AS u(h) GROUP BY ALL""",
)
def core_time_by_user(spark, sf_dir):
    """Core time that executors held, per user and hour (spans cut at the
    hours' borders), and the cores held on average."""
    sp = _executor_spans(spark, sf_dir)
    held = level_time(sp, ["user"], "x_startTime", "x_stopTime", F.col("totalCores").cast("bigint"), out="core_ms")
    return held.withColumn("mean_cores", F.col("core_ms") / F.lit(3600000.0))


_GMT_SQL = "'%Y-%m-%dT%H:%M:%S.%gGMT'"


_AT = "TIMESTAMP '2024-02-01 00:00:00' AS time_processed"


@register(
    "error_routing",
    f"""SELECT {_AT}, host AS history_host, id AS spark_app_id, attemptId AS attempt_id,
       'raw' AS stage, 'bad_time' AS type, 'lastUpdated: ' || lastUpdated AS message
FROM attempts_raw_v WHERE try_strptime(lastUpdated, {_GMT_SQL}) IS NULL
UNION ALL
SELECT {_AT}, host, app_id, attempt_id, 'raw', 'bad_name', 'name: ' || name
FROM ({cls_sql('runs_v')}) WHERE is_etl AND NOT valid
UNION ALL
SELECT {_AT}, host, id, coalesce(attemptId, '0'), 'raw', 'bad_property', 'spark_executor_cores: many'
FROM attempts_raw_v WHERE CAST(substr(id, 13) AS BIGINT) % 10 = 0
  AND (CAST(substr(id, 13) AS BIGINT) % 27 <> 0 OR attempt_pos = 0)
UNION ALL
SELECT {_AT}, host, app_id, attempt_id, 'aggregations', 'no_executors', 'no executors'
FROM runs_v r WHERE NOT EXISTS (SELECT 1 FROM executors_v e WHERE e.app_id = r.app_id AND e.attempt_id = r.attempt_id)""",
)
def error_routing(spark, sf_dir):
    """Rule violations routed to error documents (bad times, malformed
    ETL names, int properties that are no numbers, runs without executors),
    each with the host it came from, instead of failing the job."""
    ts = F.lit("2024-02-01 00:00:00")
    at = P.flatten_attempts(V.apps_v(spark, sf_dir)).select(
        "host", F.col("id").alias("app_id"), F.col("attempt.attemptId").alias("attempt_id"),
        F.col("attempt.lastUpdated").alias("lastUpdated"),
    )
    runs = V.runs_v(spark, sf_dir).select(*K, "name", "host")
    etl = C.enrich(runs).where("is_etl")
    pairs = P.flatten_attempts(V.landed_v(spark, sf_dir, 2)).select(
        "host", F.col("id").alias("app_id"), P.attempt_key(F.col("attempt.attemptId")).alias("attempt_id"),
        P.property_map(F.col("attempt.environment.sparkProperties")).alias("props"))
    bad = pairs.select("host", *K, F.explode(P.uncast_properties(F.col("props"))).alias("p"))
    bare = runs.join(V.executors_v(spark, sf_dir).select(*K), K, "left_anti")
    found = [
        ER.route(at, [ER.Rule("bad_time", parse_gmt("lastUpdated").isNotNull(), "raw",
                              F.concat(F.lit("lastUpdated: "), F.col("lastUpdated")))], ts, host_col="host"),
        ER.route(etl, [ER.Rule("bad_name", F.col("classification").isNotNull(), "raw",
                               F.concat(F.lit("name: "), F.col("name")))], ts, host_col="host"),
        ER.route(bad, [ER.Rule("bad_property", F.lit(False), "raw",
                               F.concat(F.col("p.key"), F.lit(": "), F.col("p.value")))], ts, host_col="host"),
        ER.route(bare, [ER.Rule("no_executors", F.lit(False), "aggregations", F.lit("no executors"))], ts, host_col="host"),
    ]
    return reduce(DataFrame.unionByName, [errors for _, errors in found])
