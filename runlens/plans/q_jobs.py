"""Queries: polling (L2), whole documents as clean tables, and the ETL
profile's steps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from runlens.jobs import poll_cluster
from runlens.operators import metrics as M
from runlens.operators.cleanse import documents_to_tables
from runlens.operators.profiles import EtlProfile
from runlens.plans import views as V
from runlens.plans.catalog import register
from runlens.plans.oracle_views import r4, sql_cast_number
from runlens.plans.q_core import SUMMARY_SQL
from runlens.plans.q_docs import cls_sql, tag_sql
from runlens.plans.q_etl import CTRL_SQL, PAIRS_SQL
from runlens.plans.q_ingest import FIRST, SECOND
from runlens.plans.q_yarn import _sched_sql
from runlens.session import checkpoint_path
from runlens.sources import schemas
from runlens.sources import telemetry as S

K = ["app_id", "attempt_id"]
MIDDLE = "2024-01-15 00:00:00"


def _fresh(spark, name: str) -> str:
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")


@register(
    "poll_apps_two_rounds",
    f"""WITH m AS (SELECT max(finishedTime) AS latest FROM yarn_v
               WHERE state = 'FINISHED' AND finishedTime <= epoch_ms(TIMESTAMP '{MIDDLE}'))
SELECT id, make_timestamp(startedTime * 1000) AS startedTime, make_timestamp(finishedTime * 1000) AS finishedTime,
  {tag_sql()} AS tag, strftime(make_timestamp(finishedTime * 1000), '%Y-%m-%d') AS end_date,
  CASE WHEN latest IS NULL OR finishedTime >= latest THEN TIMESTAMP '{SECOND}' ELSE TIMESTAMP '{FIRST}' END AS time_processed
FROM ({cls_sql('yarn_v')}), m WHERE state = 'FINISHED'""",
)
def poll_apps_two_rounds(spark, sf_dir):
    """Two polls of the cluster manager, the second one tried
    again.  The first lists what had started by the middle of the month, with
    what had not ended yet as running; the second lists everything, and only
    applications that finished since the stored maximum are written.  Returns
    the stored applications."""
    apps = V.yarn_v(spark, sf_dir).drop("stored")
    middle = F.unix_millis(F.lit(MIDDLE).cast("timestamp"))
    going = F.coalesce(F.col("finishedTime") > middle, F.lit(False))
    first = apps.where(F.col("startedTime") <= middle).withColumns({
        "state": F.when(going, F.lit("RUNNING")).otherwise(F.col("state")),
        "finishedTime": F.when(~going, F.col("finishedTime")),
    })
    base = _fresh(spark, "poll-apps")
    none = spark.createDataFrame([], schemas.SCHEDULER_SNAPSHOT)
    poll_cluster(spark, first, none, base, 0, FIRST)
    for _ in range(2):
        poll_cluster(spark, apps, none, base, 1, SECOND)
    return S.read_latest(spark, f"{base}/yarn_apps").select(
        "id", "startedTime", "finishedTime", "tag", F.col("end_date").cast("string").alias("end_date"),
        F.col("meta.time_processed").alias("time_processed"))


_POLL, _POLL_DAY = ("CAST({0} % 2 = 0 AS INTEGER)", "CASE WHEN {0} % 2 = 0 THEN '2024-02-02' ELSE '2024-02-01' END")


@register(
    "poll_snapshots_retried",
    f"""SELECT doc_type AS kind, {_POLL.format('snapshot_id')} AS poll, {_POLL_DAY.format('snapshot_id')} AS date,
  count(*) AS n, CAST(sum(coalesce(used_memory, 0) + coalesce(numApplications, 0)) AS BIGINT) AS total
FROM ({_sched_sql()}) WHERE snapshot_id % 40 <> 0 GROUP BY ALL
UNION ALL
SELECT 'cluster', {_POLL.format('o_orderkey')}, {_POLL_DAY.format('o_orderkey')}, count(*), CAST(sum(o_orderkey % 1000) AS BIGINT)
FROM orders WHERE o_orderkey % 40 <> 0 GROUP BY ALL
UNION ALL
SELECT 'bad_snapshot in ' || stage, 1, '2024-02-02', count(*), 0::BIGINT
FROM orders, (VALUES ('yarn_cluster_stats'), ('yarn_scheduler_docs')) AS e(stage) WHERE o_orderkey % 40 = 0 GROUP BY ALL""",
)
def poll_snapshots_retried(spark, sf_dir):
    """Two polls of cluster snapshots, the second one
    tried again, each with a day's snapshots (an order's key gives the poll and
    the second); every fortieth snapshot came without its scheduler part.
    Returns what is stored by poll and date: cluster documents, the six
    scheduler document types and errors, each once."""
    k = F.col("snapshot_id")
    taken = F.timestamp_add("SECOND", k % 86400, F.when(k % 2 == 0, F.lit(SECOND)).otherwise(F.lit(FIRST)).cast("timestamp"))
    snapshots = V.scheduler_v(spark, sf_dir).withColumns({
        "scheduler": F.when(k % 40 != 0, F.struct("schedulerInfo")), "time_processed": taken.cast("string")})
    base = _fresh(spark, "poll-snapshots")
    none = spark.createDataFrame([], schemas.YARN_APP)
    for poll in (0, 1, 1):
        poll_cluster(spark, none, snapshots.where(k % 2 == 1 - poll), base, poll, SECOND)
    memory, apps = (F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in ("used_memory", "numApplications"))
    parts = [("yarn_scheduler", F.col("doc_type"), memory + apps),
             ("yarn_cluster", F.lit("cluster"), F.col("clusterMetrics")["availableMB"]),
             ("yarn_errors", F.concat("type", F.lit(" in "), "stage"), F.lit(0))]
    found = None
    for table, kind, size in parts:
        stored = spark.read.parquet(f"{base}/{table}").select(
            kind.alias("kind"), "poll", F.col("date").cast("string").alias("date"), size.cast("bigint").alias("size"))
        found = stored if found is None else found.unionByName(stored)
    return found.groupBy("kind", "poll", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))


_START, _END = (f"try_strptime({c}, '%Y-%m-%dT%H:%M:%S.%gGMT')" for c in ("startTime", "endTime"))
_ATTEMPT_FIELDS = "app_id attempt_id attempt_pos completed duration endTime isFinalAttempt lastUpdated name startTime"
_EXECUTOR_FIELDS = "addTime app_id attempt_id id maxMemory memoryMetrics removeTime totalCores totalDuration totalInputBytes"
_STAGE_FIELDS = ("app_id attemptId attempt_id completionTime executorCpuTime firstTaskLaunchedTime inputBytes inputRecords "
                 "numCompleteTasks outputBytes stageId submissionTime")


@register(
    "clean_documents",
    f"""WITH a AS (SELECT *, CAST(substr(id, 13) AS BIGINT) AS k, {_START} AS started, {_END} AS ended FROM attempts_raw_v),
d AS (SELECT id AS app_id, coalesce(attemptId, '0') AS attempt_id, * FROM a WHERE k % 27 <> 0 OR attempt_pos = 0)
SELECT app_id, attempt_id, 'attempt' AS kind, CAST(attempt_pos AS VARCHAR) AS id, started, ended, duration AS size,
  '{_ATTEMPT_FIELDS}' AS fields FROM d
UNION ALL SELECT app_id, attempt_id, 'executor', 'driver', started, ended, 0, '{_EXECUTOR_FIELDS}' FROM d
UNION ALL SELECT app_id, attempt_id, 'executor', '1', started, ended, duration * (1 + k % 2), '{_EXECUTOR_FIELDS}' FROM d
UNION ALL SELECT app_id, attempt_id, 'stage', '0', started, ended, k * 512, '{_STAGE_FIELDS}' FROM d""",
)
def clean_documents(spark, sf_dir):
    """P5, P20, H5: whole application documents as flat tables of attempts,
    executors and stages: times parsed, listed fields dropped, and the arrays
    gone from the attempts.  ``fields`` names the columns of each table."""
    docs = V.landed_v(spark, sf_dir, 2).withColumn("attempts", F.transform("attempts", lambda x: x.withField(
        "allexecutors", F.transform(x["allexecutors"], lambda e: e.withField("hostPort", F.lit("node-1:7337")))).withField(
        "stages", F.transform(x["stages"], lambda s: s.withField("details", F.lit("stage 0"))))))
    attempts, executors, stages = documents_to_tables(docs)

    def rows(df, kind, id_col, start, end, size):
        return df.select(*K, F.lit(kind).alias("kind"), F.col(id_col).cast("string").alias("id"), F.col(start).alias("started"),
                         F.col(end).alias("ended"), F.col(size).cast("bigint").alias("size"),
                         F.lit(" ".join(sorted(df.columns))).alias("fields"))

    return rows(attempts, "attempt", "attempt_pos", "startTime", "endTime", "duration").unionByName(
        rows(executors, "executor", "id", "addTime", "removeTime", "totalDuration")).unionByName(
        rows(stages, "stage", "stageId", "submissionTime", "completionTime", "outputBytes"))


_IN, _OUT = (sql_cast_number(f"CASE c.type WHEN '{t}' THEN e.ai_{a} ELSE e.ai_{b} END") for t, a, b in (
    ("conformance", "conform_input_data_size", "std_input_data_size"),
    ("standardization", "std_output_data_size", "conform_output_data_size")))


@register(
    "etl_profile_report",
    f"""WITH {PAIRS_SQL}, {CTRL_SQL},
s AS ({SUMMARY_SQL}),
sa AS (SELECT app_id, attempt_id, max(inputBytes) AS in_mem, max(outputBytes) AS out_mem FROM stages_v GROUP BY ALL),
ctl AS (SELECT run_id, count(*) AS checkpoints FROM cp GROUP BY run_id),
j AS (
  SELECT c.*, k.uniqueId, sa.in_mem, sa.out_mem, s.est_peak_memory_usage AS pk, {_IN} AS i, {_OUT} AS o
  FROM (SELECT *, {tag_sql()} AS tag FROM ({cls_sql('runs_v')}) WHERE is_etl) c
  LEFT JOIN ranked k ON k.app_id = c.app_id AND k.run_rank = 0
  LEFT JOIN etl_runs_v e ON e.uniqueId = k.uniqueId
  LEFT JOIN sa ON sa.app_id = c.app_id AND sa.attempt_id = c.attempt_id
  LEFT JOIN s ON s.app_id = c.app_id AND s.attempt_id = c.attempt_id)
SELECT j.app_id, j.attempt_id, j.tag, j.uniqueId AS run_id, ctl.checkpoints,
  CASE WHEN ctl.run_id IS NOT NULL THEN fm.run_id IS NULL END AS controls_match, fm.cp_name AS error_checkpoint,
  CASE WHEN in_mem IS NOT NULL AND i <> 0 AND in_mem <> 0 THEN {r4('in_mem / i')} END AS input_factor,
  CASE WHEN in_mem IS NOT NULL AND i <> 0 AND in_mem <> 0 AND pk <> 0 THEN {r4('pk / i')} END AS peak_factor,
  CASE WHEN in_mem IS NOT NULL AND i <> 0 AND o <> 0 THEN {r4('o / i')} END AS size_ratio
FROM j LEFT JOIN ctl ON ctl.run_id = j.uniqueId LEFT JOIN fm ON fm.run_id = j.uniqueId""",
)
def etl_profile_report(spark, sf_dir):
    """H2: the ETL profile's four steps on attempt reports: ETL applications
    only, classified and paired with their newest run, control checks of that
    run's checkpoints, and the storage and memory factors."""
    profile = EtlProfile(V.etl_runs_v(spark, sf_dir), V.checkpoints_v(spark, sf_dir))
    runs = profile.is_matching_app(V.runs_v(spark, sf_dir)).select(*K, "name", "startTime", "endTime", "duration")
    report = M.attempt_report(runs, V.executors_v(spark, sf_dir), V.stages_v(spark, sf_dir), nunique="none", parallelism=False)
    report = report.select(*K, "name", "stages_inputBytes_max", "stages_outputBytes_max", "est_peak_memory_usage")
    done = profile.post_aggregate(profile.aggregate(profile.enrich(report)))
    p = F.col("postprocessing")
    return done.select(
        *K, "tag", "run_id", F.col("elements_count").alias("checkpoints"), "controls_match", "error_checkpoint",
        p["input_deserialization_factor"].alias("input_factor"), p["peak_to_input_memory_factor"].alias("peak_factor"),
        p["output_to_input_storage_size_ratio"].alias("size_ratio"))


@register(
    "yarn_attempt_containers",
    """WITH a AS (SELECT id, CAST(substr(id, 14) AS BIGINT) AS k, startedTime, allocatedMB, unnest(range(1, 2 + k % 2)) AS n FROM yarn_v)
SELECT id AS app_id, id || '_attempt_' || n AS attempt_id, startedTime + n * 1000 AS started, 1 + (k + n) % 3 AS containers,
  (1 + (k + n) % 3) * allocatedMB AS allocated_mb
FROM a""",
)
def yarn_attempt_containers(spark, sf_dir):
    """Landed application attempts and containers of the cluster manager,
    read with their schemas: every attempt with its containers and memory."""
    attempts, containers = V.yarn_attempts_v(spark, sf_dir)
    base = _fresh(spark, "yarn-attempts")
    attempts.write.json(f"{base}/attempts")
    containers.write.json(f"{base}/containers")
    held = S.read_yarn_containers(spark, f"{base}/containers").groupBy("appId", "appAttemptId").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("allocatedMB").alias("allocated_mb"))
    listed = S.read_yarn_attempts(spark, f"{base}/attempts")
    return listed.join(held, ["appId", "appAttemptId"], "left").select(
        F.col("appId").alias("app_id"), F.col("appAttemptId").alias("attempt_id"), F.col("startTime").alias("started"),
        F.coalesce("containers", F.lit(0)).alias("containers"), "allocated_mb")


@register("stored_ids", "SELECT id FROM yarn_v WHERE stored")
def stored_ids(spark, sf_dir):
    """Stored documents projected to their id, without a cap."""
    return S.ids_only(V.yarn_v(spark, sf_dir).where("stored"))
