"""Queries: ETL-run profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import classify as C
from runlens.operators import etl as E
from runlens.operators import metrics as M
from runlens.operators.cleanse import flatten_attempts
from runlens.plans import views as V
from runlens.plans.catalog import register
from runlens.plans.oracle_views import r4, sql_cast_number, sql_strip, sql_suffix_parse
from runlens.plans.q_core import SUMMARY_SQL
from runlens.plans.q_docs import cls_sql
from runlens.constants import ETL_KEY_INFO_DATE, REDACTED_ARGS, SIZE_UNITS

K = ["app_id", "attempt_id"]


def _apps(spark, sf_dir):
    """Classified ETL applications (valid classification only)."""
    e = C.enrich(V.runs_v(spark, sf_dir).select("app_id", "name"))
    e = e.where(F.col("is_etl") & F.col("etl_valid"))
    cl = F.col("classification")
    return e.select(
        "app_id", cl["type"].alias("type"), cl["dataset"].alias("cls_dataset"), cl["app_version"].alias("app_version"),
        cl["dataset_version"].alias("dataset_version"), cl["dataset_version_int"].alias("dataset_version_int"),
        cl["info_version"].alias("info_version"), cl["info_version_int"].alias("info_version_int"),
    )


def _pairs(spark, sf_dir):
    return E.match_candidates(V.etl_runs_v(spark, sf_dir), _apps(spark, sf_dir))


def _matched_ranked(spark, sf_dir):
    return E.rank_runs(_pairs(spark, sf_dir).where("matched"))


# --- oracle fragments ---------------------------------------------------------

DATE_SQL = """coalesce(
  try_strptime({c}, '%d-%m-%Y %H:%M:%S %z')::TIMESTAMP, try_strptime({c}, '%Y-%m-%d %H:%M:%S %z')::TIMESTAMP,
  try_strptime({c}, '%d-%m-%Y %H:%M:%S'), try_strptime({c}, '%Y-%m-%d %H:%M:%S'))"""

PAIRS_SQL = f"""
cls AS (SELECT * FROM ({cls_sql('runs_v')}) WHERE is_etl AND valid),
rr AS (SELECT uniqueId, dataset AS run_dataset, datasetVersion, version AS info_version_run, startDateTime,
              ai_std_enceladus_version AS app_version_run, ai_std_application_id AS std_id,
              ai_conform_application_id AS conf_id
       FROM etl_runs_v),
cand AS (SELECT *, std_id AS cand FROM rr WHERE std_id IS NOT NULL
         UNION SELECT *, conf_id AS cand FROM rr WHERE conf_id IS NOT NULL),
pairs AS (
  SELECT c.app_id, r.uniqueId, r.startDateTime,
    CASE c.type WHEN 'standardization&conformance' THEN r.std_id WHEN 'standardization' THEN r.std_id
                WHEN 'conformance' THEN r.conf_id ELSE '' END AS run_app_id,
    r.*, c.type, c.dataset AS cls_dataset, c.app_version, c.dataset_version, c.dataset_version_int, c.info_version,
    c.info_version_int
  FROM cand r JOIN cls c ON r.cand = c.app_id),
pm AS (
  SELECT *, (run_dataset IS NOT DISTINCT FROM cls_dataset)
    AND (CASE WHEN dataset_version IS NULL THEN datasetVersion IS NULL
              ELSE dataset_version_int IS NOT DISTINCT FROM datasetVersion END)
    AND (CASE WHEN info_version IS NULL THEN info_version_run IS NULL
              ELSE info_version_int IS NOT DISTINCT FROM info_version_run END)
    AND (app_version_run IS NOT DISTINCT FROM app_version)
    AND (run_app_id IS NOT DISTINCT FROM app_id) AS matched
  FROM pairs),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY app_id ORDER BY {DATE_SQL.format(c='startDateTime')} DESC NULLS LAST,
                                 uniqueId DESC) - 1 AS run_rank
  FROM pm WHERE matched)"""


@register(
    "etl_match_runs",
    f"WITH {PAIRS_SQL} SELECT app_id, uniqueId, run_app_id, matched FROM pm",
)
def etl_match_runs(spark, sf_dir):
    """(application, run) pairs by application id, with the 5-way match flag."""
    return _pairs(spark, sf_dir).select("app_id", "uniqueId", "run_app_id", "matched")


@register(
    "etl_positional_join",
    f"""WITH {PAIRS_SQL},
att AS (SELECT id AS app_id, attempt_pos, attemptId FROM attempts_raw_v WHERE id IN (SELECT app_id FROM cls))
SELECT a.app_id, a.attempt_pos, a.attemptId, r.uniqueId
FROM att a LEFT JOIN ranked r ON r.app_id = a.app_id AND r.run_rank = a.attempt_pos""",
)
def etl_positional_join(spark, sf_dir):
    """Attempts (newest first) paired with matching runs newest first."""
    apps = _apps(spark, sf_dir).select("app_id")
    att = flatten_attempts(V.apps_v(spark, sf_dir)).select(
        F.col("id").alias("app_id"), "attempt_pos", F.col("attempt.attemptId").alias("attemptId")
    ).join(apps, "app_id", "left_semi")
    runs = _matched_ranked(spark, sf_dir).select("app_id", "uniqueId", "run_rank")
    return E.positional_join(att, runs).select("app_id", "attempt_pos", "attemptId", "uniqueId")


@register(
    "etl_run_count_mismatch",
    f"""WITH {PAIRS_SQL},
a AS (SELECT id AS app_id, count(*) AS n_attempts FROM attempts_raw_v WHERE id IN (SELECT app_id FROM cls) GROUP BY 1),
r AS (SELECT app_id, count(*) AS n_runs FROM pm WHERE matched GROUP BY 1)
SELECT coalesce(a.app_id, r.app_id) AS app_id, coalesce(n_attempts, 0) AS n_attempts, coalesce(n_runs, 0) AS n_runs
FROM a FULL JOIN r ON a.app_id = r.app_id WHERE coalesce(n_attempts, 0) <> coalesce(n_runs, 0)""",
)
def etl_run_count_mismatch(spark, sf_dir):
    """ETL applications whose attempt and matching-run counts differ."""
    apps = _apps(spark, sf_dir).select("app_id")
    att = flatten_attempts(V.apps_v(spark, sf_dir)).select(F.col("id").alias("app_id")).join(apps, "app_id", "left_semi")
    runs = _pairs(spark, sf_dir).where("matched").select("app_id")
    return E.run_count_mismatch(att, runs)


@register(
    "etl_latest_run",
    f"""SELECT dataset, datasetVersion, uniqueId, n_runs FROM (
  SELECT dataset, datasetVersion, uniqueId, count(*) OVER (PARTITION BY dataset, datasetVersion) AS n_runs,
         row_number() OVER (PARTITION BY dataset, datasetVersion
                            ORDER BY coalesce(epoch_ms({DATE_SQL.format(c='startDateTime')}), -9223372036854775807) DESC,
                                     uniqueId DESC) AS rn
  FROM etl_runs_v) WHERE rn = 1""",
)
def etl_latest_run(spark, sf_dir):
    """Latest run per (dataset, dataset version)."""
    return E.latest_run(V.etl_runs_v(spark, sf_dir))


_ARGS = """list_transform(list_filter(string_split(ai_std_cmd_line_args, '--'), lambda p: p <> ''),
    lambda p: {'k': string_split(trim(p, ' '), ' ')[1], 'v': array_to_string(string_split(trim(p, ' '), ' ')[2:], ' ')})"""
_RED = "('menas-auth-keytab', 'menas-credentials-file', 'report-date')"


@register(
    "etl_cast_info",
    f"""SELECT uniqueId, {DATE_SQL.format(c='startDateTime')} AS start_time,
  {r4(sql_suffix_parse('ai_std_executor_memory', SIZE_UNITS, 1))} AS std_executor_memory,
  {r4(sql_suffix_parse('ai_conform_executor_memory_overhead', SIZE_UNITS, 1048576))} AS conform_executor_memory_overhead,
  {r4(f"CASE WHEN suffix(ai_std_size_ratio, ' %') THEN TRY_CAST({sql_strip('left(ai_std_size_ratio, length(ai_std_size_ratio) - 2)')} AS DOUBLE) / 100.0 END")} AS std_size_ratio,
  {r4(sql_cast_number('ai_records'))} AS records_num, ai_label AS label_str,
  {r4(sql_cast_number('ai_std_input_data_size'))} AS std_input_data_size,
  'str:' || ai_enceladus_info_date AS enceladus_info_date, 'str:' || informationDate AS informationDate
FROM etl_runs_v""",
)
def etl_cast_info(spark, sf_dir):
    """Run start parsed, additionalInfo typed per key (sizes, MiB
    overheads, percentages; generic number-or-text), info dates as text."""
    r = V.etl_runs_v(spark, sf_dir)
    return r.select(
        "uniqueId",
        E.run_start().alias("start_time"),
        E.typed_info("std_executor_memory").alias("std_executor_memory"),
        E.typed_info("conform_executor_memory_overhead").alias("conform_executor_memory_overhead"),
        E.typed_info("std_size_ratio").alias("std_size_ratio"),
        E.typed_info("records")["num"].alias("records_num"),
        E.typed_info("label")["str"].alias("label_str"),
        E.typed_info("std_input_data_size")["num"].alias("std_input_data_size"),
        F.concat(F.lit("str:"), E.info(ETL_KEY_INFO_DATE)).alias("enceladus_info_date"),
        F.concat(F.lit("str:"), F.col("controlMeasure.metadata.informationDate")).alias("informationDate"),
    )


@register(
    "redact_args",
    f"""SELECT uniqueId, array_to_string(list_sort(list_transform(args,
    lambda e: e.k || '=' || CASE WHEN e.k IN {_RED} THEN 'redacted' ELSE e.v END)), ' ') AS args,
  CAST(len(list_filter(args, lambda e: e.k IN {_RED})) AS INTEGER) AS n_redacted
FROM (SELECT uniqueId, {_ARGS} AS args FROM etl_runs_v)""",
)
def redact_args(spark, sf_dir):
    """Command-line arguments parsed, listed ones redacted."""
    r = V.etl_runs_v(spark, sf_dir)
    m = E.typed_info("std_cmd_line_args")
    entries = F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    n_red = F.size(F.filter(F.map_keys(m), lambda k: k.isin(*REDACTED_ARGS)))
    return r.select("uniqueId", F.array_join(F.array_sort(entries), " ").alias("args"), n_red.alias("n_redacted"))


@register(
    "etl_post_metrics",
    f"""WITH {PAIRS_SQL},
s AS ({SUMMARY_SQL}),
sa AS (SELECT app_id, attempt_id, max(inputBytes) AS in_mem, max(outputBytes) AS out_mem FROM stages_v GROUP BY ALL),
j AS (
  SELECT r.app_id, r.attempt_id, c.type, sa.in_mem, sa.out_mem, s.est_peak_memory_usage AS pk, k.uniqueId,
    {sql_cast_number('CASE c.type WHEN ' + chr(39) + 'conformance' + chr(39) + ' THEN e.ai_conform_input_data_size ELSE e.ai_std_input_data_size END')} AS i,
    {sql_cast_number('CASE c.type WHEN ' + chr(39) + 'standardization' + chr(39) + ' THEN e.ai_std_output_data_size ELSE e.ai_conform_output_data_size END')} AS o
  FROM runs_v r JOIN cls c ON c.app_id = r.app_id
  JOIN ranked k ON k.app_id = r.app_id AND k.run_rank = 0
  JOIN etl_runs_v e ON e.uniqueId = k.uniqueId
  LEFT JOIN sa ON sa.app_id = r.app_id AND sa.attempt_id = r.attempt_id
  LEFT JOIN s ON s.app_id = r.app_id AND s.attempt_id = r.attempt_id)
SELECT app_id, attempt_id, uniqueId,
  CASE WHEN in_mem IS NOT NULL AND i <> 0 THEN CAST(ceil(i / 134217728.0) AS BIGINT) END AS input_in_storage_HDFS_blocks,
  CASE WHEN in_mem IS NOT NULL AND i <> 0 AND in_mem <> 0 THEN {r4('in_mem / i')} END AS input_deserialization_factor,
  CASE WHEN in_mem IS NOT NULL AND i <> 0 AND in_mem <> 0 AND pk <> 0 THEN {r4('pk / i')} END AS peak_to_input_memory_factor,
  CASE WHEN in_mem IS NOT NULL AND o <> 0 THEN CAST(ceil(o / 134217728.0) AS BIGINT) END AS output_in_storage_HDFS_blocks,
  CASE WHEN in_mem IS NOT NULL AND o <> 0 AND out_mem <> 0 THEN {r4('out_mem / o')} END AS output_deserialization_factor,
  CASE WHEN in_mem IS NOT NULL AND o <> 0 AND out_mem <> 0 AND pk <> 0 THEN {r4('pk / o')} END AS peak_to_output_memory_factor,
  CASE WHEN in_mem IS NOT NULL AND i <> 0 AND o <> 0 THEN {r4('o / i')} END AS output_to_input_storage_size_ratio
FROM j""",
)
def etl_post_metrics(spark, sf_dir):
    """M9: storage/memory factors of ETL attempts joined with their newest matching run."""
    runs, ex, st = V.runs_v(spark, sf_dir), V.executors_v(spark, sf_dir), V.stages_v(spark, sf_dir)
    rep = M.attempt_report(runs.select(*K, "startTime", "endTime", "duration"), ex, st, nunique="none",
                           parallelism=False)
    rep = rep.select(*K, "stages_inputBytes_max", "stages_outputBytes_max", "est_peak_memory_usage")
    apps = _apps(spark, sf_dir).select("app_id", "type")
    newest = _matched_ranked(spark, sf_dir).where(F.col("run_rank") == 0).select("app_id", "uniqueId")
    run_info = V.etl_runs_v(spark, sf_dir).select("uniqueId", E.size_info().alias("sizes"))
    j = rep.join(apps, "app_id").join(newest, "app_id").join(run_info, "uniqueId")
    pm = E.post_metrics(j, info_col="sizes")
    return pm.select(*K, "uniqueId", "postprocessing.*")


CTRL_SQL = """
cp AS (SELECT run_id, cp_pos, replace(name, ' ', '') AS cp_name, n_controls FROM checkpoints_v),
rp AS (SELECT run_id, min(cp_pos) AS ref_pos FROM cp WHERE n_controls > 0 GROUP BY run_id),
ref AS (SELECT c.run_id, controlName, arg_max(controlValue, ctrl_pos) AS ref_value
        FROM controls_v c JOIN rp ON c.run_id = rp.run_id AND c.cp_pos = rp.ref_pos GROUP BY ALL),
nc AS (SELECT run_id, count(*) AS num_controls FROM ref GROUP BY run_id),
chk AS (SELECT cp.*, nc.num_controls FROM cp JOIN rp USING (run_id) JOIN nc USING (run_id) WHERE cp.cp_pos > rp.ref_pos),
mm AS (
  SELECT run_id, cp_pos, -1 AS ctrl_pos, true AS incorrect, cp_name, NULL::VARCHAR AS controlName,
         NULL::VARCHAR AS controlValue, NULL::VARCHAR AS ref_value
  FROM chk WHERE n_controls <> num_controls
  UNION ALL
  SELECT k.run_id, k.cp_pos, c.ctrl_pos, false, k.cp_name, c.controlName, c.controlValue, r.ref_value
  FROM chk k JOIN controls_v c ON c.run_id = k.run_id AND c.cp_pos = k.cp_pos
  LEFT JOIN ref r ON r.run_id = k.run_id AND r.controlName IS NOT DISTINCT FROM c.controlName
  WHERE k.n_controls = k.num_controls AND c.controlValue IS DISTINCT FROM r.ref_value),
fm AS (SELECT * FROM mm QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY cp_pos, ctrl_pos) = 1)"""


@register(
    "checkpoint_controls",
    f"""WITH {CTRL_SQL}
SELECT r.run_id, r.elements_count, coalesce(nc.num_controls, 0) AS num_controls, fm.run_id IS NULL AS controls_match,
       fm.cp_name AS error_checkpoint, fm.incorrect AS error_incorrect_num_controls, fm.controlName AS error_controlName,
       fm.controlValue AS error_controlValue, fm.ref_value AS error_initialControlValue
FROM (SELECT run_id, count(*) AS elements_count FROM cp GROUP BY run_id) r
LEFT JOIN nc USING (run_id) LEFT JOIN fm USING (run_id)""",
)
def checkpoint_controls(spark, sf_dir):
    """Control-value consistency across each run's checkpoints."""
    return E.checkpoint_controls(V.checkpoints_v(spark, sf_dir))


@register(
    "checkpoint_durations",
    f"""SELECT run_id, name, {DATE_SQL.format(c='processStartTime')} AS processStartTime,
  {DATE_SQL.format(c='processEndTime')} AS processEndTime,
  CAST(epoch_ms({DATE_SQL.format(c='processEndTime')}) - epoch_ms({DATE_SQL.format(c='processStartTime')}) AS DOUBLE)
    AS duration
FROM (SELECT * REPLACE (replace(name, ' ', '') AS name) FROM checkpoints_v)
QUALIFY row_number() OVER (PARTITION BY run_id, name ORDER BY cp_pos DESC) = 1""",
)
def checkpoint_durations(spark, sf_dir):
    """Checkpoint times and durations keyed by name (last one wins)."""
    return E.checkpoint_durations(V.checkpoints_v(spark, sf_dir))
