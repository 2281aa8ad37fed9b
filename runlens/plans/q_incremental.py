"""Queries: incremental processing of listed runs, alerts on errors and hosts."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import alerts as AL
from runlens.operators import incremental as I
from runlens.plans import views as V
from runlens.plans.catalog import register

# as-of: the latest listed end time (a value derived from the data, never
# the wall clock)
ASOF = "a AS (SELECT max(end_time) AS as_of FROM polls_v)"
WIN = ("w AS (SELECT p.* FROM polls_v p, a WHERE end_time BETWEEN as_of - INTERVAL 168 HOUR "
       "AND as_of - INTERVAL 1800 SECOND)")


def _polls(spark, sf_dir):
    p = V.polls_v(spark, sf_dir)
    return I.with_scalar(p, I.max_time(p, "end_time")), F.col("as_of")


@register(
    "incremental_anti",
    "SELECT id, uid, name, end_time FROM polls_v l "
    "WHERE NOT EXISTS (SELECT 1 FROM polls_v p WHERE p.processed AND p.id = l.id)",
)
def incremental_anti(spark, sf_dir):
    """Listed runs not yet in the store (anti join on id)."""
    p = V.polls_v(spark, sf_dir)
    return I.new_runs(p, p.where("processed"), "id").select("id", "uid", "name", "end_time")


@register(
    "lookback_new_runs",
    f"""WITH {ASOF}, {WIN}
SELECT DISTINCT id, uid, name, host, end_time FROM w
WHERE name <> 'error' AND id NOT IN (SELECT id FROM w WHERE processed)""",
)
def lookback_new_runs(spark, sf_dir):
    """The lookback window [as_of-168h, as_of-30min] re-checked: new,
    name-matched runs, deduplicated by id."""
    p, as_of = _polls(spark, sf_dir)
    lo, hi = I.lookback_bounds(as_of)
    w = I.in_range(p, "end_time", lo, hi)
    new = I.new_runs(w.where(F.col("name") != "error"), w.where("processed"), "id")
    return new.dropDuplicates(["id"]).select("id", "uid", "name", "host", "end_time")


@register(
    "settled_runs",
    f"WITH {ASOF} SELECT id, end_time FROM polls_v, a WHERE end_time <= as_of - INTERVAL 1800 SECOND",
)
def settled_runs(spark, sf_dir):
    """Runs completed at least the settling delay before as-of."""
    p, as_of = _polls(spark, sf_dir)
    return I.settled(p, "end_time", as_of).select("id", "end_time")


_STEP_SQL = f"""WITH {ASOF},
b AS (SELECT as_of - INTERVAL 168 HOUR AS lo, as_of - INTERVAL 1800 SECOND AS hi FROM a),
s AS (SELECT p.*, CAST(floor((epoch_us(end_time) - epoch_us(lo)) / 3600000000.0) AS BIGINT) AS step, lo, hi
      FROM polls_v p, b WHERE end_time >= lo AND end_time < hi AND lo < hi)"""


@register(
    "time_step_counts",
    f"""{_STEP_SQL}
SELECT step, lo + to_seconds(step * 3600) AS step_start, least(lo + to_seconds((step + 1) * 3600), hi) AS step_end,
       count(*) AS n_runs
FROM s GROUP BY ALL""",
)
def time_step_counts(spark, sf_dir):
    """The lookback window sliced into 1-hour steps (last one clipped),
    runs per step, all steps in one aggregation."""
    p, as_of = _polls(spark, sf_dir)
    lo, hi = I.lookback_bounds(as_of)
    steps = I.assign_steps(p, "end_time", lo, hi)
    return steps.groupBy("step", "step_start", "step_end").agg(F.count(F.lit(1)).alias("n_runs"))


@register(
    "time_step_counters",
    f"""{_STEP_SQL}
SELECT step, lo + to_seconds(step * 3600) AS step_start, least(lo + to_seconds((step + 1) * 3600), hi) AS step_end,
       count(*) AS total, count(*) FILTER (WHERE name <> 'error') AS matched,
       count(*) FILTER (WHERE name <> 'error' AND id NOT IN (SELECT id FROM polls_v WHERE processed)) AS new
FROM s GROUP BY ALL""",
)
def time_step_counters(spark, sf_dir):
    """Per step: listed, name-matched and new (matched, not stored) runs."""
    p, as_of = _polls(spark, sf_dir)
    lo, hi = I.lookback_bounds(as_of)
    return I.step_counters(p, p.where("processed"), "end_time", lo, hi, F.col("name") != "error")


_STORE3D = f"{ASOF}, s AS (SELECT p.* FROM polls_v p, a WHERE processed AND end_time <= as_of - INTERVAL 3 DAY)"


@register(
    "high_watermark_new",
    f"""WITH {_STORE3D}, hw AS (SELECT max(end_time) AS hw FROM s)
SELECT id, end_time FROM polls_v, hw
WHERE end_time >= hw AND id NOT IN (SELECT s.id FROM s, hw WHERE s.end_time = hw.hw)""",
)
def high_watermark_new(spark, sf_dir):
    """Runs since the store's high watermark minus the ids stored at it
    (store = what was processed up to three days before as-of)."""
    p, as_of = _polls(spark, sf_dir)
    store = p.where(F.col("processed") & (F.col("end_time") <= F.timestamp_add("DAY", F.lit(-3), as_of))).drop("as_of")
    return I.since_high_watermark(V.polls_v(spark, sf_dir), store, "end_time", "id").select("id", "end_time")


@register(
    "ids_at_latest",
    "SELECT id, end_time FROM polls_v WHERE processed AND end_time = (SELECT max(end_time) FROM polls_v WHERE processed)",
)
def ids_at_latest(spark, sf_dir):
    """T5: all stored rows at the greatest end time (ties kept)."""
    store = V.polls_v(spark, sf_dir).where("processed")
    return I.rows_at_latest(store, "end_time").select("id", "end_time")


@register(
    "resume_point",
    "SELECT greatest(max(end_time), TIMESTAMP '2024-01-15 00:00:00') AS resume_from FROM polls_v WHERE processed",
)
def q_resume_point(spark, sf_dir):
    """Start from the later of the stored maximum and a given date."""
    store = V.polls_v(spark, sf_dir).where("processed")
    return I.resume_point(store, "end_time", "2024-01-15 00:00:00")


@register("latest_end_time", "SELECT max(end_time) AS latest_end_time FROM polls_v WHERE processed")
def latest_end_time(spark, sf_dir):
    """The store's greatest end time."""
    return I.max_time(V.polls_v(spark, sf_dir).where("processed"), "end_time", "latest_end_time")


@register(
    "processed_ids_desc",
    f"""WITH {ASOF} SELECT id, end_time FROM polls_v, a
WHERE processed AND end_time BETWEEN as_of - INTERVAL 168 HOUR AND as_of ORDER BY end_time DESC, id""",
)
def processed_ids_desc(spark, sf_dir):
    """Stored ids of the lookback range, newest first."""
    p, as_of = _polls(spark, sf_dir)
    lo = F.timestamp_add("HOUR", F.lit(-168), as_of)
    return I.ids_desc(p.where("processed"), "end_time", lo, as_of)


@register("distinct_ids", "SELECT DISTINCT uid FROM polls_v WHERE processed")
def q_distinct_ids(spark, sf_dir):
    """Distinct user ids of the stored runs."""
    return I.distinct_ids(V.polls_v(spark, sf_dir).where("processed"), "uid")


@register(
    "upsert_latest",
    """SELECT uid, id, end_time, name FROM (
  SELECT uid, id, end_time, name, event_id, 0 AS src FROM polls_v WHERE processed
  UNION ALL SELECT uid, id, end_time, name, event_id, 1 FROM polls_v WHERE NOT processed)
QUALIFY row_number() OVER (PARTITION BY uid ORDER BY end_time DESC, event_id DESC, src DESC) = 1""",
)
def upsert_latest(spark, sf_dir):
    """Latest-wins upsert of new runs into the store, keyed by user."""
    p = V.polls_v(spark, sf_dir).select("uid", "id", "end_time", "name", "event_id", "processed")
    existing = p.where("processed").drop("processed")
    updates = p.where(~F.col("processed")).drop("processed")
    return I.upsert(existing, updates, "uid", ["end_time", "event_id"]).select("uid", "id", "end_time", "name")


@register(
    "yarn_incremental",
    """WITH m AS (SELECT max(finishedTime) AS mx FROM yarn_v),
s AS (SELECT y.* FROM yarn_v y, m WHERE stored AND finishedTime < mx - 259200000),
hw AS (SELECT max(finishedTime) AS hw FROM s)
SELECT id, finishedTime, state FROM yarn_v, hw WHERE state = 'FINISHED' AND (hw IS NULL OR finishedTime >= hw)""",
)
def yarn_incremental(spark, sf_dir):
    """Finished cluster applications since the stored maximum finish
    time (inclusive; the store holds what was stored up to 3 days before)."""
    y = V.yarn_v(spark, sf_dir)
    mx = y.agg(F.max("finishedTime").alias("mx"))
    store = I.with_scalar(y, mx).where(F.col("stored") & (F.col("finishedTime") < F.col("mx") - 259200000)).drop("mx")
    return I.finished_since_latest(y, store).select("id", "finishedTime", "state")


# ---------------------------------------------------------------------------
# alerts
# ---------------------------------------------------------------------------

EASOF = "ea AS (SELECT max(time_processed) AS as_of FROM errors_v)"
K1 = (f"{EASOF}, k1 AS (SELECT e.* FROM errors_v e, ea WHERE time_processed > as_of - INTERVAL 1 DAY "
      "AND time_processed <= as_of AND NOT coalesce(type IN ('HTTPError', 'ConflictError'), false))")


def _severe(spark, sf_dir):
    e = V.errors_v(spark, sf_dir)
    ea = I.with_scalar(e, I.max_time(e, "time_processed"))
    return AL.severe_errors(ea, F.col("as_of")).drop("as_of")


@register("alert_severe_errors", f"WITH {K1} SELECT err_id, time_processed, host, type, stage FROM k1")
def alert_severe_errors(spark, sf_dir):
    """K1: errors of the last day, types HTTPError/ConflictError excluded."""
    return _severe(spark, sf_dir).select("err_id", "time_processed", "host", "type", "stage")


@register(
    "alert_errors_by_host",
    f"""WITH {K1} SELECT host, type, count(*) AS n_errors, GROUPING(type) = 1 AS is_host_total
FROM k1 GROUP BY ROLLUP (host, type) HAVING GROUPING(host) = 0""",
)
def alert_errors_by_host(spark, sf_dir):
    """Severe errors per host and type, with per-host totals."""
    return AL.errors_by_host(_severe(spark, sf_dir))


@register(
    "alert_recent_errors",
    f"WITH {K1} SELECT err_id, time_processed, host, type, message FROM k1 "
    "ORDER BY time_processed DESC, err_id DESC LIMIT 5",
)
def alert_recent_errors(spark, sf_dir):
    """The 5 most recent severe errors."""
    return AL.recent(_severe(spark, sf_dir)).select("err_id", "time_processed", "host", "type", "message")


@register(
    "alert_error_report",
    f"""WITH {K1} SELECT host, count(*) AS n_errors, max(time_processed) AS latest,
  string_agg(DISTINCT type, ',' ORDER BY type) AS types FROM k1 GROUP BY ROLLUP (host)""",
)
def alert_error_report(spark, sf_dir):
    """K2: report of the severe errors: per host and in total."""
    return AL.error_report(_severe(spark, sf_dir))


@register(
    "alert_latest_by_host",
    "SELECT host, max(end_time) AS max_end_time, max(time_processed) AS max_time_processed "
    "FROM polls_v WHERE processed GROUP BY host",
)
def alert_latest_by_host(spark, sf_dir):
    """Latest end and processing time per host."""
    return AL.latest_by_host(V.polls_v(spark, sf_dir).where("processed"))


@register(
    "alert_no_new_runs",
    """WITH a AS (SELECT max(time_processed) AS as_of FROM polls_v)
SELECT host, max(time_processed) AS max_time_processed,
       max(time_processed) < any_value(as_of) - INTERVAL 6 HOUR AS quiet
FROM polls_v, a WHERE processed GROUP BY host""",
)
def alert_no_new_runs(spark, sf_dir):
    """K3: hosts with nothing processed in the 6 hours before as-of."""
    p = V.polls_v(spark, sf_dir)
    q = AL.quiet_hosts(p.where("processed"), I.scalar_max(p, "time_processed"))
    return q.select("host", "max_time_processed", "quiet")


@register(
    "error_log_view",
    f"""WITH {EASOF} SELECT time_processed, spark_app_id, host, type, message FROM errors_v, ea
WHERE time_processed > as_of - INTERVAL 7 DAY AND time_processed <= as_of""",
)
def error_log_view(spark, sf_dir):
    """K5: five columns of the errors of the last 7 days."""
    e = V.errors_v(spark, sf_dir)
    ea = I.with_scalar(e, I.max_time(e, "time_processed"))
    t = F.col("time_processed")
    return ea.where((t > F.timestamp_add("DAY", F.lit(-7), F.col("as_of"))) & (t <= F.col("as_of"))).select(
        "time_processed", "spark_app_id", "host", "type", "message"
    )


@register(
    "filter_name",
    "SELECT app_id, name FROM runs_v WHERE name LIKE 'Daily_report-%'",
)
def filter_name(spark, sf_dir):
    """Runs passing a name predicate given as SQL text."""
    from runlens.operators.cleanse import filter_names

    return filter_names(V.runs_v(spark, sf_dir), "name LIKE 'Daily_report-%'").select("app_id", "name")


@register(
    "time_step_assign",
    f"""{_STEP_SQL}
SELECT id, end_time, step, lo + to_seconds(step * 3600) AS step_start,
       least(lo + to_seconds((step + 1) * 3600), hi) AS step_end FROM s""",
)
def time_step_assign(spark, sf_dir):
    """Every run of the lookback window assigned to its step
    (containment [step_start, step_end) computed arithmetically: an equi
    relation, no range join)."""
    p, as_of = _polls(spark, sf_dir)
    lo, hi = I.lookback_bounds(as_of)
    return I.assign_steps(p, "end_time", lo, hi).select("id", "end_time", "step", "step_start", "step_end")
