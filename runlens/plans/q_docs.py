"""Queries: classification and tags, Spark properties, document projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.constants import DROP_KEYS, SIZE_UNITS, TIME_UNITS
from runlens.operators import classify as C
from runlens.operators import cleanse as P
from runlens.plans import views as V
from runlens.plans.catalog import register
from runlens.plans.oracle_views import r4, sql_suffix_parse

K = ["app_id", "attempt_id"]

# ---------------------------------------------------------------------------
# classification
# ---------------------------------------------------------------------------


def cls_sql(source: str) -> str:
    """DuckDB: classification columns over a source with a ``name`` column."""
    return f"""
SELECT *,
  CASE WHEN valid THEN 'enceladus' END AS project,
  CASE WHEN valid THEN CASE WHEN is_new THEN lower(w[1]) ELSE 'enceladus' END END AS app,
  CASE WHEN valid THEN CASE WHEN is_new THEN lower(w[2]) WHEN old_std THEN 'standardization' ELSE 'conformance' END END
    AS type,
  CASE WHEN valid THEN w[off] END AS app_version,
  CASE WHEN valid THEN w[off + 1] END AS dataset,
  CASE WHEN valid THEN w[off + 2] END AS dataset_version,
  CASE WHEN valid AND regexp_full_match(w[off + 2], '[0-9]+') THEN TRY_CAST(w[off + 2] AS BIGINT) END
    AS dataset_version_int,
  CASE WHEN valid THEN 'str:' || w[off + 3] END AS info_date,
  CASE WHEN valid THEN coalesce(try_strptime(w[off + 3], '%d-%m-%Y'), try_strptime(w[off + 3], '%Y-%m-%d'))
    + INTERVAL 12 HOUR END AS info_date_casted,
  CASE WHEN valid THEN w[off + 4] END AS info_version,
  CASE WHEN valid AND regexp_full_match(w[off + 4], '[0-9]+') THEN TRY_CAST(w[off + 4] AS BIGINT) END
    AS info_version_int
FROM (
  SELECT *, (is_new AND len(w) >= 7) OR old_std OR old_conf AS valid,
         is_new OR old_std OR old_conf AS is_etl,
         CASE WHEN is_new THEN 3 WHEN old_std THEN 2 WHEN old_conf THEN 3 END AS off
  FROM (
    SELECT *, string_split(name, ' ') AS w, starts_with(name, 'Enceladus') AS is_new,
           starts_with(name, 'Standardisation ') AND len(string_split(name, ' ')) = 6 AS old_std,
           starts_with(name, 'Dynamic Conformance ') AND len(string_split(name, ' ')) = 7 AS old_conf
    FROM {source}))"""


def tag_sql() -> str:
    return ("CASE WHEN is_etl THEN CASE WHEN valid THEN concat_ws('_', coalesce(type, 'None'), coalesce(app_version, "
            "'None'), coalesce(dataset, 'None'), coalesce(dataset_version, 'None')) END ELSE name END")


CLS_FIELDS = [
    "project", "app", "type", "app_version", "dataset", "dataset_version", "dataset_version_int", "info_date",
    "info_date_casted", "info_version", "info_version_int",
]


def _enriched_runs(spark, sf_dir):
    return C.enrich(V.runs_v(spark, sf_dir).select("app_id", "attempt_id", "name", "host", "user", "endTime"))


@register("filter_app_type", f"SELECT app_id, name FROM ({cls_sql('runs_v')}) WHERE is_etl")
def filter_app_type(spark, sf_dir):
    """P10: runs of the ETL application type (new prefix or old styles)."""
    return V.runs_v(spark, sf_dir).where(C.is_etl_app("name")).select("app_id", "name")


_DEFAULT_WORDS = "regexp_split_to_array(name, '[ ;,.\\-%_]')"


@register(
    "classify_default",
    f"""SELECT app_id, name AS app, name AS type, CAST(len({_DEFAULT_WORDS}) AS INTEGER) AS n_words,
  {_DEFAULT_WORDS}[1] AS word_1, {_DEFAULT_WORDS}[2] AS word_2, {_DEFAULT_WORDS}[3] AS word_3,
  {_DEFAULT_WORDS}[len({_DEFAULT_WORDS})] AS word_last, name AS tag
FROM runs_v""",
)
def classify_default(spark, sf_dir):
    """Default classification (app, type, positional words) and tag."""
    r = V.runs_v(spark, sf_dir)
    d = C.default_classification("name")
    return r.select(
        "app_id", d["app"].alias("app"), d["type"].alias("type"), F.size(d["words"]).alias("n_words"),
        F.get(d["words"], 0).alias("word_1"), F.get(d["words"], 1).alias("word_2"),
        F.get(d["words"], 2).alias("word_3"), F.element_at(d["words"], -1).alias("word_last"),
        F.col("name").alias("tag"),
    )


@register(
    "classify_etl",
    f"SELECT app_id, name, {', '.join(CLS_FIELDS)} FROM ({cls_sql('runs_v')}) WHERE is_etl",
)
def classify_etl(spark, sf_dir):
    """ETL classification of ETL runs (NULL fields when malformed)."""
    e = _enriched_runs(spark, sf_dir).where("is_etl")
    return e.select("app_id", "name", *[F.col("classification")[f].alias(f) for f in CLS_FIELDS])


@register(
    "classify_etl_old",
    f"SELECT app_id, name, {', '.join(CLS_FIELDS)} FROM ({cls_sql('runs_v')}) WHERE old_std OR old_conf",
)
def classify_etl_old(spark, sf_dir):
    """Classification of the two old naming styles."""
    r = V.runs_v(spark, sf_dir).where(C.is_old_standardization("name") | C.is_old_conformance("name"))
    cl = C.etl_classification("name")
    return r.select("app_id", "name", *[cl[f].alias(f) for f in CLS_FIELDS])


@register("etl_tag", f"SELECT app_id, {tag_sql()} AS tag FROM ({cls_sql('runs_v')}) WHERE is_etl")
def q_etl_tag(spark, sf_dir):
    """ETL tag type_appversion_dataset_datasetversion."""
    return _enriched_runs(spark, sf_dir).where("is_etl").select("app_id", "tag")


@register(
    "top_tags",
    f"""SELECT tag, count(*) AS doc_count FROM (SELECT {tag_sql()} AS tag FROM ({cls_sql('runs_v')}))
WHERE tag IS NOT NULL GROUP BY tag HAVING count(*) >= 10 ORDER BY doc_count DESC, tag""",
)
def q_top_tags(spark, sf_dir):
    """Tags with at least 10 documents, most frequent first."""
    return C.top_tags(_enriched_runs(spark, sf_dir))


_SOME_TAG = "Daily_report-1-URGENT run.3"


@register(
    "by_tag",
    f"""SELECT app_id, attempt_id, name, host FROM (SELECT *, {tag_sql()} AS tag FROM ({cls_sql('runs_v')}))
WHERE tag = '{_SOME_TAG}' ORDER BY app_id, attempt_id""",
)
def q_by_tag(spark, sf_dir):
    """Documents of one tag."""
    e = _enriched_runs(spark, sf_dir)
    return C.by_tag(e, _SOME_TAG, order=K).select(*K, "name", "host")


@register(
    "by_id",
    """SELECT app_id || '-' || coalesce(attempt_id, '0') AS uid, app_id, name FROM runs_v
WHERE app_id || '-' || coalesce(attempt_id, '0') IN ('application_7-1', 'application_4242-1')
   OR app_id = 'application_77'""",
)
def q_by_id(spark, sf_dir):
    """Look up documents by full id '{app}-{attempt}' and by application id."""
    r = V.runs_v(spark, sf_dir).withColumn("uid", C.doc_uid("app_id", "attempt_id"))
    hit = r.where(F.col("uid").isin("application_7-1", "application_4242-1") | (F.col("app_id") == "application_77"))
    return hit.select("uid", "app_id", "name")


# ---------------------------------------------------------------------------
# Spark properties
# ---------------------------------------------------------------------------

_DROP = ", ".join(f"'{k}'" for k in DROP_KEYS["sparkProperties"])
PV_SQL = f"""pv AS (
  SELECT app_id, attempt_id, replace(key, '.', '_') AS key, arg_max(value, pos) AS value
  FROM props_v GROUP BY ALL
), pc AS (SELECT * FROM pv WHERE key NOT IN ({_DROP}))"""


def _prop(key: str) -> str:
    return f"max(CASE WHEN key = '{key}' THEN value END)"


@register(
    "props_typed",
    f"""WITH {PV_SQL}
SELECT app_id, attempt_id,
  {r4(sql_suffix_parse(_prop('spark_executor_memory'), SIZE_UNITS, 1))} AS executor_memory,
  TRY_CAST({_prop('spark_executor_cores')} AS BIGINT) AS executor_cores,
  CASE WHEN lower({_prop('spark_dynamicAllocation_enabled')}) IN ('true','1','y','yes') THEN true
       WHEN lower({_prop('spark_dynamicAllocation_enabled')}) IN ('false','0','n','no') THEN false END AS dynamic_allocation,
  {r4(sql_suffix_parse(_prop('spark_network_timeout'), TIME_UNITS, 1000))} AS network_timeout_ms,
  {r4(sql_suffix_parse(_prop('spark_executor_memoryOverhead'), SIZE_UNITS, 1048576))} AS executor_memory_overhead,
  {r4(sql_suffix_parse(_prop('spark_yarn_scheduler_heartbeat_interval-ms'), TIME_UNITS, 1))} AS heartbeat_ms,
  CAST(count(*) FILTER (WHERE key NOT IN ('spark_executor_memory', 'spark_executor_cores',
    'spark_dynamicAllocation_enabled', 'spark_network_timeout', 'spark_executor_memoryOverhead',
    'spark_yarn_scheduler_heartbeat_interval-ms')) AS INTEGER) AS n_untyped
FROM pc GROUP BY ALL""",
)
def props_typed(spark, sf_dir):
    """Property pairs -> map (later duplicate wins, listed keys
    dropped) -> typed columns per the cast table."""
    keys = [
        "spark_executor_memory", "spark_executor_cores", "spark_dynamicAllocation_enabled", "spark_network_timeout",
        "spark_executor_memoryOverhead", "spark_yarn_scheduler_heartbeat_interval-ms",
    ]
    env = P.clean_environment(V.env_v(spark, sf_dir), typed_keys=keys)
    t = F.col("typedProperties")
    return env.select(
        *K,
        t["spark_executor_memory"].alias("executor_memory"),
        t["spark_executor_cores"].alias("executor_cores"),
        t["spark_dynamicAllocation_enabled"].alias("dynamic_allocation"),
        t["spark_network_timeout"].alias("network_timeout_ms"),
        t["spark_executor_memoryOverhead"].alias("executor_memory_overhead"),
        t["spark_yarn_scheduler_heartbeat_interval-ms"].alias("heartbeat_ms"),
        F.when(F.col("sparkProperties").isNotNull(), F.size(P.untyped_properties(F.col("sparkProperties"))))
        .alias("n_untyped"),
    )


@register(
    "proj_drop_fields",
    f"""WITH {PV_SQL}
SELECT app_id, attempt_id, string_agg(key, ',' ORDER BY key) AS property_keys, count(*) AS n_properties,
       '17' AS java_version, false AS has_java_home
FROM pc GROUP BY ALL""",
)
def proj_drop_fields(spark, sf_dir):
    """Listed properties, runtime.javaHome and the bulky sections dropped."""
    env = P.clean_environment(V.env_v(spark, sf_dir), typed_keys=[])
    keys = F.array_sort(F.map_keys("sparkProperties"))
    runtime_fields = env.schema["runtime"].dataType.fieldNames()
    return env.select(
        *K, F.array_join(keys, ",").alias("property_keys"), F.size(keys).cast("bigint").alias("n_properties"),
        F.col("runtime.javaVersion").alias("java_version"), F.lit("javaHome" in runtime_fields).alias("has_java_home"),
    )


@register(
    "config_stats",
    f"""WITH {PV_SQL}
SELECT key, value, count(*) AS n_apps FROM pc GROUP BY key, value""",
)
def config_stats(spark, sf_dir):
    """K7: how many applications ran with each configuration value."""
    env = P.clean_environment(V.env_v(spark, sf_dir), typed_keys=[])
    kv = env.select(F.explode("sparkProperties").alias("key", "value"))
    return kv.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n_apps"))


# ---------------------------------------------------------------------------
# application documents
# ---------------------------------------------------------------------------

_GMT_SQL = "'%Y-%m-%dT%H:%M:%S.%gGMT'"


def _attempts(spark, sf_dir):
    return P.flatten_attempts(V.apps_v(spark, sf_dir))


@register(
    "proj_parse_gmt",
    f"""SELECT id, attempt_pos, try_strptime(startTime, {_GMT_SQL}) AS startTime,
  try_strptime(endTime, {_GMT_SQL}) AS endTime, try_strptime(lastUpdated, {_GMT_SQL}) AS lastUpdated
FROM attempts_raw_v""",
)
def proj_parse_gmt(spark, sf_dir):
    """GMT time strings of attempts cast to timestamps (malformed -> NULL)."""
    a = _attempts(spark, sf_dir)
    flat = a.select("id", "attempt_pos", "attempt.*").drop("attemptId", "duration")
    return P.parse_time_fields(flat, "attempt").select("id", "attempt_pos", "startTime", "endTime", "lastUpdated")


@register(
    "flatten_attempts",
    """SELECT id, attempt_pos, attemptId, duration,
  attemptId IS NULL OR attemptId = first(attemptId ORDER BY attempt_pos) OVER (PARTITION BY id) AS isFinalAttempt
FROM attempts_raw_v""",
)
def flatten_attempts(spark, sf_dir):
    """One row per attempt with the final-attempt flag."""
    a = _attempts(spark, sf_dir)
    return a.select("id", "attempt_pos", F.col("attempt.attemptId").alias("attemptId"),
                    F.col("attempt.duration").alias("duration"), "isFinalAttempt")


@register(
    "last_attempt",
    "SELECT id, attemptId, startTime, endTime FROM attempts_raw_v WHERE attempt_pos = 0",
)
def last_attempt(spark, sf_dir):
    """Keep only the newest attempt of each application."""
    a = P.last_attempt(V.apps_v(spark, sf_dir))
    return a.select("id", F.explode("attempts").alias("a")).select(
        "id", "a.attemptId", "a.startTime", "a.endTime"
    )


@register(
    "agg_uid",
    "SELECT id || '-' || coalesce(attemptId, '0') AS uid, id, attempt_pos FROM attempts_raw_v",
)
def agg_uid(spark, sf_dir):
    """Aggregate document id '{app}-{attempt or 0}'."""
    a = _attempts(spark, sf_dir)
    return a.select(C.doc_uid("id", "attempt.attemptId").alias("uid"), "id", "attempt_pos")


@register(
    "apps_chronological",
    f"""SELECT id, attempt_pos, try_strptime(endTime, {_GMT_SQL}) AS end_time FROM attempts_raw_v
ORDER BY end_time, id, attempt_pos""",
)
def apps_chronological(spark, sf_dir):
    """Attempts oldest first (explicit sort on end time, then id)."""
    a = P.parse_time_fields(_attempts(spark, sf_dir).select("id", "attempt_pos", "attempt.endTime"), "attempt")
    return a.select("id", "attempt_pos", F.col("endTime").alias("end_time")).orderBy("end_time", "id", "attempt_pos")


@register(
    "merge_app_doc",
    """WITH ex AS (SELECT app_id, coalesce(attempt_id, '0') AS attempt_id, count(*) AS n_executors
             FROM executors_v GROUP BY ALL),
     st AS (SELECT app_id, coalesce(attempt_id, '0') AS attempt_id, count(*) AS n_stages,
                   count(*) FILTER (WHERE status = 'COMPLETE') AS n_complete_stages FROM stages_v GROUP BY ALL),
     en AS (SELECT app_id, attempt_id, count(*) AS n_property_pairs FROM props_v GROUP BY ALL)
SELECT r.app_id, coalesce(r.attempt_id, '0') AS attempt_id, r.name, ex.n_executors, st.n_stages,
       st.n_complete_stages, en.n_property_pairs
FROM runs_v r
LEFT JOIN ex ON ex.app_id = r.app_id AND ex.attempt_id = coalesce(r.attempt_id, '0')
LEFT JOIN st ON st.app_id = r.app_id AND st.attempt_id = coalesce(r.attempt_id, '0')
LEFT JOIN en ON en.app_id = r.app_id AND en.attempt_id = coalesce(r.attempt_id, '0')""",
)
def merge_app_doc(spark, sf_dir):
    """Attempt joined with its executors, stages and environment on
    (app_id, attempt_id), a missing attempt id meaning '0'."""
    runs, ex, st = V.runs_v(spark, sf_dir), V.executors_v(spark, sf_dir), V.stages_v(spark, sf_dir)
    env = V.env_v(spark, sf_dir).select(*K, F.when(F.col("sparkProperties").isNotNull(), F.size("sparkProperties")).cast("bigint")
                                             .alias("n_property_pairs"))
    m = P.merge_app_doc(runs.select(*K, "name"), ex, st, env, nested=False, stage_status="COMPLETE")
    return m.select(*K, "name", "n_executors", "n_stages", F.col("n_status_stages").alias("n_complete_stages"),
                    "n_property_pairs")


@register(
    "stamp_meta",
    """SELECT app_id, TIMESTAMP '2024-02-01 00:00:00' AS time_processed,
  'hist-' || substr(host, 6) || '.example.org' AS history_host
FROM runs_v""",
)
def q_stamp_meta(spark, sf_dir):
    """Processing stamp: the processing time (a parameter) and the
    history server host taken from its URL."""
    r = V.runs_v(spark, sf_dir)
    url = F.concat(F.lit("http://hist-"), F.substring_index("host", "-", -1), F.lit(".example.org:18080/api/v1"))
    s = P.stamp_meta(r.select("app_id", url.alias("url")), F.lit("2024-02-01 00:00:00"), "url")
    return s.select("app_id", F.col("meta.time_processed").alias("time_processed"),
                    F.col("meta.history_host").alias("history_host"))
