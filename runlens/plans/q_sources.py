"""Queries: source reads, filters and store statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.plans import views as V
from runlens.plans.catalog import register
from runlens.sources import telemetry as S

K = ["app_id", "attempt_id"]
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]
_GMT_SQL = "'%Y-%m-%dT%H:%M:%S.%gGMT'"


@register(
    "src_apps_filtered",
    f"""SELECT id, any_value(name) AS name, count(*) AS n_attempts FROM attempts_raw_v
WHERE id IN (SELECT id FROM attempts_raw_v WHERE endTime IS NOT NULL
             AND try_strptime(startTime, {_GMT_SQL}) >= TIMESTAMP '1995-01-01 00:00:00'
             AND try_strptime(endTime, {_GMT_SQL}) <= TIMESTAMP '1996-12-31 23:59:59')
GROUP BY id""",
)
def src_apps_filtered(spark, sf_dir):
    """Completed applications with an attempt started from 1995 and ended by 1996."""
    apps = S.list_apps(V.apps_v(spark, sf_dir), status="completed", min_date="1995-01-01 00:00:00",
                       max_end_date="1996-12-31 23:59:59")
    return apps.select("id", "name", F.when(F.col("attempts").isNotNull(), F.size("attempts")).cast("bigint")
                       .alias("n_attempts"))


@register(
    "src_executors",
    "SELECT e.app_id, e.attempt_id, e.id, e.totalCores FROM executors_v e "
    "WHERE (e.app_id, e.attempt_id) IN (SELECT (app_id, attempt_id) FROM runs_v WHERE host = 'host-2')",
)
def src_executors(spark, sf_dir):
    """Executors of the listed attempts (attempts of one host)."""
    att = V.runs_v(spark, sf_dir).where(F.col("host") == "host-2")
    ex = V.executors_v(spark, sf_dir)
    return S.attempt_children(att, ex).select(*K, "id", "totalCores")


@register(
    "src_stages",
    "SELECT s.app_id, s.attempt_id, s.stageId, s.status FROM stages_v s WHERE s.status = 'COMPLETE' "
    "AND (s.app_id, s.attempt_id) IN (SELECT (app_id, attempt_id) FROM runs_v WHERE host = 'host-2')",
)
def src_stages(spark, sf_dir):
    """S3: completed stages of the listed attempts."""
    att = V.runs_v(spark, sf_dir).where(F.col("host") == "host-2")
    return S.attempt_children(att, V.stages_v(spark, sf_dir), status="COMPLETE").select(*K, "stageId", "status")


@register(
    "schema_evolution_union",
    """SELECT app_id, attempt_id, id, totalCores, NULL::BIGINT AS maxMemory FROM executors_v WHERE id = 'driver'
UNION ALL SELECT app_id, attempt_id, id, totalCores, maxMemory FROM executors_v WHERE id <> 'driver'""",
)
def schema_evolution_union(spark, sf_dir):
    """Documents of an older schema (no maxMemory) and a newer one unioned by name."""
    ex = V.executors_v(spark, sf_dir)
    old = ex.where(F.col("id") == "driver").select(*K, "id", "totalCores")
    new = ex.where(F.col("id") != "driver").select(*K, "id", "totalCores", "maxMemory")
    return S.evolve_union([old, new])


@register(
    "table_stats",
    "\nUNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS docs_count FROM {t}" for t in TABLES),
)
def q_table_stats(spark, sf_dir):
    """Document count per table (``table_stats`` also gives bytes, which SQL cannot see)."""
    st = S.table_stats(spark, {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES})
    return st.select("table", "docs_count")


@register(
    "src_environment",
    "SELECT app_id, attempt_id, count(*) AS n_property_pairs FROM props_v "
    "WHERE (app_id, attempt_id) IN (SELECT (app_id, attempt_id) FROM runs_v WHERE host = 'host-2') GROUP BY ALL",
)
def src_environment(spark, sf_dir):
    """Environment documents of the listed attempts (attempts of one host)."""
    att = V.runs_v(spark, sf_dir).where(F.col("host") == "host-2")
    # counted before the join, which then shuffles a number instead of the pairs
    n = F.when(F.col("sparkProperties").isNotNull(), F.size("sparkProperties")).cast("bigint")
    env = V.env_v(spark, sf_dir).select(*K, n.alias("n_property_pairs"))
    return S.attempt_children(att, env).select(*K, "n_property_pairs")


@register(
    "store_not_empty",
    "SELECT host, coalesce(bool_or(processed), false) AS not_empty FROM polls_v GROUP BY host",
)
def store_not_empty(spark, sf_dir):
    """Per store (host), whether it holds any document; computed as a
    distributed count (``not_empty`` is the single-store driver check)."""
    p = V.polls_v(spark, sf_dir).where("processed")
    return V.polls_v(spark, sf_dir).select("host").distinct().join(
        p.groupBy("host").agg((F.count(F.lit(1)) > 0).alias("not_empty")), "host", "left"
    ).select("host", F.coalesce("not_empty", F.lit(False)).alias("not_empty"))
