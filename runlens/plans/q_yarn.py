"""Queries: cluster-manager applications, statistics and scheduler snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import yarn as Y
from runlens.plans import views as V
from runlens.plans.catalog import register
from runlens.plans.oracle_views import r4
from runlens.plans.q_docs import cls_sql, tag_sql


@register(
    "yarn_apps_filtered",
    """SELECT * EXCLUDE (allocatedMB) FROM yarn_v
WHERE state IN ('FINISHED', 'FAILED') AND applicationType IN ('SPARK') AND queue = 'root.q1'
  AND finishedTime >= epoch_ms(TIMESTAMP '2024-01-05 00:00:00') AND finishedTime <= epoch_ms(TIMESTAMP '2024-01-25 00:00:00')
  AND list_has_any(string_split(applicationTags, ','), ['tag0', 'tag1', 'tag2', 'tag4'])""",
)
def yarn_apps_filtered(spark, sf_dir):
    """Application list with state, type, queue, finish-time and tag filters, one field deselected."""
    return Y.filter_apps(
        V.yarn_v(spark, sf_dir), states=["FINISHED", "FAILED"], applicationTypes=["SPARK"], queue="root.q1",
        finishedTimeBegin="2024-01-05 00:00:00", finishedTimeEnd="2024-01-25 00:00:00",
        applicationTags=["tag0", "tag1", "tag2", "tag4"], deSelects=["allocatedMB"],
    )


@register(
    "yarn_apps_enriched",
    f"""SELECT id, make_timestamp(startedTime * 1000) AS startedTime, make_timestamp(finishedTime * 1000) AS finishedTime,
  {tag_sql()} AS tag, is_etl, type AS etl_type, TIMESTAMP '2024-02-01 00:00:00' AS time_processed,
  'rm-1.example.org' AS yarn_host
FROM ({cls_sql('yarn_v')})""",
)
def yarn_apps_enriched(spark, sf_dir):
    """Times from epoch ms, classification and tag, processing stamp."""
    e = Y.enrich_apps(V.yarn_v(spark, sf_dir), F.lit("2024-02-01 00:00:00"), "http://rm-1.example.org:8088/ws/v1")
    return e.select(
        "id", "startedTime", "finishedTime", "tag", "is_etl", F.col("classification.type").alias("etl_type"),
        F.col("meta.time_processed").alias("time_processed"), F.col("meta.yarn_host").alias("yarn_host"),
    )


@register(
    "yarn_app_stats_pivot",
    """WITH c AS (SELECT applicationType AS app_type, state, count(*) AS n FROM yarn_v GROUP BY ALL),
p AS (SELECT * FROM c WHERE app_type IN ('SPARK', 'MAPREDUCE')
      UNION ALL SELECT 'all', state, sum(n) FROM c GROUP BY state)
SELECT app_type, CAST(sum(n) FILTER (WHERE state = 'FINISHED') AS BIGINT) AS FINISHED,
  CAST(sum(n) FILTER (WHERE state = 'FAILED') AS BIGINT) AS FAILED,
  CAST(sum(n) FILTER (WHERE state = 'KILLED') AS BIGINT) AS KILLED,
  CAST(sum(n) FILTER (WHERE state = 'RUNNING') AS BIGINT) AS RUNNING
FROM p GROUP BY app_type""",
)
def yarn_app_stats_pivot(spark, sf_dir):
    """Application counts per type (all, SPARK, MAPREDUCE) and state."""
    return Y.app_stats(V.yarn_v(spark, sf_dir))


_Q = [("default", 0), ("etl", 1), ("adhoc", 2)]


@register(
    "yarn_cluster_doc",
    """SELECT o_orderkey AS snapshot_id, 'adhoc,default,etl' AS queue_names,
  CAST(o_orderkey % 7 AS INTEGER) AS apps_default, CAST(o_orderkey % 7 + 1 AS INTEGER) AS apps_etl,
  CAST(o_orderkey % 7 + 2 AS INTEGER) AS apps_adhoc, 2 AS n_queue_fields, false AS has_health,
  o_custkey % 100 AS apps_submitted, o_orderkey % 1000 AS available_mb,
  o_custkey % 50 AS all_running, o_custkey % 30 AS spark_running, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 20 END AS spark_failed
FROM orders""",
)
def yarn_cluster_doc(spark, sf_dir):
    """Single cluster document per snapshot: queues keyed by name,
    cluster metrics, application counts by type and state."""
    d = Y.cluster_doc(V.scheduler_v(spark, sf_dir))
    stats = F.col("appStatInfo")
    q = F.col("schedulerInfo.queues")
    return d.select(
        "snapshot_id",
        F.array_join(F.array_sort(F.map_keys(q)), ",").alias("queue_names"),
        q["default"]["numApplications"].alias("apps_default"),
        q["etl"]["numApplications"].alias("apps_etl"),
        q["adhoc"]["numApplications"].alias("apps_adhoc"),
        F.lit(len(d.schema["schedulerInfo"].dataType["queues"].dataType.valueType.fields)).alias("n_queue_fields"),
        F.lit("health" in d.schema["schedulerInfo"].dataType.fieldNames()).alias("has_health"),
        F.col("clusterMetrics")["appsSubmitted"].alias("apps_submitted"), F.col("clusterMetrics")["availableMB"].alias("available_mb"),
        stats["all"]["RUNNING"].alias("all_running"), stats["SPARK"]["RUNNING"].alias("spark_running"),
        stats["SPARK"]["FAILED"].alias("spark_failed"),
    )


def _sched_sql() -> str:
    tp = "o_orderdate + to_seconds(o_orderkey % 86400)"
    cols = ("snapshot_id, time_processed, doc_type, partitionName, capacity, usedCapacity, maxCapacity, queueName, "
            "used_memory, used_vCores, username, numApplications")

    def row(doc, part="NULL", cap="NULL", used="NULL", maxc="NULL", q="NULL", mem="NULL", cores="NULL", user="NULL",
            napps="NULL", where=""):
        return (f"SELECT o_orderkey AS snapshot_id, {tp} AS time_processed, '{doc}' AS doc_type, {part} AS partitionName, "
                f"CAST({cap} AS DOUBLE) AS capacity, CAST({used} AS DOUBLE) AS usedCapacity, CAST({maxc} AS DOUBLE) AS maxCapacity, "
                f"{q} AS queueName, CAST({mem} AS BIGINT) AS used_memory, CAST({cores} AS INTEGER) AS used_vCores, "
                f"{user} AS username, CAST({napps} AS INTEGER) AS numApplications FROM orders")

    rows = [
        row("queueCapacitiesByPartition", "''", "100.0", "o_totalprice % 100", "100.0"),
        row("queueCapacitiesByPartition", "'gpu'", "50.0", "o_custkey % 50", "100.0"),
    ]
    cust = "'cust_' || CAST(o_custkey AS VARCHAR)"
    clerk = "'clerk_' || CAST(o_orderkey % 10 AS VARCHAR)"
    for name, i in _Q:
        qn = f"'{name}'"
        rows.append(row("queue_queueCapacitiesByPartition", "''", f"{30.0 + 10 * i}", f"o_orderkey % {10 + i}", q=qn))
        rows.append(row("queue_queueCapacitiesByPartition", "'gpu'", f"{10.0 * i}", f"o_custkey % {3 + i}", q=qn))
        rows.append(row("queue_resourceUsagesByPartition", "''", q=qn, mem=f"(o_orderkey % 32) * 1024 * {i + 1}",
                        cores=f"o_orderkey % 8 + {i}"))
        rows.append(row("queue_resourceUsagesByPartition", "'gpu'", q=qn, mem=f"(o_custkey % 8) * 512 * {i + 1}",
                        cores=f"o_custkey % 2 + {i}"))
        users = {"default": [cust], "etl": [cust, clerk], "adhoc": []}[name]
        for u in users:
            rows.append(row("user_resourceUsagesByPartition", "''", q=qn, mem="(o_custkey % 16) * 1024",
                            cores="o_custkey % 4 + 1", user=u))
            rows.append(row("user", q=qn, user=u))
        rows.append(row("queue", q=qn, napps=f"o_orderkey % 7 + {i}"))
    body = "\nUNION ALL ".join(rows)
    out_cols = cols.replace("usedCapacity", f"{r4('usedCapacity')} AS usedCapacity")
    return f"SELECT {out_cols} FROM ({body})"


@register("yarn_scheduler_docs", _sched_sql())
def yarn_scheduler_docs(spark, sf_dir):
    """Scheduler snapshot exploded into six document types."""
    d = Y.scheduler_docs(V.scheduler_v(spark, sf_dir))
    return d.select(
        "snapshot_id", "time_processed", "doc_type", "partitionName", "capacity", "usedCapacity", "maxCapacity",
        "queueName", "used_memory", "used_vCores", "username", "numApplications",
    )


@register("yarn_app_by_id", "SELECT id, name, state, finishedTime FROM yarn_v WHERE id IN ('application_y42', 'application_y4242')")
def yarn_app_by_id(spark, sf_dir):
    """One cluster-manager application by id (a filter over the whole table)."""
    apps = V.yarn_v(spark, sf_dir)
    return apps.where(F.col("id").isin("application_y42", "application_y4242")).select("id", "name", "state", "finishedTime")
