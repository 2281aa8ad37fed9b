"""Cluster-manager (YARN) records: application filters and enrichment,
application statistics, scheduler snapshots (S5, P18, P19, A17, A18, E7-E12).

Scheduler snapshots are nested documents; each document type is an
``explode`` of one nesting level (row-local, no shuffle) and the six types
are unioned by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.constants import DEFAULT_APP_TYPES, TIME_KEYS
from runlens.operators import classify as C
from runlens.operators.cleanse import stamp_meta

APP_STATES = ["FINISHED", "FAILED", "KILLED", "RUNNING"]


def _ms(value) -> Column:
    """A time parameter (string/timestamp Column) -> epoch ms, or ms as is."""
    if isinstance(value, (int,)):
        return F.lit(value)
    c = value if isinstance(value, Column) else F.lit(value).cast("timestamp")
    return F.unix_millis(c)


def filter_apps(apps: DataFrame, states=None, finalStatus=None, user=None, queue=None, limit=None,
                startedTimeBegin=None, startedTimeEnd=None, finishedTimeBegin=None, finishedTimeEnd=None,
                applicationTypes=None, applicationTags=None, name=None, deSelects=None) -> DataFrame:
    """The application list filters as one conjunctive ``where`` built
    from the given (non-None) arguments; lists match any element; time
    bounds are inclusive; ``deSelects`` drops fields; ``limit`` keeps the
    first n by id."""
    conds = []
    if states:
        conds.append(F.col("state").isin(*states))
    if finalStatus:
        conds.append(F.col("finalStatus") == F.lit(finalStatus))
    if user:
        conds.append(F.col("user") == F.lit(user))
    if queue:
        conds.append(F.col("queue") == F.lit(queue))
    if startedTimeBegin is not None:
        conds.append(F.col("startedTime") >= _ms(startedTimeBegin))
    if startedTimeEnd is not None:
        conds.append(F.col("startedTime") <= _ms(startedTimeEnd))
    if finishedTimeBegin is not None:
        conds.append(F.col("finishedTime") >= _ms(finishedTimeBegin))
    if finishedTimeEnd is not None:
        conds.append(F.col("finishedTime") <= _ms(finishedTimeEnd))
    if applicationTypes:
        conds.append(F.col("applicationType").isin(*applicationTypes))
    if applicationTags:
        tags = F.split(F.col("applicationTags"), ",")
        conds.append(F.arrays_overlap(tags, F.array(*[F.lit(t) for t in applicationTags])))
    if name:
        conds.append(F.col("name") == F.lit(name))
    out = apps
    for c in conds:
        out = out.where(c)
    if deSelects:
        out = out.drop(*deSelects)
    if limit is not None:
        out = out.orderBy("id").limit(limit)
    return out


def enrich_apps(apps: DataFrame, processed_at: Column, cluster_url: str | None = None) -> DataFrame:
    """Epoch-ms times -> timestamps, classification (ETL names get
    the ETL classification and tag, others the default one), and the
    processing stamp (time, cluster host)."""
    out = apps
    for k in TIME_KEYS["yarn_app"]:
        if k in apps.columns:
            out = out.withColumn(k, F.timestamp_millis(F.col(k)))
    out = C.enrich(out)
    return stamp_meta(out, processed_at, F.lit(cluster_url) if cluster_url else None, host_field="yarn_host")


def app_stats(apps: DataFrame, types: list[str] = DEFAULT_APP_TYPES, states: list[str] = APP_STATES,
              type_col: str = "applicationType", state_col: str = "state") -> DataFrame:
    """Application counts per type x state (pivoted); type 'all'
    counts every application.  The data is aggregated once to (type, state)
    counts; the 'all' row and the pivot work on that small result."""
    counts = apps.groupBy(type_col, state_col).agg(F.count(F.lit(1)).alias("n"))
    named = [t for t in types if t != "all"]
    per_type = counts.where(F.col(type_col).isin(*named)).select(F.col(type_col).alias("app_type"), state_col, "n")
    parts = per_type
    if "all" in types:
        total = counts.groupBy(state_col).agg(F.sum("n").alias("n")).select(F.lit("all").alias("app_type"), state_col, "n")
        parts = parts.unionByName(total)
    return parts.groupBy("app_type").pivot(state_col, states).agg(F.sum("n"))


def cluster_doc(snapshots: DataFrame, info_col: str = "schedulerInfo") -> DataFrame:
    """One document per snapshot: cluster capacities and health
    dropped, queues keyed by name with their capacities, resources and users
    dropped; the cluster metrics as they are; and the application statistics
    (an array of types, each with its items of state and count) as a map of
    maps, type -> state -> count (no type: ``all``)."""
    q = F.col(f"{info_col}.queues.queue")
    queues = F.map_from_entries(
        F.transform(q, lambda x: F.struct(x["queueName"], x.dropFields("capacities", "resources", "users")))
    )
    out = snapshots.withColumn(info_col, F.col(info_col).dropFields("capacities", "health").withField("queues", queues))
    if "appStatInfo" in snapshots.columns:
        out = out.withColumn("appStatInfo", F.map_from_entries(F.transform("appStatInfo", lambda t: F.struct(
            F.coalesce(t["type"], F.lit("all")),
            F.map_from_entries(F.transform(t["statItem"], lambda s: F.struct(s["state"], s["count"])))))))
    return out


def _tag(df: DataFrame, doc_type: str) -> DataFrame:
    return df.withColumn("doc_type", F.lit(doc_type))


def scheduler_docs(snapshots: DataFrame, keep: list[str] = ("snapshot_id", "time_processed"),
                   info_col: str = "schedulerInfo") -> DataFrame:
    """One row per capacity/usage entry, user and queue, tagged with
    its document type, unioned by name (missing fields NULL).  A queue
    without users contributes no user rows."""
    keep = list(keep)
    si = F.col(info_col)
    e7 = _tag(snapshots.select(*keep, F.explode(si["capacities"]["queueCapacitiesByPartition"]).alias("d")).select(*keep, "d.*"),
              "queueCapacitiesByPartition")
    queues = snapshots.select(*keep, F.explode(si["queues"]["queue"]).alias("q"))
    qn = F.col("q.queueName").alias("queueName")
    e8 = _tag(queues.select(*keep, qn, F.explode("q.capacities.queueCapacitiesByPartition").alias("d"))
              .select(*keep, "queueName", "d.*"), "queue_queueCapacitiesByPartition")
    e9 = _tag(queues.select(*keep, qn, F.explode("q.resources.resourceUsagesByPartition").alias("d"))
              .select(*keep, "queueName", "d.*"), "queue_resourceUsagesByPartition")
    users = queues.select(*keep, qn, F.explode("q.users.user").alias("u"))
    e10 = _tag(users.select(*keep, "queueName", F.col("u.username").alias("username"),
                            F.explode("u.resources.resourceUsagesByPartition").alias("d"))
               .select(*keep, "queueName", "username", "d.*"), "user_resourceUsagesByPartition")
    e11 = _tag(users.select(*keep, "queueName", F.col("u").dropFields("resources").alias("u")).select(*keep, "queueName", "u.*"),
               "user")
    e12 = _tag(queues.select(*keep, F.col("q").dropFields("capacities", "resources", "users").alias("q")).select(*keep, "q.*"),
               "queue")
    out = e7
    for part in (e8, e9, e10, e11, e12):
        out = out.unionByName(part, allowMissingColumns=True)
    return out
