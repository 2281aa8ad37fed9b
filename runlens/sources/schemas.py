"""Declared schemas of the landed telemetry.

Reading with a declared schema (no inference) keeps every file's columns
typed the same way; fields a file lacks come back NULL, malformed records
land in ``_corrupt_record`` (PERMISSIVE mode).  Times are strings as landed
and are typed by ``runlens.operators.cleanse``.
"""

from pyspark.sql import types as T

from runlens.constants import ERROR_DOC_ROOT

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _f(name, t, nullable=True):
    return T.StructField(name, t, nullable)


EXECUTOR = T.StructType([
    _f("id", S), _f("hostPort", S), _f("isActive", B), _f("addTime", S), _f("removeTime", S), _f("totalCores", I),
    _f("maxMemory", L), _f("totalDuration", L), _f("totalInputBytes", L), _f("totalTasks", I), _f("failedTasks", I),
    _f("totalGCTime", L), _f("memoryMetrics", T.StructType([_f("usedOnHeapStorageMemory", L)])),
    _f("executorLogs", T.MapType(S, S)), _f("attributes", T.MapType(S, S)),
])

STAGE = T.StructType([
    _f("stageId", I), _f("attemptId", I), _f("status", S), _f("submissionTime", S), _f("firstTaskLaunchedTime", S),
    _f("completionTime", S), _f("inputBytes", L), _f("inputRecords", L), _f("outputBytes", L), _f("outputRecords", L),
    _f("executorCpuTime", L), _f("executorRunTime", L), _f("numTasks", I), _f("numCompleteTasks", I), _f("name", S),
    _f("details", S),
])

ENVIRONMENT = T.StructType([
    _f("sparkProperties", T.ArrayType(T.ArrayType(S))),
    _f("runtime", T.StructType([_f("javaVersion", S), _f("javaHome", S), _f("scalaVersion", S)])),
    _f("systemProperties", T.ArrayType(T.ArrayType(S))),
    _f("classpathEntries", T.ArrayType(T.ArrayType(S))),
])

ATTEMPT = T.StructType([
    _f("attemptId", S), _f("startTime", S), _f("endTime", S), _f("lastUpdated", S), _f("duration", L),
    _f("sparkUser", S), _f("completed", B),
    _f("allexecutors", T.ArrayType(EXECUTOR)), _f("stages", T.ArrayType(STAGE)), _f("environment", ENVIRONMENT),
])

APPLICATION = T.StructType([
    _f("id", S), _f("name", S), _f("attempts", T.ArrayType(ATTEMPT)), _f("_corrupt_record", S),
])

CONTROL = T.StructType([_f("controlName", S), _f("controlValue", S)])
CHECKPOINT = T.StructType([
    _f("name", S), _f("processStartTime", S), _f("processEndTime", S), _f("controls", T.ArrayType(CONTROL)),
])
ETL_RUN = T.StructType([
    _f("uniqueId", S), _f("dataset", S), _f("datasetVersion", I), _f("startDateTime", S),
    _f("controlMeasure", T.StructType([
        _f("metadata", T.StructType([_f("version", I), _f("informationDate", S), _f("additionalInfo", T.MapType(S, S))])),
        _f("checkpoints", T.ArrayType(CHECKPOINT)),
    ])),
])

YARN_APP = T.StructType([
    _f("id", S), _f("name", S), _f("user", S), _f("queue", S), _f("state", S), _f("finalStatus", S),
    _f("applicationType", S), _f("applicationTags", S), _f("startedTime", L), _f("finishedTime", L),
    _f("elapsedTime", L), _f("allocatedMB", L), _f("allocatedVCores", I),
])

ERROR = T.StructType([
    _f(ERROR_DOC_ROOT, T.StructType([
        _f("time_processed", T.TimestampType()), _f("spark_app_id", S), _f("history_host", S), _f("yarn_host", S),
        _f("error", T.StructType([_f("type", S), _f("message", S), _f("stage", S)])),
    ])),
])

# flat tables: executors and stages keyed by (app_id, attempt_id)
KEYS = [_f("app_id", S), _f("attempt_id", S)]
EXECUTOR_FLAT = T.StructType(KEYS + EXECUTOR.fields)
STAGE_FLAT = T.StructType(KEYS + STAGE.fields)

YARN_ATTEMPT = T.StructType([
    _f("appId", S), _f("id", I), _f("appAttemptId", S), _f("startTime", L), _f("finishedTime", L),
    _f("containerId", S), _f("nodeId", S), _f("appAttemptState", S),
])

YARN_CONTAINER = T.StructType([
    _f("appId", S), _f("appAttemptId", S), _f("containerId", S), _f("allocatedMB", L), _f("allocatedVCores", I),
    _f("assignedNodeId", S), _f("priority", I), _f("startedTime", L), _f("finishedTime", L), _f("containerState", S),
])

# cluster-manager scheduler snapshot (fields used by the scheduler documents)
PARTITION_CAPACITY = T.StructType([
    _f("partitionName", S), _f("capacity", D), _f("usedCapacity", D), _f("maxCapacity", D), _f("absoluteCapacity", D),
])
RESOURCES = T.StructType([_f("memory", L), _f("vCores", I)])
RESOURCE_USAGE = T.StructType([
    _f("partitionName", S), _f("used", RESOURCES), _f("reserved", RESOURCES), _f("pending", RESOURCES),
    _f("amUsed", RESOURCES),
])
SCHED_USER = T.StructType([
    _f("username", S), _f("numActiveApplications", I), _f("numPendingApplications", I),
    _f("resources", T.StructType([_f("resourceUsagesByPartition", T.ArrayType(RESOURCE_USAGE))])),
])
SCHED_QUEUE = T.StructType([
    _f("queueName", S), _f("capacity", D), _f("usedCapacity", D), _f("numApplications", I), _f("state", S),
    _f("capacities", T.StructType([_f("queueCapacitiesByPartition", T.ArrayType(PARTITION_CAPACITY))])),
    _f("resources", T.StructType([_f("resourceUsagesByPartition", T.ArrayType(RESOURCE_USAGE))])),
    _f("users", T.StructType([_f("user", T.ArrayType(SCHED_USER))])),
])
SCHEDULER_INFO = T.StructType([
    _f("type", S), _f("capacity", D), _f("usedCapacity", D), _f("maxCapacity", D), _f("queueName", S),
    _f("capacities", T.StructType([_f("queueCapacitiesByPartition", T.ArrayType(PARTITION_CAPACITY))])),
    _f("health", T.StructType([_f("lastrun", L), _f("operationsInfo", T.ArrayType(T.MapType(S, S)))])),
    _f("queues", T.StructType([_f("queue", T.ArrayType(SCHED_QUEUE))])),
])
SCHEDULER_SNAPSHOT = T.StructType([
    _f("time_processed", S),
    _f("scheduler", T.StructType([_f("schedulerInfo", SCHEDULER_INFO)])),
    _f("clusterMetrics", T.MapType(S, L)),
    _f("appStatInfo", T.ArrayType(T.StructType([
        _f("type", S), _f("statItem", T.ArrayType(T.StructType([_f("state", S), _f("type", S), _f("count", L)])))]))),
])
