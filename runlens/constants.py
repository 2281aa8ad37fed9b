"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the behaviour of
the telemetry format being read (key names, unit tables, format strings,
lists of dropped or typed keys).  They are stated plainly, in natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: sizes and units
# ---------------------------------------------------------------------------

HDFS_BLOCK_BYTES = 128 * 1024 * 1024
GIB = 1024 * 1024 * 1024
MIB = 1024 * 1024
KIB = 1024

# Size suffixes and their byte multipliers; the first suffix the text ends
# with is taken.
SIZE_UNITS = {
    "k": 1024,
    "m": 1024 ** 2,
    "g": 1024 ** 3,
    "t": 1024 ** 4,
    "p": 1024 ** 5,
    "kb": 1024,
    "mb": 1024 ** 2,
    "gb": 1024 ** 3,
    "tb": 1024 ** 4,
    "pb": 1024 ** 5,
    "b": 1,
}

# Time suffixes and their millisecond multipliers; the first suffix the text
# ends with is taken (so '5us' keeps a 'u' and does not parse).
TIME_UNITS = {
    "ms": 1,
    "s": 1000,
    "m": 60 * 1000,
    "min": 60 * 1000,
    "h": 60 * 60 * 1000,
    "d": 24 * 60 * 60 * 1000,
}

# A decimal number with one leading digit ('10.5' is none), as the format's
# own check has it.
STRICT_FLOAT_PATTERN = r"^[+-]?[0-9](>?\.[0-9]+)?$"

# Human readable size prefixes.
SIZEOF_PREFIXES = ["", "k", "M", "G", "T"]

# ---------------------------------------------------------------------------
# FIXED VALUES: time formats
# ---------------------------------------------------------------------------

# History-server times, e.g. 2020-01-15T14:59:33.707GMT
GMT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'GMT'"

# ETL run start times, tried in this order.  With zone, day first; with zone,
# year first; no zone, day first; no zone, year first.
RUN_DATE_FORMATS_ZONED = ["d-M-yyyy H:m:s Z", "yyyy-M-d H:m:s Z"]
RUN_DATE_FORMATS_ZONED_COLON = ["d-M-yyyy H:m:s XXX", "yyyy-M-d H:m:s XXX"]
RUN_DATE_FORMATS_LOCAL = ["d-M-yyyy H:m:s", "yyyy-M-d H:m:s"]

# ETL information dates, tried in this order.
INFO_DATE_FORMATS = ["d-M-yyyy", "yyyy-M-d"]

# ---------------------------------------------------------------------------
# FIXED VALUES: time keys per document type
# ---------------------------------------------------------------------------

TIME_KEYS = {
    "attempt": ["startTime", "endTime", "lastUpdated"],
    "executor": ["addTime", "removeTime"],
    "stage": ["submissionTime", "firstTaskLaunchedTime", "completionTime"],
    "yarn_app": ["startedTime", "finishedTime"],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: dropped keys per document type
# ---------------------------------------------------------------------------

DROP_KEYS = {
    "executor": ["hostPort", "executorLogs"],
    "stage": ["details"],
    "attempt": [],
    "environment": ["systemProperties", "classpathEntries"],
    "runtime": ["javaHome"],
    "sparkProperties": [
        "spark_driver_host",
        "spark_driver_port",
        "spark_jars",
        "spark_eventLog_dir",
        "spark_driver_appUIAddress",
        "spark_ui_filters",
        "spark_org_apache_hadoop_yarn_server_webproxy_amfilter_AmIpFilter_param_PROXY_HOSTS",
        "spark_org_apache_hadoop_yarn_server_webproxy_amfilter_AmIpFilter_param_PROXY_URI_BASES",
        "spark_yarn_app_container_log_dir",
        "spark_history_kerberos_keytab",
        "spark_org_apache_hadoop_yarn_server_webproxy_amfilter_AmIpFilter_param_RM_HA_URLS",
        "spark_history_kerberos_principal",
        "spark_driver_extraJavaOptions",
        "spark_executor_extraJavaOptions",
        "spark_executorEnv_PYTHONPATH",
        "spark_yarn_am_extraJavaOptions",
        "spark_yarn_keytab",
        "spark_yarn_principal",
    ],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: typed Spark properties (keys after '.' -> '_')
# ---------------------------------------------------------------------------

PROPERTY_CASTS = {
    "int": [
        "spark_port_maxRetries",
        "spark_executor_instances",
        "spark_driver_cores",
        "spark_executor_cores",
        "spark_dynamicAllocation_maxExecutors",
        "spark_dynamicAllocation_minExecutors",
        "spark_yarn_maxAppAttempts",
        "spark_yarn_containerLauncherMaxThreads",
        "spark_yarn_submit_file_replication",
    ],
    "float": [
        "spark_dynamicAllocation_executorAllocationRatio",
        "spark_memory_fraction",
    ],
    "bool": [
        "spark_eventLog_enabled",
        "spark_logConf",
        "spark_hadoop_yarn_timeline-service_enabled",
        "spark_dynamicAllocation_enabled",
        "spark_history_fs_cleaner_enabled",
        "spark_rdd_compress",
        "spark_shuffle_service_enabled",
        "spark_speculation",
        "spark_sql_adaptive_enabled",
        "spark_sql_hive_convertMetastoreParquet",
        "spark_sql_parquet_writeLegacyFormat",
        "spark_history_kerberos_enabled",
        "spark_yarn_preserve_staging_files",
        "spark_yarn_submit_waitAppCompletion",
    ],
    "bytes": [
        "spark_driver_memory",
        "spark_executor_memory",
        "spark_driver_maxResultSize",
        "spark_sql_adaptive_shuffle_targetPostShuffleInputSize",
        "spark_sql_autoBroadcastJoinThreshold",
        "spark_files_maxPartitionBytes",
        "spark_files_openCostInBytes",
    ],
    "bytes_mib": [
        "spark_driver_memoryOverhead",
        "spark_executor_memoryOverhead",
        "spark_yarn_driver_memoryOverhead",
        "spark_yarn_executor_memoryOverhead",
        "spark_yarn_am_memoryOverhead",
        "spark_executor_pyspark_memory",
        "spark_reducer_maxSizeInFlight",
        "spark_kryoserializer_buffer_max",
        "spark_rpc_message_maxSize",
    ],
    "bytes_kib": [
        "spark_shuffle_file_buffer",
        "spark_eventLog_buffer_kb",
        "spark_kryoserializer_buffer",
        "spark_broadcast_blockSize",
    ],
    "ms": [
        "spark_sql_broadcastTimeout",
        "spark_executor_heartbeatInterval",
        "spark_dynamicAllocation_executorIdleTimeout",
        "spark_network_timeout",
        "spark_yarn_scheduler_heartbeat_interval-ms",
    ],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: ETL run additional info
# ---------------------------------------------------------------------------

ETL_INFO_CASTS = {
    "bytes_mib": ["conform_executor_memory_overhead", "std_driver_memory_overhead"],
    "bytes": ["std_executor_memory", "conform_driver_memory", "conform_executor_memory", "std_driver_memory"],
    "percentage": ["conform_data_size_ratio", "std_size_ratio", "std_data_size_ratio", "conform_size_ratio"],
    "cmd_line": ["conform_cmd_line_args", "std_cmd_line_args"],
}

REDACTED_ARGS = ["menas-auth-keytab", "menas-credentials-file", "report-date"]
REDACTED_VALUE = "redacted"

# ETL application types and the stored-size keys read for each (input, output).
ETL_SIZE_KEYS = {
    "standardization": ("std_input_data_size", "std_output_data_size"),
    "conformance": ("conform_input_data_size", "conform_output_data_size"),
    "standardization&conformance": ("std_input_data_size", "conform_output_data_size"),
}

# Name prefixes of ETL applications (new style; old styles with word counts).
ETL_NEW_PREFIX = "Enceladus"
# project value of an ETL classification (and the app value of old-style names)
ETL_PROJECT = "enceladus"

# additionalInfo keys read by run matching and ETL post metrics
ETL_KEY_ENGINE_VERSION = "std_enceladus_version"
ETL_KEY_STD_APP_ID = "std_application_id"
ETL_KEY_CONFORM_APP_ID = "conform_application_id"
ETL_KEY_INFO_DATE = "enceladus_info_date"

# root field of error documents
ERROR_DOC_ROOT = "record"
ETL_OLD_STANDARDIZATION = ("Standardisation ", 6)
ETL_OLD_CONFORMANCE = ("Dynamic Conformance ", 7)

# Word separators for the default classification.
DEFAULT_CLASSIFICATION_SEPARATORS = "[ ;,.\\-%_]"

# ---------------------------------------------------------------------------
# FIXED VALUES: cluster polling and alerts
# ---------------------------------------------------------------------------

DEFAULT_APP_TYPES = ["all", "SPARK", "MAPREDUCE"]
ALERT_EXCLUDED_ERROR_TYPES = ["HTTPError", "ConflictError"]
ALERT_ERROR_LOOKBACK = "1 day"
ALERT_QUIET_HOURS = 6
ALERT_RECENT_ERRORS = 5
TOP_TAGS_BUCKETS = 5000
TOP_TAGS_MIN_COUNT = 10
IDS_PER_STEP = 10000

# Incremental processing settings (template values).
LOOKBACK_HOURS = 168
STEP_SECONDS = 3600
SETTLING_SECONDS = 1800

ERROR_STAGES = ["raw", "aggregations", "listing"]
