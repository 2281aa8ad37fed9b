"""The telemetry views of ``runlens.plans.views`` as DuckDB SQL.

Used only by the oracle: each query's DuckDB text is prefixed with the CTEs of
the views it mentions.  Times are TIMESTAMP (naive, UTC); epoch milliseconds
come from ``epoch_ms``.
"""

from __future__ import annotations

import re

_RUN_NAME = """
  CASE WHEN o_orderkey % 20 = 19 THEN concat_ws(' ', 'Standardisation', {ver}, {ds}, {dsv}, {idate}, '1')
       WHEN o_orderkey % 20 = 18 THEN concat_ws(' ', 'Dynamic Conformance', {ver}, {ds}, {dsv}, {idate}, '1')
       WHEN o_orderkey % 20 = 17 THEN 'Daily_report-' || o_orderpriority || ' run.' || CAST(o_custkey % 13 AS VARCHAR)
       WHEN o_orderkey % 20 = 16 THEN concat_ws(' ', 'Enceladus', {etype}, {ver})
       ELSE concat_ws(' ', 'Enceladus', {etype}, {ver}, {ds}, {dsv}, {idate}, '1') END
""".format(
    ver="'2.' || CAST(o_custkey % 5 AS VARCHAR) || '.0'",
    ds="'ds_' || CAST(o_custkey AS VARCHAR)",
    dsv="CAST(o_orderkey % 4 AS VARCHAR)",
    idate="CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%d-%m-%Y') END",
    etype="CASE WHEN o_orderkey % 3 = 0 THEN 'Standardization' WHEN o_orderkey % 3 = 1 THEN 'Conformance' "
    "ELSE 'Standardization&Conformance' END",
)

VIEWS: dict[str, str] = {}

VIEWS["runs_v"] = f"""
SELECT 'application_' || CAST(o_orderkey AS VARCHAR) AS app_id,
       '1' AS attempt_id,
       {_RUN_NAME} AS name,
       c_mktsegment AS "user",
       'host-' || CAST(o_custkey % 7 AS VARCHAR) AS host,
       make_timestamp(epoch_ms(o_orderdate) * 1000) AS startTime,
       make_timestamp((epoch_ms(o_orderdate) + (1200 + o_custkey % 300) * 1000) * 1000) AS endTime,
       make_timestamp((epoch_ms(o_orderdate) + (1200 + o_custkey % 300) * 1000) * 1000) AS lastUpdated,
       CAST((1200 + o_custkey % 300) * 1000 AS BIGINT) AS duration
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""

_LO = "lineitem JOIN orders ON l_orderkey = o_orderkey"

VIEWS["stages_v"] = f"""
SELECT 'application_' || CAST(l_orderkey AS VARCHAR) AS app_id,
       '1' AS attempt_id,
       l_linenumber AS stageId,
       0 AS attemptId,
       CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN 'ACTIVE' ELSE 'COMPLETE' END AS status,
       make_timestamp((epoch_ms(o_orderdate) + (l_partkey % 600) * 1000) * 1000) AS submissionTime,
       make_timestamp((epoch_ms(o_orderdate) + (l_partkey % 600) * 1000 + (l_suppkey % 5) * 1000) * 1000)
         AS firstTaskLaunchedTime,
       CASE WHEN NOT (l_linestatus = 'O' AND l_linenumber = 7) THEN
         make_timestamp((epoch_ms(o_orderdate) + (l_partkey % 600) * 1000 + (l_suppkey % 5) * 1000
                         + CAST(l_quantity * 10000 AS BIGINT)) * 1000) END AS completionTime,
       CAST(floor(l_extendedprice * 1024) AS BIGINT) AS inputBytes,
       l_partkey AS inputRecords,
       CAST(floor(l_extendedprice * 512) AS BIGINT) AS outputBytes,
       CAST(l_quantity * 1e9 AS BIGINT) AS executorCpuTime,
       l_linenumber - 1 AS numCompleteTasks,
       'stage ' || CAST(l_linenumber AS VARCHAR) AS details
FROM {_LO}
"""

VIEWS["executors_v"] = f"""
SELECT 'application_' || CAST(l_orderkey AS VARCHAR) AS app_id,
       '1' AS attempt_id,
       CASE WHEN l_linenumber = 1 THEN 'driver' ELSE CAST(l_suppkey AS VARCHAR) END AS id,
       1 + l_linenumber % 4 AS totalCores,
       l_partkey * 1048576 AS maxMemory,
       CAST(l_quantity * 10000 AS BIGINT) AS totalDuration,
       CAST(floor(l_extendedprice * 1024) AS BIGINT) AS totalInputBytes,
       CASE WHEN l_linenumber <> 6 THEN make_timestamp((epoch_ms(o_orderdate) + (l_partkey % 60) * 1000) * 1000) END
         AS addTime,
       CASE WHEN l_returnflag <> 'N' THEN
         make_timestamp((epoch_ms(o_orderdate) + 60000 + CAST(l_quantity * 20000 AS BIGINT)) * 1000) END AS removeTime,
       l_discount >= 0.09 AS isExcluded,
       CAST(round(l_tax * 100) AS INTEGER) % 3 AS failedTasks,
       'node-' || CAST(l_suppkey % 11 AS VARCHAR) || ':7337' AS hostPort
FROM {_LO}
"""

_K = "o_orderkey"

VIEWS["attempts_raw_v"] = """
SELECT app_id AS id, name, host, "user", 0 AS attempt_pos,
       CASE WHEN CAST(substr(app_id, 13) AS BIGINT) % 9 = 0 THEN '2'
            WHEN CAST(substr(app_id, 13) AS BIGINT) % 10 = 3 THEN NULL ELSE '1' END AS attemptId,
       strftime(startTime, '%Y-%m-%dT%H:%M:%S.%gGMT') AS startTime,
       strftime(endTime, '%Y-%m-%dT%H:%M:%S.%gGMT') AS endTime,
       CASE WHEN CAST(substr(app_id, 13) AS BIGINT) % 50 = 7 THEN 'not a time'
            ELSE strftime(endTime, '%Y-%m-%dT%H:%M:%S.%gGMT') END AS lastUpdated,
       duration
FROM runs_v
UNION ALL
SELECT app_id, name, host, "user", 1, '1',
       strftime(startTime - INTERVAL 3600 SECOND, '%Y-%m-%dT%H:%M:%S.%gGMT'),
       strftime(startTime - INTERVAL 600 SECOND, '%Y-%m-%dT%H:%M:%S.%gGMT'),
       strftime(startTime - INTERVAL 600 SECOND, '%Y-%m-%dT%H:%M:%S.%gGMT'),
       CAST(3000000 AS BIGINT)
FROM runs_v WHERE CAST(substr(app_id, 13) AS BIGINT) % 9 = 0
"""

_PROPS = [
    ("spark.executor.memory", "CAST(1 + o_custkey % 8 AS VARCHAR) || 'g'", None),
    ("spark.executor.cores", "CAST(1 + o_custkey % 4 AS VARCHAR)", None),
    ("spark.dynamicAllocation.enabled", "CASE WHEN o_custkey % 2 = 0 THEN 'true' ELSE 'false' END", None),
    ("spark.network.timeout", "CAST(60 + o_custkey % 60 AS VARCHAR) || 's'", None),
    ("spark.driver.host", "'drv-' || CAST(o_orderkey AS VARCHAR)", None),
    ("spark.sql.shuffle.partitions", "CAST((o_orderkey % 4 + 1) * 100 AS VARCHAR)", None),
    ("spark.executor.memoryOverhead", "CAST(384 + (o_custkey % 5) * 128 AS VARCHAR)", None),
    ("spark.yarn.scheduler.heartbeat.interval-ms", "CAST(1000 * (1 + o_orderkey % 5) AS VARCHAR)", None),
    ("spark.executor.memory", "CAST(2 + o_custkey % 8 AS VARCHAR) || 'g'", "o_orderkey % 3 = 0"),
]

VIEWS["props_v"] = "\nUNION ALL\n".join(
    f"SELECT 'application_' || CAST(o_orderkey AS VARCHAR) AS app_id, '1' AS attempt_id, {i + 1} AS pos, "
    f"'{k}' AS key, {v} AS value FROM orders" + (f" WHERE {w}" if w else "")
    for i, (k, v, w) in enumerate(_PROPS)
)

VIEWS["errors_v"] = """
SELECT event_id AS err_id, ts AS time_processed, 'application_e' || CAST(event_id AS VARCHAR) AS spark_app_id,
       'host-' || CAST(user_id % 8 AS VARCHAR) AS host,
       CASE CAST(floor(value) AS BIGINT) % 5 WHEN 0 THEN 'HTTPError' WHEN 1 THEN 'ConflictError'
            WHEN 2 THEN 'KeyError' WHEN 3 THEN 'ValueError' END AS type,
       'failed with ' || props AS message,
       CASE event_id % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'aggregations' ELSE 'listing' END AS stage
FROM events WHERE event_type = 'error'
"""

VIEWS["polls_v"] = """
SELECT 'application_e' || CAST(event_id AS VARCHAR) AS id, event_id, user_id AS uid, event_type AS name,
       'host-' || CAST(user_id % 8 AS VARCHAR) AS host, ts AS end_time,
       CASE WHEN user_id % 8 = 7 THEN ts - INTERVAL 7 DAY ELSE ts + to_seconds(event_id % 600) END AS time_processed,
       event_id % 2 = 0 AS processed, value
FROM events
"""

VIEWS["yarn_v"] = """
SELECT 'application_y' || CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_type = 'purchase' THEN concat_ws(' ', 'Enceladus', 'Standardization',
              '2.' || CAST(user_id % 5 AS VARCHAR) || '.0', 'ds_' || CAST(user_id AS VARCHAR),
              CAST(event_id % 4 AS VARCHAR), strftime(ts, '%Y-%m-%d'), '1')
            ELSE event_type || ' job.' || CAST(user_id AS VARCHAR) END AS name,
       CASE event_type WHEN 'signup' THEN 'MAPREDUCE' WHEN 'error' THEN 'TEZ' ELSE 'SPARK' END AS applicationType,
       CASE event_id % 4 WHEN 0 THEN 'FINISHED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'KILLED' ELSE 'RUNNING' END AS state,
       CASE event_id % 4 WHEN 0 THEN 'SUCCEEDED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'KILLED' ELSE 'UNDEFINED' END
         AS finalStatus,
       'user_' || CAST(user_id % 10 AS VARCHAR) AS "user",
       'root.q' || CAST(user_id % 3 AS VARCHAR) AS queue,
       'tag' || CAST(event_id % 5 AS VARCHAR) AS applicationTags,
       (epoch_us(ts) // 1000) AS startedTime,
       CASE WHEN event_id % 4 <> 3 THEN (epoch_us(ts) // 1000) + CAST(floor(value * 60000) AS BIGINT) END AS finishedTime,
       (1 + user_id % 8) * 1024 AS allocatedMB,
       1 + user_id % 4 AS allocatedVCores,
       event_id % 2 = 0 AS stored
FROM events
"""

_ETL_CODE = "CASE WHEN o_orderkey % 20 = 19 THEN 0 WHEN o_orderkey % 20 = 18 THEN 1 ELSE o_orderkey % 3 END"
_NAMED_APP = ("'application_' || CAST(o_orderkey AS VARCHAR) || "
              "CASE WHEN o_orderkey % 5 = 0 THEN '_gone' ELSE '' END")
_INFO_DATE = ("CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') "
              "ELSE strftime(o_orderdate, '%d-%m-%Y') END")


def _etl_run_sql(suffix: str, shift: int, where: str) -> str:
    start = f"(o_orderdate + INTERVAL {shift} DAY)"
    return f"""
SELECT 'run-' || CAST(o_orderkey AS VARCHAR) || '{suffix}' AS uniqueId,
       'application_' || CAST(o_orderkey AS VARCHAR) AS app_id,
       'ds_' || CAST(o_custkey AS VARCHAR) AS dataset,
       CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 4 + 1 ELSE o_orderkey % 4 END AS INTEGER) AS datasetVersion,
       CASE o_orderkey % 4 WHEN 0 THEN strftime({start}, '%d-%m-%Y %H:%M:%S') || ' +0200'
            WHEN 1 THEN strftime({start}, '%Y-%m-%d %H:%M:%S')
            WHEN 2 THEN strftime({start}, '%d-%m-%Y %H:%M:%S') ELSE 'sometime' END AS startDateTime,
       1 AS version,
       {_INFO_DATE} AS informationDate,
       CAST(1 + o_custkey % 8 AS VARCHAR) || 'g' AS ai_std_executor_memory,
       CAST(256 + (o_custkey % 4) * 128 AS VARCHAR) AS ai_conform_executor_memory_overhead,
       CAST(o_custkey % 150 AS VARCHAR) || '.5 %' AS ai_std_size_ratio,
       '--menas-auth-keytab /k/' || CAST(o_custkey AS VARCHAR) || '.keytab --dataset-name ds_' || CAST(o_custkey AS VARCHAR)
         || ' --report-date 2020-01-0' || CAST(o_orderkey % 9 + 1 AS VARCHAR) || ' --num-partitions '
         || CAST(o_orderkey % 50 AS VARCHAR) AS ai_std_cmd_line_args,
       CASE WHEN o_orderkey % 13 = 0 THEN '0' WHEN o_orderkey % 17 = 0 THEN NULL
            ELSE CAST(CAST(floor(o_totalprice * 1000) AS BIGINT) AS VARCHAR) END AS ai_std_input_data_size,
       CAST(CAST(floor(o_totalprice * 700) AS BIGINT) AS VARCHAR) AS ai_std_output_data_size,
       CAST(CAST(floor(o_totalprice * 650) AS BIGINT) AS VARCHAR) AS ai_conform_input_data_size,
       CASE WHEN o_orderkey % 19 = 0 THEN '0' ELSE CAST(CAST(floor(o_totalprice * 900) AS BIGINT) AS VARCHAR) END
         AS ai_conform_output_data_size,
       CASE WHEN o_orderkey % 13 = 5 THEN '2.9.9' ELSE '2.' || CAST(o_custkey % 5 AS VARCHAR) || '.0' END
         AS ai_std_enceladus_version,
       CASE WHEN {_ETL_CODE} <> 1 THEN {_NAMED_APP} END AS ai_std_application_id,
       CASE WHEN {_ETL_CODE} <> 0 THEN {_NAMED_APP} END AS ai_conform_application_id,
       {_INFO_DATE} AS ai_enceladus_info_date,
       CAST(o_orderkey % 100 AS VARCHAR) AS ai_records,
       'x' || CAST(o_custkey AS VARCHAR) AS ai_label
FROM orders {where}"""


VIEWS["etl_runs_v"] = _etl_run_sql("", 0, "") + "\nUNION ALL" + _etl_run_sql("-b", 1, "WHERE o_orderkey % 11 = 0")

VIEWS["checkpoints_v"] = """
SELECT 'run-' || CAST(l_orderkey AS VARCHAR) AS run_id,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                          l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS cp_pos,
       ' Stage ' || CAST(l_linenumber AS VARCHAR) AS name,
       CASE WHEN l_linestatus = 'F' AND l_linenumber = 3 THEN 'n/a'
            ELSE strftime(l_shipdate, '%d-%m-%Y %H:%M:%S') || ' +0000' END AS processStartTime,
       strftime(l_shipdate + to_minutes(CAST(l_quantity AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS processEndTime,
       CASE WHEN l_linenumber = 1 AND l_returnflag = 'A' THEN 0 WHEN l_linenumber = 7 THEN 1 ELSE 2 END AS n_controls,
       CAST(o_custkey AS VARCHAR) AS c_recordcount,
       CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber > 2 THEN l_orderkey + 1 ELSE l_orderkey END AS VARCHAR)
         AS c_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

VIEWS["controls_v"] = """
SELECT run_id, cp_pos, 1 AS ctrl_pos, 'recordcount' AS controlName, c_recordcount AS controlValue
FROM checkpoints_v WHERE n_controls >= 1
UNION ALL
SELECT run_id, cp_pos, 2, 'amount', c_amount FROM checkpoints_v WHERE n_controls >= 2
"""


def with_views(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every view it (transitively) mentions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def r4(expr: str) -> str:
    """Round to 4 places with plain IEEE steps (x*1e4 + 0.500001, floor, /1e4), the
    same steps ``catalog.rounded`` takes in Spark, so both engines produce
    bit-identical doubles (their own ``round`` functions differ on ties)."""
    return f"(CASE WHEN abs({expr}) < 1e14 THEN floor(({expr}) * 10000.0 + 0.500001) / 10000.0 ELSE ({expr}) END)"


def _pick_sql(idx: str, values: list[str], custom: dict[str, str] | None = None) -> str:
    whens = " ".join(f"WHEN {i} THEN {(custom or {}).get(v, repr(v))}" for i, v in enumerate(values))
    return f"CASE {idx} {whens} END"


def _texts_sql() -> str:
    from runlens.plans.views import BOOL_TEXTS, NUM_TEXTS, SIZE_SUFFIXES, TIME_SUFFIXES

    return f"""
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 29 = 0 THEN '-1' WHEN o_orderkey % 31 = 0 THEN '10.5' WHEN o_orderkey % 37 = 0 THEN ' 7'
       ELSE CAST(1 + o_custkey % 900 AS VARCHAR) END || {_pick_sql('o_orderkey % 16', SIZE_SUFFIXES)} AS size_text,
  CASE WHEN o_orderkey % 23 = 0 THEN '1.5' ELSE CAST(o_custkey % 120 AS VARCHAR) END
    || {_pick_sql('o_orderkey % 10', TIME_SUFFIXES)} AS time_text,
  CASE WHEN o_orderkey % 11 = 0 THEN 'abc %' WHEN o_orderkey % 7 = 0 THEN CAST(o_custkey % 200 AS VARCHAR)
       ELSE CAST(o_custkey % 200 AS VARCHAR) || '.' || CAST(o_orderkey % 100 AS VARCHAR) || ' %' END AS pct_text,
  {_pick_sql('o_orderkey % 10', BOOL_TEXTS)} AS bool_text,
  {_pick_sql('o_orderkey % 10', NUM_TEXTS, {'<c>': 'CAST(o_custkey AS VARCHAR)'})} AS num_text,
  epoch_ms(o_orderdate) + o_orderkey % 1000 AS ms_value,
  o_orderdate + to_microseconds(o_orderkey % 1000000) AS ts_value,
  (o_custkey % 1000) * 1048576 * (1 + o_orderkey % 300) AS byte_value,
  'http://hist-' || CAST(o_custkey % 7 AS VARCHAR) || '.example.org:18080/api/v1/applications' AS url,
  CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d-%m-%Y %H:%M:%S') || ' +0200'
       WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN strftime(o_orderdate, '%d-%m-%Y %H:%M:%S')
       ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' -0130' END AS date_text,
  CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y')
       ELSE 'bad-date' END AS info_date_text,
  '--menas-auth-keytab /k/' || CAST(o_custkey AS VARCHAR) || '.keytab --dataset-name ds_' || CAST(o_custkey AS VARCHAR)
    || ' --report-date 2020-01-0' || CAST(o_orderkey % 9 + 1 AS VARCHAR) || ' --num-partitions '
    || CAST(o_orderkey % 50 AS VARCHAR) || CASE WHEN o_orderkey % 6 = 0 THEN ' --mode a b' ELSE '' END AS cmd_text,
  CASE WHEN o_orderkey % 9 = 0 THEN '{{"a": 1}}'
       ELSE '{{"a": {{"b": ' || CAST(o_custkey AS VARCHAR) || '}}, "k": ' || CAST(o_orderkey AS VARCHAR) || '}}' END
    AS json_text
FROM orders"""


VIEWS["texts_v"] = _texts_sql()

# --- SQL forms of the scalar parsers (oracle side) ---------------------------


def sql_strip(t: str) -> str:
    return f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"


def sql_cast_number(t: str) -> str:
    return (f"(CASE WHEN regexp_full_match({t}, '[-+]?[0-9]+') THEN CAST(TRY_CAST({t} AS BIGINT) AS DOUBLE) "
            f"WHEN regexp_full_match({t}, '[+-]?[0-9]+(\\.[0-9]+)?') THEN TRY_CAST({t} AS DOUBLE) END)")


def sql_suffix_parse(t: str, units: dict, default: int) -> str:
    low = f"lower({sql_strip(t)})"
    mult = " ".join(f"WHEN suffix({low}, '{u}') THEN {float(f)}" for u, f in units.items())
    cut = " ".join(f"WHEN suffix({low}, '{u}') THEN left({low}, length({low}) - {len(u)})" for u in units)
    return f"({sql_cast_number(f'(CASE {cut} ELSE {low} END)')} * (CASE {mult} ELSE {float(default)} END))"
