"""Golden values, computed by hand, for the JSON fixture documents."""

import os

import pytest
from pyspark.sql import functions as F

from runlens.operators import cleanse as P
from runlens.operators import metrics as M
from runlens.sources import telemetry as S
from tests.conftest import FIXTURES


@pytest.fixture(scope="module")
def tables(spark):
    apps = S.read_apps(spark, os.path.join(FIXTURES, "apps.jsonl"))
    good = apps.where(F.col("_corrupt_record").isNull() & F.col("id").isNotNull())
    return apps, P.documents_to_tables(good.drop("_corrupt_record"))


def test_corrupt_record_routed(tables):
    apps, _ = tables
    rows = apps.select("id", "_corrupt_record").collect()
    assert sum(r["_corrupt_record"] is not None for r in rows) == 1


def test_flatten_and_final_flag(tables):
    _, (att, ex, st) = tables
    rows = {(r.app_id, r.attempt_id): r for r in att.collect()}
    assert rows[("app-1", "2")].isFinalAttempt and not rows[("app-1", "1")].isFinalAttempt
    assert rows[("app-2", "0")].isFinalAttempt  # missing attempt id
    assert rows[("app-1", "1")].lastUpdated is None  # malformed time -> NULL
    assert "hostPort" not in ex.columns and "executorLogs" not in ex.columns and "details" not in st.columns


def test_summary_golden(tables):
    _, (att, ex, st) = tables
    rep = {(r.app_id, r.attempt_id): r for r in M.attempt_report(att, ex, st).collect()}
    r = rep[("app-1", "2")]
    assert r.parallel_work == 600000
    assert r.parallel_part == 200000 and r.stages_in_parallel is True
    assert r.seq_part == 400000 and r.est_seq_time == 1000000
    assert abs(r.estimated_speedup - 1000000 / 600000) < 1e-12
    assert r.core_cost == 2 * 300000 + 4 * 540000
    assert abs(r.estimated_core_efficiency - 600000 / 2760000) < 1e-12
    assert r.unused_core_cost == 2160000
    assert r.stages_sum == 240000 and r.stages_interval == 290000
    assert r.stages_max_input_blocks == 2 and r.executors_total_input_blocks == 2
    assert r.unused_storage_memory == 3221225472 - 268435456
    assert r.est_peak_memory_usage == 268435456 + 5000
    assert abs(r.parallel_fraction - 1 / 3) < 1e-12
    assert r.driver["totalCores"] == 1 and r.executors_elements_count == 2
    assert r.executors_failedTasks_count_zeroes == 1 and r.executors_isActive_any is True
    assert r.stages_elements_count == 4
    # attempt without executors or stages, app with the driver only: no summary
    for key in [("app-1", "1"), ("app-2", "0"), ("app-3", "1")]:
        assert rep[key].parallel_work is None and rep[key].estimated_speedup is None


def test_stage_metrics_golden(tables):
    _, (_, _, st) = tables
    m = {r.stageId: r for r in M.stage_metrics(st.where(F.col("app_id") == "app-1")).collect()}
    assert m[0].x_scheduling_overhead == 10000 and m[0].x_duration == 120000
    assert m[0].throughput_bytes == 268435456 / 120000 and m[0].x_average_task_input_bytes == 268435456 / 4
    assert m[1].x_average_task_input_bytes is None  # no completed task
    assert m[2].x_duration == 0 and m[2].throughput_bytes is None  # zero-length stage
    assert (m[3].x_duration, m[3].throughput_bytes, m[3].throughput_records) == (0, -1.0, -1.0)  # not completed
    assert m[0].x_executorCpuTime_ms == 60000.0


def test_executor_metrics_golden(tables):
    _, (att, ex, _) = tables
    m = {r.id: r for r in M.executor_metrics(ex.where(F.col("app_id") == "app-1"), att).collect()}
    assert m["1"].x_durationMilliseconds == 300000 and m["2"].x_durationMilliseconds == 540000  # removeTime from attempt end
    assert m["1"].x_coreCost == 600000 and m["2"].x_storageCost == 540000.0


def test_environment(spark):
    apps = S.read_apps(spark, os.path.join(FIXTURES, "apps.jsonl")).where(F.col("id") == "app-1")
    env = apps.select(F.col("attempts")[0]["environment"].alias("e")).select("e.*")
    r = P.clean_environment(env).first()
    assert "systemProperties" not in r.asDict() and "javaHome" not in r["runtime"].asDict()
    assert "spark_driver_host" not in r["sparkProperties"]
    t = r["typedProperties"]
    assert t["spark_executor_memory"] == 10.5 * 1024 ** 3  # later duplicate wins
    assert t["spark_executor_cores"] == 2 and t["spark_network_timeout"] == 600000.0
    assert t["spark_dynamicAllocation_enabled"] is True


def test_list_apps(spark):
    apps = S.read_apps(spark, os.path.join(FIXTURES, "apps.jsonl")).where(F.col("id").isNotNull())
    got = sorted(r.id for r in S.list_apps(apps, status="completed", min_date="2020-01-15 10:30:00").collect())
    assert got == ["app-2", "app-3"]
    assert [r.id for r in S.list_apps(apps, apps_limit=1).collect()] == ["app-3"]


def test_value_less_columns_omitted(tables):
    _, (att, ex, st) = tables
    rep = {(r.app_id, r.attempt_id): r for r in M.attempt_report(att, ex, st).collect()}
    d = rep[("app-2", "0")]  # driver only: no executor has any value
    assert d.executors_elements_count == 0
    assert d.executors_totalCores_count_not_null is None and d.executors_totalCores_count_zeroes is None
    assert d.executors_totalCores_nunique is None and d.executors_totalCores_sum is None
    r = rep[("app-1", "2")]
    # per-task averages exist for 2 of the 4 stages (stages 1 and 3 completed no task)
    assert r.stages_x_average_task_input_bytes_count_not_null == 2
