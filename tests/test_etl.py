import contextlib
import datetime
import io

from pyspark.sql import functions as F

from runlens.operators import etl as E
from runlens.plans import views as V
from runlens.plans.catalog import QUERIES

CP = "run string, pos int, name string, s string, e string, controls array<struct<controlName:string,controlValue:string>>"


def c(*pairs):
    return [{"controlName": n, "controlValue": v} for n, v in pairs]


def test_checkpoint_controls(spark):
    rows = [
        ("all_equal", 1, " Raw ", "15-01-2020 10:00:00", "15-01-2020 10:00:05", c(("rc", "10"), ("sum", "5"))),
        ("all_equal", 2, "Std", "15-01-2020 10:00:05", "bad", c(("rc", "10"), ("sum", "5"))),
        ("value", 1, "Raw", None, None, c(("rc", "10"), ("sum", "5"))),
        ("value", 2, "Std", None, None, c(("rc", "10"), ("sum", "6"))),
        ("value", 3, "Conf", None, None, c(("rc", "9"), ("sum", "5"))),
        ("count", 1, "Raw", None, None, c(("rc", "10"), ("sum", "5"))),
        ("count", 2, "Std", None, None, c(("rc", "10"))),
        ("empty_first", 1, "Raw", None, None, []),
        ("empty_first", 2, "Std", None, None, c(("rc", "10"))),
        ("empty_first", 3, "Conf", None, None, c(("rc", "11"))),
        ("text", 1, "Raw", None, None, c(("rc", "123"))),
        ("text", 2, "Std", None, None, c(("rc", "123.0"))),
        ("missing_name", 1, "Raw", None, None, c(("rc", "1"))),
        ("missing_name", 2, "Std", None, None, c(("other", "1"))),
    ]
    df = spark.createDataFrame(rows, CP)
    out = {r["run"]: r for r in E.checkpoint_controls(df, "run", "pos").collect()}
    assert out["all_equal"]["controls_match"] and out["all_equal"]["num_controls"] == 2
    assert out["all_equal"]["elements_count"] == 2
    v = out["value"]
    assert not v["controls_match"] and v["error_checkpoint"] == "Std"
    assert (v["error_controlName"], v["error_controlValue"], v["error_initialControlValue"]) == ("sum", "6", "5")
    assert v["error_incorrect_num_controls"] is False
    assert out["count"]["error_incorrect_num_controls"] is True and out["count"]["error_checkpoint"] == "Std"
    e = out["empty_first"]
    assert e["num_controls"] == 1 and e["error_checkpoint"] == "Conf" and e["error_controlValue"] == "11"
    assert not out["text"]["controls_match"]
    m = out["missing_name"]
    assert m["error_controlName"] == "other" and m["error_initialControlValue"] is None


def test_checkpoint_durations(spark):
    rows = [
        ("r", 1, " Raw ", "15-01-2020 10:00:00", "15-01-2020 10:00:05", []),
        ("r", 2, "Raw", "15-01-2020 10:00:00 +0100", "2020-01-15 10:00:10", []),
        ("r", 3, "Std", "n/a", "2020-01-15 10:00:10", []),
    ]
    out = {r["name"]: r for r in E.checkpoint_durations(spark.createDataFrame(rows, CP), "run", "pos", "name", "s", "e").collect()}
    assert out["Raw"]["duration"] == 3610000.0  # later checkpoint with the same name wins
    assert out["Std"]["duration"] is None


def test_post_metrics(spark):
    info = "controlMeasure struct<metadata:struct<additionalInfo:map<string,string>>>"
    rows = [
        ("standardization", 268435456, 1000, 300000000, {"std_input_data_size": "134217728", "std_output_data_size": "0"}),
        ("conformance", None, 1000, 5, {"conform_input_data_size": "10"}),
        ("other", 10, 10, 10, {"std_input_data_size": "10"}),
    ]
    df = spark.createDataFrame(
        [(t, i, o, p, {"metadata": {"additionalInfo": m}}) for t, i, o, p, m in rows],
        f"type string, stages_inputBytes_max long, stages_outputBytes_max long, est_peak_memory_usage long, {info}",
    )
    out = {r["type"]: r["postprocessing"] for r in E.post_metrics(df).collect()}
    pm = out["standardization"]
    assert pm["input_in_storage_HDFS_blocks"] == 1 and pm["input_deserialization_factor"] == 2.0
    assert abs(pm["peak_to_input_memory_factor"] - 300000000 / 134217728) < 1e-12
    assert pm["output_in_storage_HDFS_blocks"] is None and pm["output_to_input_storage_size_ratio"] is None
    assert out["conformance"] is None and out["other"] is None


def test_positional_join_and_mismatch(spark):
    att = spark.createDataFrame([("a", 0, "2"), ("a", 1, "1"), ("b", 0, "1")], "app_id string, attempt_pos int, attemptId string")
    runs = spark.createDataFrame(
        [("a", "r1", "2020-01-01 00:00:00"), ("a", "r2", "2020-01-02 00:00:00"), ("b", "r3", "x"), ("b", "r4", "2020-01-01 00:00:00")],
        "app_id string, uniqueId string, startDateTime string",
    )
    ranked = E.rank_runs(runs)
    got = {(r["app_id"], r["attempt_pos"]): r["uniqueId"] for r in E.positional_join(att, ranked).collect()}
    assert got == {("a", 0): "r2", ("a", 1): "r1", ("b", 0): "r4"}
    mm = {r["app_id"]: (r["n_attempts"], r["n_runs"]) for r in E.run_count_mismatch(att, runs).collect()}
    assert mm == {"b": (1, 2)}


def test_typed_info(spark):
    m = {"std_executor_memory": "2g", "std_size_ratio": "50 %", "std_cmd_line_args": "--report-date 2020 --x y",
         "conform_executor_memory_overhead": "512", "records": "7", "label": "t"}
    df = spark.createDataFrame([({"metadata": {"additionalInfo": m}},)],
                               "controlMeasure struct<metadata:struct<additionalInfo:map<string,string>>>")
    r = df.select(*[E.typed_info(k).alias(k) for k in m]).first()
    assert r["std_executor_memory"] == 2 * 1024 ** 3 and r["std_size_ratio"] == 0.5
    assert r["std_cmd_line_args"] == {"report-date": "redacted", "x": "y"}
    assert r["conform_executor_memory_overhead"] == 512 * 1024 ** 2
    assert r["records"]["num"] == 7.0 and r["label"]["str"] == "t" and r["label"]["num"] is None
    assert df.select(F.lit(1)).count() == 1


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue()


def _physical(df) -> str:
    return _plan(df).split("== Physical Plan ==")[1]


def _write(spark, tmp_path, order_keys, line_keys):
    """Orders and line items (order, line number) of the tests' own."""
    at = datetime.datetime(2020, 1, 15, 10)
    spark.createDataFrame([(k, k, "O", 100.0, at, "1-URGENT") for k in order_keys],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                          "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, 10 - n, 1, n, 2.0, 3.0, 0.0, 0.0, "N", "O", at) for k, n in line_keys],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, "AUTO") for k in order_keys if k], "c_custkey long, c_mktsegment string").write.parquet(
        f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_checkpoints_of_a_run_are_shuffled_once(spark, tmp_path):
    sf = _write(spark, tmp_path, [1, 2, 2, None], [(1, 2), (1, 1), (1, 1), (2, 1), (2, 3), (3, 1), (None, 1)])
    got = sorted((r["run_id"], r["cp_pos"], r["name"]) for r in V.checkpoints_v(spark, sf).collect())
    assert got == [("run-1", 1, " Stage 1"), ("run-1", 2, " Stage 1"), ("run-1", 3, " Stage 2"),
                   ("run-2", 1, " Stage 1"), ("run-2", 2, " Stage 1"), ("run-2", 3, " Stage 3"), ("run-2", 4, " Stage 3")]
    durations, controls = QUERIES["checkpoint_durations"](spark, sf), QUERIES["checkpoint_controls"](spark, sf)
    # line items and orders, once in each use of the view, and nothing after them
    assert _physical(durations).count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in _physical(durations) and "SortMergeJoin" not in _physical(durations)
    assert _physical(controls).count("Exchange hashpartitioning") <= 4
    assert durations.count() == 4 and controls.where("controls_match").count() == 2


def test_checkpoints_without_line_number_come_last(spark, tmp_path):
    sf = _write(spark, tmp_path, [1], [(1, 1), (1, 2)])
    items = spark.read.parquet(f"{sf}/lineitem.parquet")
    nulled = items.withColumn("l_linenumber", F.when(F.col("l_linenumber") != 1, F.col("l_linenumber")))
    nulled.write.parquet(f"{sf}/nulled/lineitem.parquet")
    spark.read.parquet(f"{sf}/orders.parquet").write.parquet(f"{sf}/nulled/orders.parquet")
    got = V.checkpoints_v(spark, f"{sf}/nulled").orderBy("cp_pos").collect()
    assert [r["name"] for r in got] == [" Stage 2", None]


def test_reference_with_a_repeated_name(spark):
    same = c(("rc", "1"), ("rc", "2"))
    rows = [("twice", 1, "Raw", None, None, same), ("twice", 2, "Std", None, None, same),
            ("null", 1, "Raw", None, None, c(("rc", None))), ("null", 2, "Std", None, None, c(("rc", None)))]
    out = {r["run"]: r for r in E.checkpoint_controls(spark.createDataFrame(rows, CP), "run", "pos").collect()}
    assert out["twice"]["num_controls"] == 1 and out["twice"]["error_incorrect_num_controls"] is True
    assert out["null"]["controls_match"]


def test_joins_carry_sizes_not_the_whole_info(spark, tmp_path):
    sf = _write(spark, tmp_path, [1, 22], [(1, 1), (1, 2), (22, 1)])
    for name in ("etl_post_metrics", "etl_profile_report"):
        plan = _plan(QUERIES[name](spark, sf)).split("== Optimized Logical Plan ==")[1]
        # neither the explode of a run's application ids nor the join with its sizes carries the map
        assert "_extract_additionalInfo" not in plan and "sizes#" in plan, name


def test_size_info_reads_like_the_map(spark):
    df = spark.createDataFrame([({"std_input_data_size": "7", "x": "y"},), (None,)], "m map<string,string>")
    got = df.select(E.size_info("m").alias("s")).collect()
    assert got[0].s["std_input_data_size"] == "7" and got[0].s["conform_input_data_size"] is None and got[1].s is None


def test_listed_environments_are_joined_without_their_pairs(spark, tmp_path):
    plan = _physical(QUERIES["src_environment"](spark, _write(spark, tmp_path, [2, 9], [(2, 1)])))
    env = [line for line in plan.splitlines() if "spark.yarn.scheduler.heartbeat" in line]
    assert env and all("n_property_pairs" in line for line in env)


def test_line_items_and_orders_are_not_sorted_to_be_joined(spark, tmp_path):
    sf = _write(spark, tmp_path, [1, 2], [(1, 1), (1, 2), (2, 1), (3, 1)])
    df = QUERIES["schema_evolution_union"](spark, sf)
    assert "Sort " not in _physical(df) and "ShuffledHashJoin" in _physical(df)
    assert sorted((r.app_id, r.id) for r in df.collect()) == [("application_1", "1"), ("application_1", "driver"), ("application_2", "driver")]


def test_long_generated_methods_are_not_used(spark, tmp_path):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    df = QUERIES["yarn_scheduler_docs"](spark, _write(spark, tmp_path, [1, 2], [(1, 1)]))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert df.count() == 46
