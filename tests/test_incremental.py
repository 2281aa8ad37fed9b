import datetime as dt

from pyspark.sql import functions as F

from runlens.operators import incremental as I

S = "id string, uid long, end_time timestamp, event_id long"


def T(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def test_new_runs_and_high_watermark(spark):
    listed = spark.createDataFrame([("a", 1, T(1), 1), ("b", 1, T(2), 2), ("c", 2, T(2), 3), ("d", 2, T(3), 4)], S)
    store = spark.createDataFrame([("a", 1, T(1), 1), ("b", 1, T(2), 2)], S)
    assert sorted(r.id for r in I.new_runs(listed, store).collect()) == ["c", "d"]
    # high watermark T(2) with 'b' stored at it: 'c' (same time, new) and 'd' are new
    assert sorted(r.id for r in I.since_high_watermark(listed, store, "end_time").collect()) == ["c", "d"]
    assert [r.id for r in I.rows_at_latest(store, "end_time").collect()] == ["b"]
    assert I.resume_point(store, "end_time", "2024-01-01 05:00:00").first()[0] == T(5)
    assert I.resume_point(store, "end_time", "2023-01-01 00:00:00").first()[0] == T(2)


def test_upsert_idempotent(spark):
    existing = spark.createDataFrame([("a", 1, T(1), 1), ("b", 2, T(1), 2)], S)
    updates = spark.createDataFrame([("c", 1, T(2), 3), ("d", 2, T(1), 2)], S)
    once = I.upsert(existing, updates, "uid", ["end_time", "event_id"])
    twice = I.upsert(once, updates, "uid", ["end_time", "event_id"])
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    # uid 2: equal order tuple, the update wins
    assert {r.uid: r.id for r in once.collect()} == {1: "c", 2: "d"}


def test_steps(spark):
    rows = [("a", 1, T(0, 30), 1), ("b", 1, T(1, 0), 2), ("c", 1, T(2, 59), 3), ("d", 1, T(3, 10), 4), ("e", 1, T(5), 5)]
    df = spark.createDataFrame(rows, S)
    lo, hi = F.lit(T(0, 30)), F.lit(T(3, 30))
    steps = {r.step: (r.step_start, r.step_end) for r in I.assign_steps(df, "end_time", lo, hi).collect()}
    assert steps[0] == (T(0, 30), T(1, 30)) and steps[2] == (T(2, 30), T(3, 30)) and 4 not in steps
    store = df.where(F.col("id") == "b")
    cnt = {r.step: (r.total, r.matched, r.new) for r in
           I.step_counters(df, store, "end_time", lo, hi, F.col("id") != "c").collect()}
    assert cnt == {0: (2, 2, 1), 2: (2, 1, 1)}
    # empty window
    assert I.assign_steps(df, "end_time", hi, lo).count() == 0


def test_settled_and_lookback(spark):
    df = spark.createDataFrame([("a", 1, T(1), 1), ("b", 1, T(2, 45), 2)], S)
    asof = F.lit(T(3))
    assert [r.id for r in I.settled(df, "end_time", asof).collect()] == ["a"]
    lo, hi = I.lookback_bounds(asof, lookback_hours=1, settle_seconds=600)
    assert [r.id for r in I.in_range(df, "end_time", lo, hi).collect()] == ["b"]


def test_ids_desc_and_distinct(spark):
    df = spark.createDataFrame([(str(i), i % 3, T(i % 5), i) for i in range(20)], S)
    top = I.ids_desc(df, "end_time", F.lit(T(0)), F.lit(T(9)), size=3).collect()
    assert [r.end_time for r in top] == [T(4)] * 3
    assert I.distinct_ids(df, "uid").count() == 3
    assert I.max_time(df, "end_time").first()[0] == T(4)


def test_typed_wide_equals_long(spark):
    from runlens.operators.typed_agg import typed_aggregate, typed_aggregate_long
    from runlens.plans import views as V
    from tests.conftest import SF_SMALL

    ex = V.executors_v(spark, SF_SMALL).drop("id", "hostPort")
    keys = ["app_id", "attempt_id"]
    wide = typed_aggregate(ex, keys)
    long = typed_aggregate_long(wide, keys, "executors")
    w = wide.where((F.col("app_id") == "application_1")).first().asDict()
    got = {(r.field, r.agg): r.value for r in long.where(F.col("app_id") == "application_1").collect()}
    assert got[("elements_count", "count")] == w["elements_count"]
    for name, value in w.items():
        if name in keys or name == "elements_count" or value is None:
            continue
        field, agg = name.rsplit("_", 1) if not name.endswith(("count_zeroes", "count_not_null")) else (
            name[: name.index("_count_")], name[name.index("_count_") + 1:])
        v = got[(field, agg)]
        if isinstance(value, bool):
            value = float(value)
        elif isinstance(value, dt.datetime):
            value = value.replace(tzinfo=dt.timezone.utc).timestamp() * 1000
        assert abs(v - float(value)) < 1e-6, (name, v, value)
    nonnull = sum(1 for k, v in w.items() if k not in keys and v is not None)
    assert len(got) == nonnull


def test_step_border_counted_once(spark):
    # a run ending exactly on a step border belongs to the later step only
    df = spark.createDataFrame([("a", 1, T(1), 1), ("b", 1, T(2), 2), ("c", 1, T(0), 3)], S)
    steps = {r.id: r.step for r in I.assign_steps(df, "end_time", F.lit(T(0)), F.lit(T(2))).collect()}
    assert steps == {"c": 0, "a": 1}  # T(2) is the (exclusive) window end
    counts = I.assign_steps(df, "end_time", F.lit(T(0)), F.lit(T(3))).groupBy("step").count().collect()
    assert sorted((r.step, r["count"]) for r in counts) == [(0, 1), (1, 1), (2, 1)]


def test_distinct_counts_keep_their_types(spark):
    import decimal

    from runlens.operators.typed_agg import distinct_counts, typed_aggregate

    rows = [("a", decimal.Decimal("90071992547409930.01"), 2**53 + i % 2, 0.1 * (i % 3), {"x": i % 4, "y": {"z": None if i % 2 else 1.5}})
            for i in range(1000)] + [("a", decimal.Decimal("90071992547409930.02"), None, None, None), ("b", None, 1, 2.0, {"x": 1, "y": None})]
    df = spark.createDataFrame(rows, "k string, d decimal(20,2), l long, f double, m struct<x:int,y:struct<z:double>>")
    got = {r.k: r for r in typed_aggregate(df, ["k"]).collect()}
    a, b = got["a"], got["b"]
    assert (a["d_nunique"], a["l_nunique"], a["f_nunique"], a["m.x_nunique"], a["m.y.z_nunique"]) == (2, 2, 3, 4, 1)
    assert (b["d_nunique"], b["l_nunique"], b["m.x_nunique"], b["m.y.z_nunique"], b["m.y.z_count_not_null"]) == (None, 1, 1, None, None)
    assert a["m.x_sum"] == 1500 and a["elements_count"] == 1001 and "m" not in got["a"].asDict()
    # a type table of one's own gets the same plan
    from runlens.operators.typed_agg import default_type_aggs
    own = typed_aggregate(df, ["k"], type_aggs=default_type_aggs())
    assert sorted(map(str, own.collect())) == sorted(map(str, got.values()))
    assert "Expand" not in own._jdf.queryExecution().optimizedPlan().toString()
    # two exchanges behind the rows, and a group that holds nearly all rows
    # reaches them spread over the values
    plan = distinct_counts(df.select("k", "d", "l", "f"), ["k"], ["d", "l", "f"])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") + plan.count("SortAggregate") <= 4


def test_distinct_counts_of_small_and_large_groups(spark, monkeypatch):
    from runlens.operators import typed_agg as A

    nan, none = float("nan"), None
    rows = [("a", 0.0, 1), ("a", -0.0, 1), ("a", nan, 2), ("a", nan, none), ("a", none, 3), ("b", 2.5, none), (none, 1.0, 7), (none, 1.0, 8)]
    df = spark.createDataFrame(rows, "k string, f double, l long")
    small = A.typed_aggregate(df, ["k"])
    # no row for each value: the groups' sets are aggregates like the others
    assert "Generate" not in small._jdf.queryExecution().optimizedPlan().toString()
    names = ["k", "elements_count", "f_nunique", "l_nunique", "l_sum"]
    got = {r.k: tuple(r)[1:] for r in small.select(*names).collect()}
    assert got == {"a": (5, 2, 3, 7), "b": (1, 1, none, none), none: (2, 1, 2, 15)}
    for limit in (0, 1, 3):
        monkeypatch.setattr(A, "GROUP_ROWS", limit)
        mixed = A.typed_aggregate(df, ["k"])
        assert mixed.columns == small.columns
        assert "Generate" in mixed._jdf.queryExecution().optimizedPlan().toString()
        assert {r.k: tuple(r)[1:] for r in mixed.select(*names).collect()} == got
    ex = df.selectExpr("k", "if(l = 1, 'driver', 'x') as id", "l as addTime", "f")
    parts = sorted(map(str, A.executor_aggregate(ex, ["k"]).collect()))
    monkeypatch.setattr(A, "GROUP_ROWS", 10_000)
    assert sorted(map(str, A.executor_aggregate(ex, ["k"]).collect())) == parts


def test_groups_of_the_views_need_no_further_shuffle(spark):
    from runlens.operators import metrics as M
    from runlens.plans import views as V
    from tests.conftest import SF_SMALL

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.stage_aggregate(V.stages_v(spark, SF_SMALL), nunique="none")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # line items and orders


def test_bundle_equals_its_parts(spark):
    from runlens.operators import metrics as M
    from runlens.operators.typed_agg import executor_aggregate
    from runlens.plans import views as V
    from tests.conftest import SF_SMALL

    runs, ex, st = V.runs_v(spark, SF_SMALL), V.executors_v(spark, SF_SMALL), V.stages_v(spark, SF_SMALL)
    report = M.attempt_report(runs.select("app_id", "attempt_id", "startTime", "endTime", "duration"), ex, st)
    parts = M.stage_aggregate(st).join(executor_aggregate(M.executor_metrics(ex, runs), M.KEYS), M.KEYS, "full")
    names = [c for c in parts.columns if c != "driver" and not c.endswith(("_sum", "_mean"))]
    want = {tuple(r) for r in parts.select(*names).collect()}
    got = {tuple(r) for r in report.where("stages_elements_count is not null or executors_elements_count is not null").select(*names).collect()}
    assert got == want and len(want) > 100
