"""Streaming forms equal the batch ones (availableNow over landed files)."""

import tempfile

from pyspark.sql import functions as F

from runlens.operators import incremental as I
from runlens.plans import views as V
from runlens.streaming import runs as R
from tests.conftest import SF_SMALL


def test_stream_dedup_and_steps_equal_batch(spark):
    work = tempfile.mkdtemp(prefix="runlens-stream-")
    polls = V.polls_v(spark, SF_SMALL).select("id", "uid", "name", "end_time")
    # land the listing twice (a run listed in two polls)
    polls.write.mode("overwrite").parquet(f"{work}/landing/p1")
    polls.where(F.col("uid") % 2 == 0).write.mode("overwrite").parquet(f"{work}/landing/p2")
    stream = R.listed_runs(spark, f"{work}/landing/*", polls.schema)
    q = R.start(R.new_runs(stream, keys=["id"]), f"{work}/ck1", sink="parquet", path=f"{work}/out_new")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{work}/out_new").count() == polls.select("id").distinct().count()

    seen = []

    def batch(df, batch_id):
        seen.append(batch_id)
        df.write.mode("append").parquet(f"{work}/out_steps")

    q2 = R.start(R.step_counts(R.listed_runs(spark, f"{work}/landing/p1", polls.schema)), f"{work}/ck2",
                 output_mode="update", foreach_batch=batch)
    q2.awaitTermination(120)
    got = {(r.step_start, r.n_runs) for r in spark.read.parquet(f"{work}/out_steps").collect()}
    want = {(r.s, r.n) for r in polls.groupBy(F.window("end_time", "3600 seconds").start.alias("s"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want and seen


def test_versioned_upsert_sink(spark):
    base = tempfile.mkdtemp(prefix="runlens-store-") + "/store"
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "uid long, id string, t long")
    from runlens.sources import telemetry as S

    S.upsert_table(spark, base, rows, "uid", ["t"], version=1)
    upd = spark.createDataFrame([(1, "c", 2)], "uid long, id string, t long")
    out = S.upsert_table(spark, base, upd, "uid", ["t"], version=2)
    assert sorted((r.uid, r.id) for r in out.collect()) == [(1, "c"), (2, "b")]
    again = S.upsert_table(spark, base, upd, "uid", ["t"], version=3)
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in out.collect())
    assert I.max_time(out, "t").first()[0] == 2


def test_throughput_observation(spark):
    import time

    df = V.polls_v(spark, SF_SMALL)
    observed, obs = R.observe_runs(df)
    t = time.perf_counter()
    observed.write.format("noop").mode("overwrite").save()
    n = obs.get["runs"]
    assert n == df.count()
    assert R.runs_per_hour(n, time.perf_counter() - t) > 0
    assert R.runs_per_hour(5, 0) == 0.0


def test_parquet_store_and_profile(spark):
    import datetime as dt

    from runlens.operators import incremental as I
    from runlens.operators.profiles import DefaultProfile, EtlProfile
    from runlens.sources.telemetry import ParquetStore

    store = ParquetStore(spark, tempfile.mkdtemp(prefix="runlens-pq-") + "/s")
    T0 = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame([("a-1", "a", T0), ("b-1", "b", T0)], "uid string, id string, end_time timestamp")
    assert store.processed_ids(T0, T0) is None
    store.save_aggs(batch, version=0)
    listed = spark.createDataFrame([("a", T0), ("c", T0)], "id string, end_time timestamp")
    seen = store.processed_ids(T0, T0, "end_time", "id")
    assert [r.id for r in I.new_runs(listed, seen).collect()] == ["c"]
    store.save_errors(spark.createDataFrame([("x",)], "msg string"))

    runs = V.etl_runs_v(spark, SF_SMALL)
    apps = V.runs_v(spark, SF_SMALL).select("app_id", "name")
    p = EtlProfile(runs, V.checkpoints_v(spark, SF_SMALL))
    enriched = p.enrich(p.is_matching_app(apps))
    assert enriched.where(F.col("run_id").isNotNull()).count() > 0
    assert "controls_match" in p.aggregate(enriched).columns
    assert DefaultProfile().enrich(apps).count() == apps.count()


def test_stream_high_watermarks_equal_batch(spark):
    work = tempfile.mkdtemp(prefix="runlens-hw-")
    polls = V.polls_v(spark, SF_SMALL).select("id", "host", "end_time")
    polls.where(F.col("end_time") < F.lit("2024-01-15").cast("timestamp")).write.parquet(f"{work}/landing/a")
    polls.where(F.col("end_time") >= F.lit("2024-01-15").cast("timestamp")).write.parquet(f"{work}/landing/b")
    stream = R.listed_runs(spark, f"{work}/landing/*", polls.schema, max_files=1)
    q = R.start(R.high_watermarks(stream), f"{work}/ck", output_mode="complete", sink="memory", query_name="hw_test")
    q.awaitTermination(180)
    got = {(r.host, r.high_watermark, r.n_runs) for r in spark.table("hw_test").collect()}
    want = {(r.host, r.m, r.n) for r in polls.groupBy("host").agg(F.max("end_time").alias("m"), F.count("*").alias("n")).collect()}
    assert got == want


def test_late_run_inside_lookback_is_kept(spark):
    import datetime as dt

    work = tempfile.mkdtemp(prefix="runlens-late-")
    schema = "id string, uid long, name string, end_time timestamp"
    t0 = dt.datetime(2024, 1, 10)
    first = spark.createDataFrame([("a", 1, "x", t0), ("b", 1, "x", t0 + dt.timedelta(hours=5))], schema)
    # arrives later, completed 3 days before the newest run (inside the 168 h lookback),
    # together with a repeat listing of 'a'
    late = spark.createDataFrame([("c", 2, "x", t0 - dt.timedelta(days=3)), ("a", 1, "x", t0)], schema)
    first.write.parquet(f"{work}/landing/1")
    late.write.parquet(f"{work}/landing/2")
    stream = R.listed_runs(spark, f"{work}/landing/*", first.schema, max_files=1)
    q = R.start(R.new_runs(stream, keys=["id"]), f"{work}/ck", sink="parquet", path=f"{work}/out")
    q.awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(f"{work}/out").collect()) == ["a", "b", "c"]


def test_stream_since_latest_keeps_its_tie_set(spark):
    """Three micro-batches with tied end times equal the batch form over what
    was processed before; a batch that is run again changes nothing."""
    import datetime as dt

    work = tempfile.mkdtemp(prefix="runlens-ties-")
    t = [dt.datetime(2024, 1, 1, h) for h in range(5)]
    schema = "id string, end_time timestamp"
    batches = [[("a", t[0]), ("b", t[1]), ("c", t[1]), ("b", t[1])],
               [("b", t[1]), ("c", t[1]), ("d", t[1]), ("early", t[0]), ("e", t[2])],
               [("e", t[2]), ("f", t[2]), ("d", t[1]), ("g", t[4]), ("h", t[4])]]
    done = []
    for n, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, schema)
        batch.coalesce(1).write.parquet(f"{work}/landing/{n}")
        want = batch.distinct()
        if done:
            store = spark.createDataFrame(done, schema)
            want = I.since_high_watermark(want, store, "end_time", "id")
        want = sorted(r.id for r in want.collect())
        stream = R.listed_runs(spark, f"{work}/landing/*", batch.schema, max_files=1)
        R.since_latest(stream, f"{work}/out", f"{work}/ck").awaitTermination(120)
        got = spark.read.parquet(f"{work}/out/new")
        assert sorted(r.id for r in got.where(F.col("batch") == n).collect()) == want
        done += [(r.id, r.end_time) for r in got.where(F.col("batch") == n).collect()]
    assert sorted(i for i, _ in done) == ["a", "b", "c", "d", "e", "f", "g", "h"]
    R.since_latest_batch(spark.createDataFrame(batches[2], schema), 2, f"{work}/out")
    assert spark.read.parquet(f"{work}/out/new").count() == 8
    state = spark.read.parquet(f"{work}/out/state").where("batch = 2")
    assert sorted(r.id for r in state.collect()) == ["g", "h"]
