"""Telemetry views derived from the driver's TPC-H-like tables.

The test tables hold no run telemetry, so these views derive it
deterministically, row by row (no grouping, so each view scales with its base
table and never gathers a group in one task):

* ``runs_v``        one attempt per order (application = order)
* ``stages_v``      one stage per line item
* ``executors_v``   one executor per line item (line 1 is the driver)
* ``apps_v``        nested application documents (attempt arrays) per order
* ``errors_v``      error documents from error events
* ``polls_v``       listed runs for incremental processing, from events
* ``yarn_v``        cluster-manager applications, from events
* ``props_v``       Spark properties as (app_id, key, value) rows, per order
* ``etl_runs_v``    ETL run records, per order
* ``checkpoints_v`` ETL checkpoints with controls, per line item
* ``scheduler_v``   scheduler snapshot: region -> queue, nation -> partition,
                    customer -> user

The same derivations exist as DuckDB SQL in ``runlens.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.session import apply_defaults


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def _app_id(key: Column) -> Column:
    return F.concat(F.lit("application_"), key.cast("string"))


def _run_id(key: Column) -> Column:
    return F.concat(F.lit("run-"), key.cast("string"))


def run_name(orderkey: Column, custkey: Column, orderdate: Column, priority: Column) -> Column:
    """Application name in the naming styles the classifiers handle, built
    from seven word slots (NULL slots are skipped) so each shared part
    appears in few places of the expression:

    * key % 20 = 19: old standardization (6 words)
    * key % 20 = 18: old conformance (7 words)
    * key % 20 = 17: not an ETL name
    * key % 20 = 16: new style with too few words
    * otherwise: new style, 7 words
    """
    b = orderkey % 20
    app_version = F.concat(F.lit("2."), (custkey % 5).cast("string"), F.lit(".0"))
    dataset = F.concat(F.lit("ds_"), custkey.cast("string"))
    ds_version = (orderkey % 4).cast("string")
    info_date = F.when(orderkey % 2 == 0, F.date_format(orderdate, "yyyy-MM-dd")).otherwise(
        F.date_format(orderdate, "dd-MM-yyyy")
    )
    etl_type = (
        F.when(orderkey % 3 == 0, F.lit("Standardization"))
        .when(orderkey % 3 == 1, F.lit("Conformance"))
        .otherwise(F.lit("Standardization&Conformance"))
    )
    other = F.concat(F.lit("Daily_report-"), priority, F.lit(" run."), (custkey % 13).cast("string"))
    old = b.isin(18, 19)
    no_tail = b.isin(16, 17)
    none = F.lit(None).cast("string")
    slots = [
        F.when(b == 19, F.lit("Standardisation")).when(b == 18, F.lit("Dynamic Conformance"))
        .when(b == 17, other).otherwise(F.lit("Enceladus")),
        F.when(old, app_version).when(b == 17, none).otherwise(etl_type),
        F.when(old, dataset).when(b == 17, none).otherwise(app_version),
        F.when(old, ds_version).when(no_tail, none).otherwise(dataset),
        F.when(old, info_date).when(no_tail, none).otherwise(ds_version),
        F.when(old, F.lit("1")).when(no_tail, none).otherwise(info_date),
        F.when(old | no_tail, none).otherwise(F.lit("1")),
    ]
    return F.concat_ws(" ", *slots)


def runs_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    start_ms = _ms(F.col("o_orderdate"))
    dur_ms = (F.lit(1200) + F.col("o_custkey") % 300) * 1000
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        _app_id(F.col("o_orderkey")).alias("app_id"),
        F.lit("1").alias("attempt_id"),
        run_name(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate"), F.col("o_orderpriority")).alias("name"),
        F.col("c_mktsegment").alias("user"),
        F.concat(F.lit("host-"), (F.col("o_custkey") % 7).cast("string")).alias("host"),
        _ts(start_ms).alias("startTime"),
        _ts(start_ms + dur_ms).alias("endTime"),
        _ts(start_ms + dur_ms).alias("lastUpdated"),
        dur_ms.cast("bigint").alias("duration"),
    )


def _lineitem_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, joined by ``app_id``: grouping by it needs
    no further shuffle.  The orders of a partition are hashed, so neither side
    is sorted."""
    li = table(spark, sf_dir, "lineitem").withColumn("app_id", _app_id(F.col("l_orderkey")))
    o = table(spark, sf_dir, "orders").select(_app_id(F.col("o_orderkey")).alias("app_id"), "o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o.hint("shuffle_hash"), "app_id")


def stages_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    start_ms = _ms(F.col("o_orderdate"))
    submit_ms = start_ms + (F.col("l_partkey") % 600) * 1000
    first_ms = submit_ms + (F.col("l_suppkey") % 5) * 1000
    done_ms = first_ms + (F.col("l_quantity") * 10000).cast("bigint")
    incomplete = (F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7)
    return _lineitem_orders(spark, sf_dir).select(
        "app_id",
        F.lit("1").alias("attempt_id"),
        F.col("l_linenumber").alias("stageId"),
        F.lit(0).alias("attemptId"),
        F.when(incomplete, F.lit("ACTIVE")).otherwise(F.lit("COMPLETE")).alias("status"),
        _ts(submit_ms).alias("submissionTime"),
        _ts(first_ms).alias("firstTaskLaunchedTime"),
        F.when(~incomplete, _ts(done_ms)).alias("completionTime"),
        F.floor(F.col("l_extendedprice") * 1024).cast("bigint").alias("inputBytes"),
        F.col("l_partkey").alias("inputRecords"),
        F.floor(F.col("l_extendedprice") * 512).cast("bigint").alias("outputBytes"),
        (F.col("l_quantity") * 1e9).cast("bigint").alias("executorCpuTime"),
        (F.col("l_linenumber") - 1).alias("numCompleteTasks"),
        F.concat(F.lit("stage "), F.col("l_linenumber").cast("string")).alias("details"),
    )


def executors_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    start_ms = _ms(F.col("o_orderdate"))
    return _lineitem_orders(spark, sf_dir).select(
        "app_id",
        F.lit("1").alias("attempt_id"),
        F.when(F.col("l_linenumber") == 1, F.lit("driver")).otherwise(F.col("l_suppkey").cast("string")).alias("id"),
        (F.lit(1) + F.col("l_linenumber") % 4).alias("totalCores"),
        (F.col("l_partkey") * 1048576).alias("maxMemory"),
        (F.col("l_quantity") * 10000).cast("bigint").alias("totalDuration"),
        F.floor(F.col("l_extendedprice") * 1024).cast("bigint").alias("totalInputBytes"),
        F.when(F.col("l_linenumber") != 6, _ts(start_ms + (F.col("l_partkey") % 60) * 1000)).alias("addTime"),
        F.when(
            F.col("l_returnflag") != "N", _ts(start_ms + (F.lit(60000) + (F.col("l_quantity") * 20000).cast("bigint")))
        ).alias("removeTime"),
        (F.col("l_discount") >= 0.09).alias("isExcluded"),
        (F.round(F.col("l_tax") * 100).cast("int") % 3).alias("failedTasks"),
        F.concat(F.lit("node-"), (F.col("l_suppkey") % 11).cast("string"), F.lit(":7337")).alias("hostPort"),
    )


# ---------------------------------------------------------------------------
# nested application documents (attempt arrays, GMT time strings)
# ---------------------------------------------------------------------------

_GMT = "yyyy-MM-dd'T'HH:mm:ss.SSS'GMT'"


def apps_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One application document per order, attempts newest first.

    Every 9th order ran twice (attempts '2' then '1'); every order with
    key % 10 = 3 has one attempt without an id; key % 50 = 7 has a malformed
    ``lastUpdated``.  Times are history-server GMT strings.
    """
    r = runs_v(spark, sf_dir).withColumn("__k", F.substring_index("app_id", "_", -1).cast("bigint"))
    k = F.col("__k")

    def attempt(aid, start, end, dur, last):
        return F.struct(
            aid.alias("attemptId"),
            F.date_format(start, _GMT).alias("startTime"),
            F.date_format(end, _GMT).alias("endTime"),
            last.alias("lastUpdated"),
            dur.cast("bigint").alias("duration"),
        )

    last = F.when(k % 50 == 7, F.lit("not a time")).otherwise(F.date_format("endTime", _GMT))
    newest = attempt(
        F.when(k % 9 == 0, F.lit("2")).when(k % 10 == 3, F.lit(None).cast("string")).otherwise(F.lit("1")),
        F.col("startTime"), F.col("endTime"), F.col("duration"), last,
    )
    older_start = F.timestamp_add("SECOND", F.lit(-3600), F.col("startTime"))
    older_end = F.timestamp_add("SECOND", F.lit(-600), F.col("startTime"))
    older = attempt(F.lit("1"), older_start, older_end, F.lit(3000000), F.date_format(older_end, _GMT))
    attempts = F.when(k % 9 == 0, F.array(newest, older)).otherwise(F.array(newest))
    return r.select(F.col("app_id").alias("id"), "name", "host", "user", attempts.alias("attempts"))


def landed_v(spark: SparkSession, sf_dir: str, listing: int) -> DataFrame:
    """Whole application documents (executors, stages, environment) as two
    listings land them.  The first has the first attempt of two thirds of the
    applications, every fourth application twice; the second has all
    applications with all attempts, but only the newest one where the order
    key divides by 27."""
    a = apps_v(spark, sf_dir).withColumn("__k", F.substring_index("id", "_", -1).cast("bigint"))
    k = F.col("__k")

    def pair(key, value):
        return F.array(F.lit(key), value.cast("string"))

    def whole(x):
        driver = F.struct(F.lit("driver").alias("id"), x["startTime"].alias("addTime"), F.lit(1).alias("totalCores"),
                          F.lit(1 << 30).cast("bigint").alias("maxMemory"), F.lit(0).cast("bigint").alias("totalDuration"))
        worker = F.struct(F.lit("1").alias("id"), x["startTime"].alias("addTime"), (1 + k % 4).cast("int").alias("totalCores"),
                          ((1 + k % 8) * (1 << 30)).cast("bigint").alias("maxMemory"), (x["duration"] * (1 + k % 2)).alias("totalDuration"))
        both = F.transform(F.array(driver, worker), lambda e: e.withField("totalInputBytes", k * 1024).withField("removeTime", x["endTime"])
                           .withField("memoryMetrics", F.struct((k * 10).alias("usedOnHeapStorageMemory"))))
        stage = F.struct(
            F.lit(0).alias("stageId"), F.lit(0).alias("attemptId"), x["startTime"].alias("submissionTime"),
            x["startTime"].alias("firstTaskLaunchedTime"), x["endTime"].alias("completionTime"), (k * 1024).alias("inputBytes"),
            k.alias("inputRecords"), (k * 512).alias("outputBytes"), (k * 1000).alias("executorCpuTime"), F.lit(1).alias("numCompleteTasks"))
        properties = F.array(pair("spark.executor.memory", F.concat((1 + k % 8).cast("string"), F.lit("g"))),
                             pair("spark.executor.cores", F.when(k % 10 == 0, F.lit("many")).otherwise((1 + k % 4).cast("string"))))
        return (x.withField("completed", F.lit(True)).withField("allexecutors", both).withField("stages", F.array(stage))
                .withField("environment", F.struct(properties.alias("sparkProperties"))))

    docs = a.withColumn("attempts", F.transform("attempts", whole))
    if listing == 1:
        docs = docs.where(k % 3 != 2).withColumn("attempts", F.slice("attempts", F.size("attempts"), 1))
        docs = docs.withColumn("__n", F.explode(F.sequence(F.lit(1), F.when(k % 4 == 0, 2).otherwise(1))))
    else:
        docs = docs.withColumn("attempts", F.when(k % 27 == 0, F.slice("attempts", 1, 1)).otherwise(F.col("attempts")))
    return docs.select("id", "name", "host", "attempts")


# ---------------------------------------------------------------------------
# environment / Spark properties
# ---------------------------------------------------------------------------


def env_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Environment document per order: property pairs (one duplicate key on
    every third order, a later value that must win), runtime, and the two
    bulky sections that cleansing drops."""
    apply_defaults(spark)
    o = table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")

    def pair(k, v):
        return F.array(F.lit(k), v.cast("string"))

    pairs = F.array(
        pair("spark.executor.memory", F.concat((1 + ck % 8).cast("string"), F.lit("g"))),
        pair("spark.executor.cores", 1 + ck % 4),
        pair("spark.dynamicAllocation.enabled", F.when(ck % 2 == 0, F.lit("true")).otherwise(F.lit("false"))),
        pair("spark.network.timeout", F.concat((60 + ck % 60).cast("string"), F.lit("s"))),
        pair("spark.driver.host", F.concat(F.lit("drv-"), ok.cast("string"))),
        pair("spark.sql.shuffle.partitions", (ok % 4 + 1) * 100),
        pair("spark.executor.memoryOverhead", 384 + (ck % 5) * 128),
        pair("spark.yarn.scheduler.heartbeat.interval-ms", 1000 * (1 + ok % 5)),
        F.when(ok % 3 == 0, pair("spark.executor.memory", F.concat((2 + ck % 8).cast("string"), F.lit("g")))),
    )
    return o.select(
        _app_id(ok).alias("app_id"),
        F.lit("1").alias("attempt_id"),
        F.filter(pairs, lambda p: p.isNotNull()).alias("sparkProperties"),
        F.struct(
            F.concat(F.lit("/usr/lib/jvm/java-"), (8 + ok % 3).cast("string")).alias("javaHome"),
            F.lit("17").alias("javaVersion"),
            F.lit("2.13").alias("scalaVersion"),
        ).alias("runtime"),
        F.array(F.array(F.lit("java.vendor"), F.lit("x"))).alias("systemProperties"),
        F.array(F.array(F.lit("/opt/app.jar"), F.lit("System"))).alias("classpathEntries"),
    )


def props_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(app_id, attempt_id, pos, key, value): one row per property pair."""
    e = env_v(spark, sf_dir)
    return e.select("app_id", "attempt_id", F.posexplode("sparkProperties").alias("pos", "pair")).select(
        "app_id", "attempt_id", (F.col("pos") + 1).alias("pos"),
        F.element_at("pair", 1).alias("key"), F.element_at("pair", 2).alias("value"),
    )


# ---------------------------------------------------------------------------
# events -> errors, listed runs, cluster-manager applications
# ---------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def errors_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error documents: one per error event."""
    ev = _events(spark, sf_dir).where(F.col("event_type") == "error")
    kind = F.floor("value").cast("bigint") % 5
    return ev.select(
        F.col("event_id").alias("err_id"),
        F.col("ts").alias("time_processed"),
        F.concat(F.lit("application_e"), F.col("event_id").cast("string")).alias("spark_app_id"),
        F.concat(F.lit("host-"), (F.col("user_id") % 8).cast("string")).alias("host"),
        F.when(kind == 0, F.lit("HTTPError")).when(kind == 1, F.lit("ConflictError"))
        .when(kind == 2, F.lit("KeyError")).when(kind == 3, F.lit("ValueError")).alias("type"),
        F.concat(F.lit("failed with "), F.col("props")).alias("message"),
        F.when(F.col("event_id") % 3 == 0, F.lit("raw")).when(F.col("event_id") % 3 == 1, F.lit("aggregations"))
        .otherwise(F.lit("listing")).alias("stage"),
    )


def polls_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs as listed by the history server (one per event).  Rows with an
    even ``event_id`` are already in the aggregate store (``processed``).
    Host 7 is processed a week late (quiet host for the alerts)."""
    ev = _events(spark, sf_dir)
    host_no = F.col("user_id") % 8
    return ev.select(
        F.concat(F.lit("application_e"), F.col("event_id").cast("string")).alias("id"),
        F.col("event_id"),
        F.col("user_id").alias("uid"),
        F.col("event_type").alias("name"),
        F.concat(F.lit("host-"), host_no.cast("string")).alias("host"),
        F.col("ts").alias("end_time"),
        F.when(host_no == 7, F.timestamp_add("DAY", F.lit(-7), F.col("ts")))
        .otherwise(F.timestamp_add("SECOND", F.col("event_id") % 600, F.col("ts"))).alias("time_processed"),
        (F.col("event_id") % 2 == 0).alias("processed"),
        F.col("value"),
    )


def yarn_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster-manager application records (epoch-ms times), one per event."""
    ev = _events(spark, sf_dir)
    eid, uid = F.col("event_id"), F.col("user_id")
    started = F.unix_millis("ts")
    etl_name = F.concat_ws(
        " ", F.lit("Enceladus"), F.lit("Standardization"), F.concat(F.lit("2."), (uid % 5).cast("string"), F.lit(".0")),
        F.concat(F.lit("ds_"), uid.cast("string")), (eid % 4).cast("string"), F.date_format("ts", "yyyy-MM-dd"), F.lit("1"),
    )
    st = eid % 4
    return ev.select(
        F.concat(F.lit("application_y"), eid.cast("string")).alias("id"),
        F.when(F.col("event_type") == "purchase", etl_name)
        .otherwise(F.concat(F.col("event_type"), F.lit(" job."), uid.cast("string"))).alias("name"),
        F.when(F.col("event_type") == "signup", F.lit("MAPREDUCE")).when(F.col("event_type") == "error", F.lit("TEZ"))
        .otherwise(F.lit("SPARK")).alias("applicationType"),
        F.when(st == 0, F.lit("FINISHED")).when(st == 1, F.lit("FAILED")).when(st == 2, F.lit("KILLED"))
        .otherwise(F.lit("RUNNING")).alias("state"),
        F.when(st == 0, F.lit("SUCCEEDED")).when(st == 1, F.lit("FAILED")).when(st == 2, F.lit("KILLED"))
        .otherwise(F.lit("UNDEFINED")).alias("finalStatus"),
        F.concat(F.lit("user_"), (uid % 10).cast("string")).alias("user"),
        F.concat(F.lit("root.q"), (uid % 3).cast("string")).alias("queue"),
        F.concat(F.lit("tag"), (eid % 5).cast("string")).alias("applicationTags"),
        started.alias("startedTime"),
        F.when(st != 3, started + F.floor(F.col("value") * 60000).cast("bigint")).alias("finishedTime"),
        ((1 + uid % 8) * 1024).alias("allocatedMB"),
        (1 + uid % 4).alias("allocatedVCores"),
        (eid % 2 == 0).alias("stored"),
    )


def yarn_attempts_v(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Attempts of the cluster-manager applications (one, or two for odd
    event ids) and their one to three containers, as records to be landed."""
    k = F.substring_index("id", "_y", -1).cast("bigint")
    apps = yarn_v(spark, sf_dir).withColumns({"__k": k, "__n": F.explode(F.sequence(F.lit(1).cast("bigint"), 1 + k % 2))})
    attempts = apps.select(
        F.col("id").alias("appId"), F.col("__n").cast("int").alias("id"),
        F.concat("id", F.lit("_attempt_"), F.col("__n").cast("string")).alias("appAttemptId"),
        (F.col("startedTime") + F.col("__n") * 1000).alias("startTime"), "finishedTime", "allocatedMB", "__k", "__n")
    held = F.sequence(F.lit(1).cast("bigint"), 1 + (F.col("__k") + F.col("__n")) % 3)
    containers = attempts.select("appId", "appAttemptId", "allocatedMB", F.explode(held).alias("__c")).select(
        "appId", "appAttemptId", F.concat("appAttemptId", F.lit("_c"), F.col("__c").cast("string")).alias("containerId"), "allocatedMB")
    return attempts.drop("allocatedMB", "__k", "__n"), containers


# ---------------------------------------------------------------------------
# ETL run registry: runs and checkpoints
# ---------------------------------------------------------------------------


def _etl_type_code(ok: Column) -> Column:
    """0 standardization, 1 conformance, 2 both; the old naming styles fix it."""
    return F.when(ok % 20 == 19, F.lit(0)).when(ok % 20 == 18, F.lit(1)).otherwise(ok % 3)


def etl_runs_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ETL run records: one per order, and a second, later run for keys that
    are multiples of 11.  Every 5th run names an application that does not
    exist (so those applications have no run), every 7th another dataset
    version, every 13th (offset 5) another engine version (match failures)."""
    apply_defaults(spark)
    o = table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    code = _etl_type_code(ok)
    named_app = F.when(ok % 5 == 0, F.concat(_app_id(ok), F.lit("_gone"))).otherwise(_app_id(ok))
    app_id = _app_id(ok)
    info_date = F.when(ok % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "dd-MM-yyyy")
    )
    price = F.col("o_totalprice")
    in_size = F.when(ok % 13 == 0, F.lit("0")).when(ok % 17 == 0, F.lit(None).cast("string")).otherwise(
        F.floor(price * 1000).cast("string")
    )

    def run(suffix: str, day_shift: int) -> DataFrame:
        start = F.timestamp_add("DAY", F.lit(day_shift), F.col("o_orderdate").cast("timestamp"))
        start_text = (
            F.when(ok % 4 == 0, F.concat(F.date_format(start, "dd-MM-yyyy HH:mm:ss"), F.lit(" +0200")))
            .when(ok % 4 == 1, F.date_format(start, "yyyy-MM-dd HH:mm:ss"))
            .when(ok % 4 == 2, F.date_format(start, "dd-MM-yyyy HH:mm:ss"))
            .otherwise(F.lit("sometime"))
        )
        info = F.create_map(
            F.lit("std_executor_memory"), F.concat((1 + ck % 8).cast("string"), F.lit("g")),
            F.lit("conform_executor_memory_overhead"), (256 + (ck % 4) * 128).cast("string"),
            F.lit("std_size_ratio"), F.concat((ck % 150).cast("string"), F.lit(".5 %")),
            F.lit("std_cmd_line_args"), F.concat(
                F.lit("--menas-auth-keytab /k/"), ck.cast("string"), F.lit(".keytab --dataset-name ds_"), ck.cast("string"),
                F.lit(" --report-date 2020-01-0"), (ok % 9 + 1).cast("string"), F.lit(" --num-partitions "),
                (ok % 50).cast("string"),
            ),
            F.lit("std_input_data_size"), in_size,
            F.lit("std_output_data_size"), F.floor(price * 700).cast("string"),
            F.lit("conform_input_data_size"), F.floor(price * 650).cast("string"),
            F.lit("conform_output_data_size"), F.when(ok % 19 == 0, F.lit("0")).otherwise(F.floor(price * 900).cast("string")),
            F.lit("std_enceladus_version"),
            F.when(ok % 13 == 5, F.lit("2.9.9")).otherwise(F.concat(F.lit("2."), (ck % 5).cast("string"), F.lit(".0"))),
            F.lit("std_application_id"), F.when(code != 1, named_app),
            F.lit("conform_application_id"), F.when(code != 0, named_app),
            F.lit("enceladus_info_date"), info_date,
            F.lit("records"), (ok % 100).cast("string"),
            F.lit("label"), F.concat(F.lit("x"), ck.cast("string")),
        )
        return o.select(
            F.concat(F.lit("run-"), ok.cast("string"), F.lit(suffix)).alias("uniqueId"),
            app_id.alias("app_id"),
            F.concat(F.lit("ds_"), ck.cast("string")).alias("dataset"),
            F.when(ok % 7 == 0, ok % 4 + 1).otherwise(ok % 4).cast("int").alias("datasetVersion"),
            start_text.alias("startDateTime"),
            F.struct(
                F.struct(
                    F.lit(1).alias("version"),
                    info_date.alias("informationDate"),
                    info.alias("additionalInfo"),
                ).alias("metadata"),
            ).alias("controlMeasure"),
        )

    first = run("", 0)
    second = run("-b", 1).where(F.col("uniqueId").isNotNull() & (F.substring_index("app_id", "_", -1).cast("bigint") % 11 == 0))
    return first.unionByName(second)


def checkpoints_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints of the ETL runs: one per line item (the run of its order),
    position = rank of the line item over all its columns.  Controls:
    record count and amount; the amount changes on returned items past line
    2, line 7 lacks it, and line 1 of accepted items has no controls."""
    apply_defaults(spark)
    # joined by the run: numbering and what groups by it need no further shuffle
    li = table(spark, sf_dir, "lineitem").withColumn("run_id", _run_id(F.col("l_orderkey")))
    o = table(spark, sf_dir, "orders").select(_run_id(F.col("o_orderkey")).alias("run_id"), "o_custkey")
    j = li.join(o.hint("shuffle_hash"), "run_id")
    order_cols = [
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ]
    by_line = Window.partitionBy("run_id").orderBy(F.asc_nulls_last(order_cols[0]), *order_cols[1:])
    j = j.withColumn("__pos", F.row_number().over(by_line))
    pos = F.col("__pos")
    ln = F.col("l_linenumber")
    ctl = lambda n, v: F.struct(F.lit(n).alias("controlName"), v.cast("string").alias("controlValue"))
    rc = ctl("recordcount", F.col("o_custkey"))
    amount = ctl(
        "amount",
        F.when((F.col("l_returnflag") == "R") & (ln > 2), F.col("l_orderkey") + 1).otherwise(F.col("l_orderkey")),
    )
    controls = (
        F.when((ln == 1) & (F.col("l_returnflag") == "A"), F.array().cast("array<struct<controlName:string,controlValue:string>>"))
        .when(ln == 7, F.array(rc))
        .otherwise(F.array(rc, amount))
    )
    ship = F.col("l_shipdate")
    return j.select(
        "run_id",
        pos.alias("cp_pos"),
        F.concat(F.lit(" Stage "), ln.cast("string")).alias("name"),
        F.when((F.col("l_linestatus") == "F") & (ln == 3), F.lit("n/a"))
        .otherwise(F.concat(F.date_format(ship, "dd-MM-yyyy HH:mm:ss"), F.lit(" +0000"))).alias("processStartTime"),
        F.date_format(F.timestamp_add("MINUTE", F.col("l_quantity").cast("int"), ship), "yyyy-MM-dd HH:mm:ss")
        .alias("processEndTime"),
        controls.alias("controls"),
    )


# ---------------------------------------------------------------------------
# scheduler snapshots
# ---------------------------------------------------------------------------


def scheduler_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scheduler snapshot per order (a poll): cluster capacities per
    partition, three queues with capacities and usage per partition, users
    of the first two queues (the third has none).  Built row by row."""
    apply_defaults(spark)
    o = table(spark, sf_dir, "orders")
    sql = """
    named_struct(
      'capacities', named_struct('queueCapacitiesByPartition', array(
          named_struct('partitionName', '', 'capacity', 100.0D, 'usedCapacity', o_totalprice % 100, 'maxCapacity', 100.0D),
          named_struct('partitionName', 'gpu', 'capacity', 50.0D, 'usedCapacity', CAST(o_custkey % 50 AS DOUBLE), 'maxCapacity', 100.0D))),
      'health', named_struct('lastrun', o_orderkey, 'operationsInfo', 'ok'),
      'queues', named_struct('queue', array(
          {q_default}, {q_etl}, {q_adhoc})))
    """

    def part(name, cap, used):
        return f"named_struct('partitionName', '{name}', 'capacity', {cap}, 'usedCapacity', {used})"

    def res(name, mem, cores):
        return f"named_struct('partitionName', '{name}', 'used_memory', CAST({mem} AS BIGINT), 'used_vCores', CAST({cores} AS INT))"

    def user(name_expr):
        return f"named_struct('username', {name_expr}, 'resources', named_struct('resourceUsagesByPartition', array({res('', '(o_custkey % 16) * 1024', 'o_custkey % 4 + 1')})))"

    def queue(name, i, users):
        return (
            f"named_struct('queueName', '{name}', 'numApplications', CAST(o_orderkey % 7 + {i} AS INT), "
            f"'capacities', named_struct('queueCapacitiesByPartition', array({part('', f'{30.0 + 10 * i}D', f'CAST(o_orderkey % {10 + i} AS DOUBLE)')}, "
            f"{part('gpu', f'{10.0 * i}D', f'CAST(o_custkey % {3 + i} AS DOUBLE)')})), "
            f"'resources', named_struct('resourceUsagesByPartition', array({res('', f'(o_orderkey % 32) * 1024 * {i + 1}', f'o_orderkey % 8 + {i}')}, "
            f"{res('gpu', f'(o_custkey % 8) * 512 * {i + 1}', f'o_custkey % 2 + {i}')})), "
            f"'users', {users})"
        )

    u_default = f"named_struct('user', array({user(chr(39) + 'cust_' + chr(39) + ' || CAST(o_custkey AS STRING)')}))"
    u_etl = (
        f"named_struct('user', array({user(chr(39) + 'cust_' + chr(39) + ' || CAST(o_custkey AS STRING)')}, "
        f"{user(chr(39) + 'clerk_' + chr(39) + ' || CAST(o_orderkey % 10 AS STRING)')}))"
    )
    u_none = f"if(false, {u_default}, NULL)"
    doc = sql.format(q_default=queue("default", 0, u_default), q_etl=queue("etl", 1, u_etl), q_adhoc=queue("adhoc", 2, u_none))
    return o.select(
        F.col("o_orderkey").alias("snapshot_id"),
        F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate").cast("timestamp")).alias("time_processed"),
        F.expr(doc).alias("schedulerInfo"),
        F.expr("map('appsSubmitted', o_custkey % 100, 'availableMB', o_orderkey % 1000)").alias("clusterMetrics"),
        F.expr("""array(
            named_struct('type', CAST(NULL AS STRING), 'statItem', array(named_struct('state', 'RUNNING', 'count', o_custkey % 50))),
            named_struct('type', 'SPARK', 'statItem', filter(array(named_struct('state', 'RUNNING', 'count', o_custkey % 30),
                if(o_orderkey % 2 = 0, named_struct('state', 'FAILED', 'count', o_orderkey % 20), NULL)), x -> x IS NOT NULL)))""").alias("appStatInfo"),
    )


# ---------------------------------------------------------------------------
# text inputs for the scalar functions
# ---------------------------------------------------------------------------

SIZE_SUFFIXES = ["", "k", "m", "g", "t", "p", "kb", "mb", "gb", "tb", "pb", "b", "kib", "MiB", "G ", "x"]
TIME_SUFFIXES = ["", "ms", "s", "m", "min", "h", "d", "us", "MIN", " s"]
BOOL_TEXTS = ["true", "1", "y", "yes", "false", "0", "n", "no", "TRUE", "maybe"]
NUM_TEXTS = ["<c>", "-7", "+3", "10.5", "1.25", "1e5", "abc", "99999999999999999999", "3.", "0"]


def _pick(idx: Column, values: list[str], custom: dict[str, Column] | None = None) -> Column:
    out = None
    for i, v in enumerate(values):
        val = (custom or {}).get(v, F.lit(v))
        out = F.when(idx == i, val) if out is None else out.when(idx == i, val)
    return out


def texts_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: texts in every form the parsers meet (sizes, durations,
    percentages, booleans, numbers, dates, command lines, URLs, JSON)."""
    apply_defaults(spark)
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    od = F.col("o_orderdate")
    size_num = (
        F.when(k % 29 == 0, F.lit("-1")).when(k % 31 == 0, F.lit("10.5")).when(k % 37 == 0, F.lit(" 7"))
        .otherwise((1 + c % 900).cast("string"))
    )
    time_num = F.when(k % 23 == 0, F.lit("1.5")).otherwise((c % 120).cast("string"))
    pct = (
        F.when(k % 11 == 0, F.lit("abc %")).when(k % 7 == 0, (c % 200).cast("string"))
        .otherwise(F.concat((c % 200).cast("string"), F.lit("."), (k % 100).cast("string"), F.lit(" %")))
    )
    date_text = (
        F.when(k % 4 == 0, F.concat(F.date_format(od, "dd-MM-yyyy HH:mm:ss"), F.lit(" +0200")))
        .when(k % 4 == 1, F.date_format(od, "yyyy-MM-dd HH:mm:ss"))
        .when(k % 4 == 2, F.date_format(od, "dd-MM-yyyy HH:mm:ss"))
        .otherwise(F.concat(F.date_format(od, "yyyy-MM-dd HH:mm:ss"), F.lit(" -0130")))
    )
    info_date = (
        F.when(k % 3 == 0, F.date_format(od, "yyyy-MM-dd")).when(k % 3 == 1, F.date_format(od, "dd-MM-yyyy"))
        .otherwise(F.lit("bad-date"))
    )
    cmd = F.concat(
        F.lit("--menas-auth-keytab /k/"), c.cast("string"), F.lit(".keytab --dataset-name ds_"), c.cast("string"),
        F.lit(" --report-date 2020-01-0"), (k % 9 + 1).cast("string"), F.lit(" --num-partitions "), (k % 50).cast("string"),
        F.when(k % 6 == 0, F.lit(" --mode a b")).otherwise(F.lit("")),
    )
    json_text = F.when(k % 9 == 0, F.lit('{"a": 1}')).otherwise(
        F.concat(F.lit('{"a": {"b": '), c.cast("string"), F.lit('}, "k": '), k.cast("string"), F.lit("}"))
    )
    return o.select(
        k.alias("id"),
        F.concat(size_num, _pick(k % 16, SIZE_SUFFIXES)).alias("size_text"),
        F.concat(time_num, _pick(k % 10, TIME_SUFFIXES)).alias("time_text"),
        pct.alias("pct_text"),
        _pick(k % 10, BOOL_TEXTS).alias("bool_text"),
        _pick(k % 10, NUM_TEXTS, {"<c>": c.cast("string")}).alias("num_text"),
        (F.unix_millis(od.cast("timestamp")) + k % 1000).alias("ms_value"),
        F.timestamp_add("MICROSECOND", k % 1000000, od.cast("timestamp")).alias("ts_value"),
        ((c % 1000) * F.lit(1048576) * (1 + k % 300)).alias("byte_value"),
        F.concat(F.lit("http://hist-"), (c % 7).cast("string"), F.lit(".example.org:18080/api/v1/applications")).alias("url"),
        date_text.alias("date_text"),
        info_date.alias("info_date_text"),
        cmd.alias("cmd_text"),
        json_text.alias("json_text"),
    )
