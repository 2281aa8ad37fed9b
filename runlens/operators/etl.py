"""ETL-run profile.

Run records of an ETL framework are matched to the applications that ran
them, their free-form ``additionalInfo`` map is typed, their checkpoints'
control values are compared, and size ratios are derived.  Matching,
ranking and control checks are joins and aggregations keyed by application
or run id; no run's data is gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.constants import (
    ETL_INFO_CASTS,
    ETL_KEY_CONFORM_APP_ID,
    ETL_KEY_ENGINE_VERSION,
    ETL_KEY_STD_APP_ID,
    ETL_SIZE_KEYS,
    HDFS_BLOCK_BYTES,
    REDACTED_ARGS,
    REDACTED_VALUE,
)
from runlens.operators.intervals import bucketed_row_number
from runlens.functions import (
    cast_value,
    parse_bytes,
    parse_bytes_mib,
    parse_cmd_args,
    parse_date,
    parse_percentage,
    redact,
    remove_blanks,
)

INFO = "controlMeasure.metadata.additionalInfo"


def info(key: str, info_col: str = INFO) -> Column:
    return F.col(info_col)[key]


_INFO_CASTERS = {
    "bytes_mib": parse_bytes_mib,
    "bytes": parse_bytes,
    "percentage": parse_percentage,
    "cmd_line": lambda c: redact(parse_cmd_args(c), REDACTED_ARGS, REDACTED_VALUE),
}


def typed_info(key: str, info_col: str = INFO) -> Column:
    """One additionalInfo value typed by the key's cast (sizes,
    MiB-default sizes, percentages, command lines with listed arguments
    redacted); any other key as struct<num, str> (number or text)."""
    raw = info(key, info_col)
    for kind, keys in ETL_INFO_CASTS.items():
        if key in keys:
            return _INFO_CASTERS[kind](raw)
    return cast_value(raw)


def run_start(run_col: str = "startDateTime", default_tz: str = "UTC") -> Column:
    return parse_date(F.col(run_col), default_tz)


def match_candidates(runs: DataFrame, apps: DataFrame, app_col: str = "app_id") -> DataFrame:
    """Every (application, run) pair where the run names the application
    (as standardization or conformance id), with ``run_app_id`` (the id the
    application's type reads) and ``matched`` (dataset, dataset version,
    info version, engine version and application id all equal).

    ``apps`` carries the classification columns; ``runs`` the raw records.
    """
    std_id, conf_id = info(ETL_KEY_STD_APP_ID), info(ETL_KEY_CONFORM_APP_ID)
    named = runs.select(
        "uniqueId", "dataset", "datasetVersion", "startDateTime",
        F.col("controlMeasure.metadata.version").alias("info_version_run"),
        info(ETL_KEY_ENGINE_VERSION).alias("app_version_run"),
        std_id.alias("std_id"), conf_id.alias("conf_id"),
    )
    # from the columns above, so that the explode carries them and not the whole info
    cand = named.select("*", F.explode(F.array_distinct(
        F.filter(F.array("std_id", "conf_id"), lambda x: x.isNotNull()))).alias("__cand"))
    pairs = cand.join(apps, F.col("__cand") == F.col(app_col)).drop("__cand")
    t = F.col("type")
    run_app_id = (
        F.when(t == "standardization&conformance", F.col("std_id")).when(t == "standardization", F.col("std_id"))
        .when(t == "conformance", F.col("conf_id")).otherwise(F.lit(""))
    )
    # a version word that is not all digits never equals the run's number
    ds_ver_eq = F.when(F.col("dataset_version").isNull(), F.col("datasetVersion").isNull()).otherwise(
        F.col("dataset_version_int").eqNullSafe(F.col("datasetVersion"))
    )
    info_ver_eq = F.when(F.col("info_version").isNull(), F.col("info_version_run").isNull()).otherwise(
        F.col("info_version_int").eqNullSafe(F.col("info_version_run"))
    )
    matched = (
        F.col("dataset").eqNullSafe(F.col("cls_dataset")) & ds_ver_eq & info_ver_eq
        & F.col("app_version_run").eqNullSafe(F.col("app_version")) & run_app_id.eqNullSafe(F.col(app_col))
    )
    return pairs.withColumn("run_app_id", run_app_id).withColumn("matched", matched)


def rank_runs(matched: DataFrame, app_col: str = "app_id", bucket_seconds: int = 86400) -> DataFrame:
    """Runs of each application newest first (``run_rank`` 0, 1, ...);
    unparsable start times rank last, ties by run id.  Numbered in two
    levels (start-day buckets, then a prefix sum of earlier buckets' counts)
    so an application with very many runs is not ranked in one task."""
    staged = matched.withColumn("__start", run_start())
    bucket = F.floor(F.unix_seconds("__start") / F.lit(bucket_seconds))
    ranked = bucketed_row_number(
        staged, [app_col], bucket, [F.desc_nulls_last("__start"), F.desc("uniqueId")], "__rn", bucket_desc=True
    )
    return ranked.withColumn("run_rank", F.col("__rn") - 1).drop("__start", "__rn")


def positional_join(attempts: DataFrame, ranked_runs: DataFrame, app_col: str = "app_id",
                    pos_col: str = "attempt_pos") -> DataFrame:
    """Attempts (newest first) paired with runs taken in the opposite
    order of their listing, i.e. newest run to newest attempt; extra attempts
    get no run."""
    r = ranked_runs.withColumnRenamed(app_col, "__r_app")
    cond = (F.col(app_col) == F.col("__r_app")) & (F.col(pos_col) == F.col("run_rank"))
    return attempts.join(r, cond, "left").drop("__r_app")


def run_count_mismatch(attempts: DataFrame, matched_runs: DataFrame, app_col: str = "app_id") -> DataFrame:
    """Applications whose number of attempts differs from the number of
    matching runs (either side may be missing)."""
    a = attempts.groupBy(app_col).agg(F.count(F.lit(1)).alias("n_attempts"))
    r = matched_runs.groupBy(app_col).agg(F.count(F.lit(1)).alias("n_runs"))
    j = a.join(r, app_col, "full")
    j = j.select(app_col, F.coalesce("n_attempts", F.lit(0)).alias("n_attempts"), F.coalesce("n_runs", F.lit(0)).alias("n_runs"))
    return j.where(F.col("n_attempts") != F.col("n_runs"))


def latest_run(runs: DataFrame, keys: tuple[str, str] = ("dataset", "datasetVersion")) -> DataFrame:
    """Latest run per (dataset, version) by start time (unparsable last,
    ties by run id), plus the number of runs.  ``max_by`` aggregates map-side,
    so a dataset with most of the runs is still reduced in parallel."""
    start = F.coalesce(F.unix_millis(run_start()), F.lit(-(2 ** 63) + 1))
    return runs.groupBy(*keys).agg(
        F.max_by("uniqueId", F.struct(start, F.col("uniqueId"))).alias("uniqueId"),
        F.count(F.lit(1)).alias("n_runs"),
    )


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def size_info(info_col: str = INFO) -> Column:
    """The stored sizes of a run's info as a struct that ``post_metrics`` reads
    like the map; joins then carry these few texts instead of the map."""
    keys = sorted({key for pair in ETL_SIZE_KEYS.values() for key in pair})
    return F.when(F.col(info_col).isNotNull(), F.struct(*[info(key, info_col).alias(key) for key in keys]))


def post_metrics(df: DataFrame, type_col: Column | str = "type", in_mem: str = "stages_inputBytes_max",
                 out_mem: str = "stages_outputBytes_max", peak: str = "est_peak_memory_usage",
                 info_col: str = INFO) -> DataFrame:
    """M9: storage/memory factors of an ETL attempt joined with its run.

    Stored input/output sizes are read by application type; every factor
    needs the sizes it divides by to be present and non-zero.  No metrics
    (NULL struct) without stage sizes, without the run's info, or for an
    unknown type.
    """
    t = type_col if isinstance(type_col, Column) else F.col(type_col)

    def pick(side: int) -> Column:
        expr = None
        for etl_type, keys in ETL_SIZE_KEYS.items():
            v = typed_info(keys[side], info_col)["num"]
            expr = F.when(t == etl_type, v) if expr is None else expr.when(t == etl_type, v)
        return expr

    # staged as columns: each is read several times below, and the optimizer
    # keeps a repeatedly read, non-trivial column computed once
    staged = df.withColumn("__in_st", pick(0)).withColumn("__out_st", pick(1))
    in_st, out_st = F.col("__in_st"), F.col("__out_st")
    im, om, pk = F.col(in_mem).cast("double"), F.col(out_mem).cast("double"), F.col(peak).cast("double")
    blocks = lambda x: F.ceil(x / F.lit(float(HDFS_BLOCK_BYTES)))
    metrics = F.struct(
        F.when(_truthy(in_st), blocks(in_st)).alias("input_in_storage_HDFS_blocks"),
        F.when(_truthy(in_st) & (im != 0), im / in_st).alias("input_deserialization_factor"),
        F.when(_truthy(in_st) & (im != 0) & _truthy(pk), pk / in_st).alias("peak_to_input_memory_factor"),
        F.when(_truthy(out_st), blocks(out_st)).alias("output_in_storage_HDFS_blocks"),
        F.when(_truthy(out_st) & (om != 0), om / out_st).alias("output_deserialization_factor"),
        F.when(_truthy(out_st) & (om != 0) & _truthy(pk), pk / out_st).alias("peak_to_output_memory_factor"),
        F.when(_truthy(in_st) & _truthy(out_st), out_st / in_st).alias("output_to_input_storage_size_ratio"),
    )
    known = t.isin(*ETL_SIZE_KEYS.keys())
    ok = F.col(in_mem).isNotNull() & F.col(info_col).isNotNull() & known
    return staged.withColumn("postprocessing", F.when(ok, metrics)).drop("__in_st", "__out_st")


def checkpoint_controls(checkpoints: DataFrame, run_col: str = "run_id", pos_col: str = "cp_pos",
                        name_col: str = "name", controls_col: str = "controls") -> DataFrame:
    """Control check of each run's checkpoints.

    The first checkpoint (by position) with any control is the reference
    (a later duplicate name in it wins); each later checkpoint must have as
    many controls as the reference has names, and every control value must
    equal the reference's value for its name (values are text: '123' and
    '123.0' differ; a missing name is a mismatch).  The first failure by
    (checkpoint position, control position) is reported.

    Plan: one aggregate per run (count, reference position and the
    reference checkpoint's controls via ``min_by``), one join of the
    checkpoints with that row, a row-local check of each checkpoint's
    control list (array functions), and a final per-run ``min_by`` of the
    failures on the join's partitioning.  A run with very many checkpoints
    is still spread over tasks (partial aggregation; the join's large side
    can be split by AQE's skew handling).

    Output per run: elements_count, num_controls, controls_match and the
    first failure's checkpoint name, kind, control name/value and reference
    value.
    """
    # size(NULL) is NULL under ANSI mode and -1 without it: test for NULL first
    n = F.when(F.col(controls_col).isNull(), F.lit(0)).otherwise(F.size(controls_col))
    cp = checkpoints.select(
        F.col(run_col).alias("__run"), F.col(pos_col).alias("__pos"), remove_blanks(F.col(name_col)).alias("__name"),
        n.alias("__n"), F.col(controls_col).alias("__controls"),
    )
    ref_order = F.when(F.col("__n") > 0, F.col("__pos"))
    per_run = cp.groupBy("__run").agg(
        F.count(F.lit(1)).alias("elements_count"),
        F.min(ref_order).alias("__ref_pos"),
        F.min_by("__controls", ref_order).alias("__ref"),
    ).withColumn(
        "num_controls",
        F.when(F.col("__ref").isNull(), F.lit(0))
        .otherwise(F.size(F.array_distinct(F.transform("__ref", lambda r: r["controlName"]))))
        .cast("bigint"),
    )

    def ref_value(c: Column) -> Column:
        same = F.filter("__ref", lambda r: r["controlName"].eqNullSafe(c["controlName"]))
        return F.get(same, F.size(same) - 1)["controlValue"]  # the later duplicate wins

    checked = F.transform(
        "__controls",
        lambda c, i: F.struct(
            i.alias("ctrl_pos"), c["controlName"].alias("cname"), c["controlValue"].alias("cvalue"),
            ref_value(c).alias("ref_value"),
        ),
    )
    first_bad = F.get(F.filter(checked, lambda x: ~x["cvalue"].eqNullSafe(x["ref_value"])), 0)
    # controls that repeat the reference, whose names are all different, need no look at each
    same = F.col("__controls").eqNullSafe(F.col("__ref")) & (F.col("__n") == F.col("num_controls"))
    after_ref = (F.col("__pos") > F.col("__ref_pos")) & ~same
    count_bad = F.col("__n") != F.col("num_controls")
    err = (
        F.when(after_ref & count_bad, F.struct(
            F.col("__pos").alias("pos"), F.lit(-1).alias("ctrl_pos"), F.lit(True).alias("incorrect_num_controls"),
            F.col("__name").alias("cp_name"), F.lit(None).cast("string").alias("cname"),
            F.lit(None).cast("string").alias("cvalue"), F.lit(None).cast("string").alias("ref_value"),
        ))
        .when(after_ref & first_bad.isNotNull(), F.struct(
            F.col("__pos").alias("pos"), first_bad["ctrl_pos"].alias("ctrl_pos"), F.lit(False).alias("incorrect_num_controls"),
            F.col("__name").alias("cp_name"), first_bad["cname"].alias("cname"), first_bad["cvalue"].alias("cvalue"),
            first_bad["ref_value"].alias("ref_value"),
        ))
    )
    rows = cp.join(per_run, "__run").select("__run", "elements_count", "num_controls", err.alias("__err"))
    first = rows.groupBy("__run").agg(
        F.max("elements_count").alias("elements_count"),
        F.max("num_controls").alias("num_controls"),
        F.min_by("__err", F.when(F.col("__err").isNotNull(), F.struct(F.col("__err.pos"), F.col("__err.ctrl_pos"))))
        .alias("err"),
    )
    return first.select(
        F.col("__run").alias(run_col),
        "elements_count",
        "num_controls",
        F.col("err").isNull().alias("controls_match"),
        F.col("err.cp_name").alias("error_checkpoint"),
        F.col("err.incorrect_num_controls").alias("error_incorrect_num_controls"),
        F.col("err.cname").alias("error_controlName"),
        F.col("err.cvalue").alias("error_controlValue"),
        F.col("err.ref_value").alias("error_initialControlValue"),
    )


def checkpoint_durations(checkpoints: DataFrame, run_col: str = "run_id", pos_col: str = "cp_pos",
                         name_col: str = "name", start_col: str = "processStartTime",
                         end_col: str = "processEndTime") -> DataFrame:
    """Per run and checkpoint name (blanks removed; a later checkpoint
    with the same name wins), parsed start/end and duration in ms (NULL
    unless both times parse).  The times are kept as two numbers each, which
    Spark aggregates in a hash table without sorting the rows first."""
    named = checkpoints.select(
        F.col(run_col), remove_blanks(F.col(name_col)).alias("name"), F.col(pos_col),
        parse_date(F.col(start_col)).alias("__start"), parse_date(F.col(end_col)).alias("__end"),
    )
    last = named.groupBy(run_col, "name").agg(
        F.max_by("__start", pos_col).alias("processStartTime"), F.max_by("__end", pos_col).alias("processEndTime"))
    duration = F.unix_millis("processEndTime") - F.unix_millis("processStartTime")
    return last.withColumn("duration", duration.cast("double"))
