"""Structured Streaming forms of the polling loops.

The loop "list runs, skip seen ones, process, sleep" becomes a file stream
of listed runs with a watermark on the completion time: duplicates of the
same (app, attempt) within the lookback are dropped by Spark's state store,
late runs inside the lookback are still processed, and the step counts are
windowed aggregates.  ``trigger="availableNow"`` is the one-pass batch mode,
``trigger="<n> seconds"`` the endless loop.  Progress lives in the
checkpoint folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runlens.constants import LOOKBACK_HOURS, STEP_SECONDS
from runlens.operators import incremental as I
from runlens.session import materialized
from runlens.sources.dated import overwrite_dates, read_if_there


def listed_runs(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Stream of listed runs landed as files (one folder, new files
    picked up as they arrive)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def new_runs(stream: DataFrame, time_col: str = "end_time", keys: list[str] | None = None,
             lookback_hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Runs deduplicated on their key within the lookback (watermark):
    a run listed again is dropped, a late run inside the lookback is kept.
    The key is (application, attempt) unless ``keys`` says otherwise: another
    attempt of an application is another run."""
    return stream.withWatermark(time_col, f"{lookback_hours} hours").dropDuplicatesWithinWatermark(keys or ["app_id", "attempt_id"])


def step_counts(stream: DataFrame, time_col: str = "end_time", step_seconds: int = STEP_SECONDS,
                lookback_hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Runs per completion-time step (tumbling windows)."""
    return (
        stream.withWatermark(time_col, f"{lookback_hours} hours")
        .groupBy(F.window(time_col, f"{step_seconds} seconds").alias("step"))
        .agg(F.count(F.lit(1)).alias("n_runs"))
        .select(F.col("step.start").alias("step_start"), F.col("step.end").alias("step_end"), "n_runs")
    )


def start(df: DataFrame, checkpoint: str | None = None, trigger: str = "availableNow", output_mode: str = "append",
          sink: str | None = None, path: str | None = None,
          foreach_batch: Callable[[DataFrame, int], None] | None = None,
          query_name: str | None = None) -> StreamingQuery:
    """Start a streaming query; ``foreach_batch`` receives each
    micro-batch with its id (used for idempotent versioned upserts).  Without
    ``checkpoint`` the query's progress goes to ``<spark.checkpoint.dir>/<query_name>``
    (a restarted query with the same name resumes)."""
    if checkpoint is None:
        if not query_name:
            raise ValueError("give a checkpoint folder or a query_name")
        from runlens.session import checkpoint_path

        checkpoint = checkpoint_path(df.sparkSession, query_name)
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if query_name:
        w = w.queryName(query_name)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    if sink:
        w = w.format(sink)
    return w.start(path) if path else w.start()


def observe_runs(df: DataFrame, name: str = "runs"):
    """A19 (batch): attach a row counter to a DataFrame; after an action,
    ``observation.get["runs"]`` is the number of runs processed (counted by
    the executors as the rows flow, no extra job)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("runs")), obs


def runs_per_hour(runs: int, seconds: float) -> float:
    """Processing rate as the source logs it (runs x 3600 / seconds)."""
    return runs * 3600.0 / seconds if seconds > 0 else 0.0


def stream_runs_per_hour(query: StreamingQuery) -> float | None:
    """A19 (stream): the last micro-batch's processing rate in runs/hour."""
    p = query.lastProgress
    if not p or p.get("processedRowsPerSecond") is None:
        return None
    return float(p["processedRowsPerSecond"]) * 3600.0


def high_watermarks(stream: DataFrame, key: str = "host", time_col: str = "end_time") -> DataFrame:
    """X6 (stream): the latest completion time seen per source, kept in the
    state store by a streaming aggregation (partial maxima per task, merged
    with the stored state each micro-batch); run with output mode
    ``update`` (changed sources only) or ``complete``."""
    return stream.groupBy(key).agg(F.max(time_col).alias("high_watermark"), F.count(F.lit(1)).alias("n_runs"))


def since_latest_batch(df: DataFrame, batch_id: int, base: str, key: str = "id", time_col: str = "end_time") -> DataFrame:
    """X6, one micro-batch: the listed runs at or after the greatest time
    processed so far, without those already processed at that time.

    The state, the greatest time with the ids tied at it, is a small table
    with one partition per micro-batch; a batch reads the newest one before
    its own and replaces its own, so running it again gives the same rows and
    the same state.  New runs are written to ``<base>/new`` the same way."""
    spark = df.sparkSession
    known = read_if_there(spark, f"{base}/state")
    state = None
    if known is not None:
        before = known.where(F.col("batch") < batch_id)
        state = before.where(F.col("batch") == before.agg(F.max("batch")).scalar()).drop("batch")
        state = None if state.isEmpty() else materialized(state)
    listed = df.dropDuplicates([key])
    new = materialized(listed if state is None else I.since_high_watermark(listed, state, time_col, key))
    seen = new.select(key, time_col) if state is None else state.select(key, time_col).unionByName(new.select(key, time_col))
    overwrite_dates(new.withColumn("batch", F.lit(batch_id)), f"{base}/new", ["batch"])
    overwrite_dates(I.rows_at_latest(seen, time_col).withColumn("batch", F.lit(batch_id)), f"{base}/state", ["batch"])
    return new


def since_latest(stream: DataFrame, base: str, checkpoint: str, key: str = "id", time_col: str = "end_time",
                 trigger: str = "availableNow") -> StreamingQuery:
    """X6 as a stream: every micro-batch through ``since_latest_batch``."""
    base = base.rstrip("/")

    def batch(df: DataFrame, batch_id: int) -> None:
        since_latest_batch(df, batch_id, base, key, time_col)

    return start(stream, checkpoint, trigger, foreach_batch=batch)
