"""Incremental processing of listed runs.

Batch forms of the polling loop: instead of slicing a window into steps and
looping, one job assigns every run to its step (integer step index) and
aggregates all steps at once.  "Already processed" is a join against the
store's ids (``left_anti``), never a driver-side set.  The as-of time is a
parameter (a literal or a one-row DataFrame column), never the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.constants import LOOKBACK_HOURS, SETTLING_SECONDS, STEP_SECONDS


def max_time(df: DataFrame, time_col: str, alias: str = "as_of") -> DataFrame:
    """One-row frame with the greatest time (NULL for an empty store)."""
    return df.agg(F.max(time_col).alias(alias))


def scalar_max(df: DataFrame, time_col: str) -> Column:
    """The greatest value of a column as a scalar subquery: computed once
    (partial maxima per task, then one final row), used like a literal."""
    return df.agg(F.max(time_col)).scalar()


def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row, each as a scalar
    subquery (no join)."""
    return df.select("*", *[scalar.select(c).scalar().alias(c) for c in scalar.columns])


def _ts(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def lookback_bounds(asof: Column, lookback_hours: int = LOOKBACK_HOURS,
                    settle_seconds: int = SETTLING_SECONDS) -> tuple[Column, Column]:
    """Window [asof - lookback, asof - settling]."""
    lo = F.timestamp_add("HOUR", F.lit(-lookback_hours), asof)
    hi = F.timestamp_add("SECOND", F.lit(-settle_seconds), asof)
    return lo, hi


def in_range(df: DataFrame, time_col: str, lo: Column, hi: Column) -> DataFrame:
    """Rows whose time lies in [lo, hi] (inclusive both ends)."""
    return df.where(F.col(time_col).between(lo, hi))


def settled(df: DataFrame, time_col: str, asof: Column, settle_seconds: int = SETTLING_SECONDS) -> DataFrame:
    """Only runs completed at least ``settle_seconds`` before as-of."""
    return df.where(F.col(time_col) <= F.timestamp_add("SECOND", F.lit(-settle_seconds), asof))


def new_runs(listed: DataFrame, processed: DataFrame, key: str | list[str] = "id") -> DataFrame:
    """Listed runs whose key is not in the store.  A left anti join:
    Spark picks broadcast or shuffle from the store side's size (AQE
    re-plans at runtime), the processed set is never collected."""
    keys = [key] if isinstance(key, str) else key
    return listed.join(processed.select(*keys), keys, "left_anti")


def step_index(time_col: str, window_start: Column, step_seconds: int = STEP_SECONDS) -> Column:
    """Index of the step [start + i*step, start + (i+1)*step) a time is in."""
    micros = F.unix_micros(F.col(time_col)) - F.unix_micros(window_start)
    return F.floor(micros / F.lit(step_seconds * 1_000_000)).cast("bigint")


def assign_steps(df: DataFrame, time_col: str, window_start: Column, window_end: Column,
                 step_seconds: int = STEP_SECONDS) -> DataFrame:
    """Runs of [window_start, window_end) with their step index and the
    step bounds (the last step clipped to the window end).  An empty or
    negative window keeps no rows."""
    idx = step_index(time_col, window_start, step_seconds)
    start = F.timestamp_add("SECOND", idx * F.lit(step_seconds), window_start)
    end = F.least(F.timestamp_add("SECOND", (idx + 1) * F.lit(step_seconds), window_start), window_end)
    kept = df.where((F.col(time_col) >= window_start) & (F.col(time_col) < window_end) & (window_start < window_end))
    return kept.withColumn("step", idx).withColumn("step_start", start).withColumn("step_end", end)


def step_counters(listed: DataFrame, processed: DataFrame, time_col: str, window_start: Column,
                  window_end: Column, name_filter: Column | None = None, key: str = "id",
                  step_seconds: int = STEP_SECONDS) -> DataFrame:
    """Per step, runs listed (``total``), passing the name filter
    (``matched``), and matched but not yet in the store (``new``).

    Store membership is a left join against the distinct store keys (both
    sides hash-partitioned by key once), then one aggregate over all steps.
    """
    seen = processed.select(key).distinct().withColumn("__seen", F.lit(True))
    steps = assign_steps(listed, time_col, window_start, window_end, step_seconds)
    flagged = steps.join(seen, key, "left")
    match = name_filter if name_filter is not None else F.lit(True)
    is_new = match & F.col("__seen").isNull()
    return flagged.groupBy("step", "step_start", "step_end").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(match).alias("matched"),
        F.count_if(is_new).alias("new"),
    )


def rows_at_latest(store: DataFrame, time_col: str) -> DataFrame:
    """T5: every row at the store's greatest time (ties kept)."""
    return store.where(F.col(time_col) == scalar_max(store, time_col))


def since_high_watermark(listed: DataFrame, store: DataFrame, time_col: str, key: str = "id") -> DataFrame:
    """Runs at or after the store's high watermark, minus those already
    stored at exactly that time (the tie set)."""
    ties = rows_at_latest(store, time_col).select(key)
    after = listed.where(F.col(time_col) >= scalar_max(store, time_col))
    return after.join(ties, key, "left_anti")


def resume_point(store: DataFrame, time_col: str, start: Column | str | None) -> DataFrame:
    """The later of the store's greatest time and a given start time."""
    m = F.max(time_col)
    if start is None:
        return store.agg(m.alias("resume_from"))
    return store.agg(F.greatest(m, _ts(start)).alias("resume_from"))


def finished_since_latest(apps: DataFrame, store: DataFrame, time_col: str = "finishedTime",
                          state_col: str = "state", finished: str = "FINISHED") -> DataFrame:
    """Finished applications at or after the store's greatest finish time
    (inclusive, the upsert makes re-reads harmless); all finished ones when
    the store is empty."""
    hw = scalar_max(store, time_col)
    fin = apps.where(F.col(state_col) == F.lit(finished))
    return fin.where(hw.isNull() | (F.col(time_col) >= hw))


def latest_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key.

    ``max_by`` is an aggregate with a map-side partial step, so a key that
    holds a large share of the rows is reduced on every map task before the
    shuffle (unlike a window, which sorts the whole key in one task).
    """
    keys = [key] if isinstance(key, str) else key
    payload = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in payload]), F.struct(*[F.col(f"`{c}`") for c in order])).alias("__row")
    )
    return best.select(*keys, "__row.*")


def upsert(existing: DataFrame, updates: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """Latest-wins merge of updates into a table keyed by ``key``.
    An update wins over an existing row with an equal ``order`` tuple.
    Running it twice with the same updates gives the same table."""
    tagged = existing.withColumn("__src", F.lit(0)).unionByName(
        updates.withColumn("__src", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(tagged, key, [*order, "__src"]).drop("__src")


def ids_desc(store: DataFrame, time_col: str, lo: Column, hi: Column, id_col: str = "id",
             size: int | None = None) -> DataFrame:
    """Ids in a time range, newest first; all of them (an id left out
    would look new) unless ``size`` asks for a top-k."""
    ids = in_range(store, time_col, lo, hi).select(id_col, time_col).orderBy(F.desc(time_col), id_col)
    return ids if size is None else ids.limit(size)


def distinct_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """The set of ids."""
    return df.select(id_col).distinct()
