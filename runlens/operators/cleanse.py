"""Projections, cleansing and enrichment.

Nested documents are cleaned with higher-order functions (``transform``,
``dropFields``, ``map_filter``) so each document is handled inside its own
row: no explode, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.constants import DROP_KEYS, PROPERTY_CASTS, TIME_KEYS
from runlens.functions import (
    parse_bytes,
    parse_bytes_kib,
    parse_bytes_mib,
    parse_gmt,
    parse_ms,
    to_bool,
    url_host,
)


def drop_fields(df: DataFrame, doc_type: str, keys: dict[str, list[str]] = DROP_KEYS) -> DataFrame:
    """Drop the listed top-level fields of a flat table (missing ones are ignored)."""
    present = [k for k in keys.get(doc_type, []) if k in df.columns]
    return df.drop(*present)


def drop_nested_fields(arr: Column, element_type: T.StructType, names: list[str]) -> Column:
    """P1 for arrays of structs: drop the listed fields of every element."""
    present = [n for n in names if n in element_type.fieldNames()]
    if not present:
        return arr
    return F.transform(arr, lambda x: x.dropFields(*present))


def drop_map_keys(map_col: Column, names: list[str]) -> Column:
    """P1 for maps: drop the listed keys."""
    return F.map_filter(map_col, lambda k, v: ~k.isin(*names))


def parse_time_fields(df: DataFrame, doc_type: str, time_keys: dict[str, list[str]] = TIME_KEYS) -> DataFrame:
    """Cast the listed GMT time strings to timestamps (missing fields skipped;
    malformed texts become NULL)."""
    out = df
    for k in time_keys.get(doc_type, []):
        if k in df.columns and isinstance(df.schema[k].dataType, T.StringType):
            out = out.withColumn(k, parse_gmt(F.col(k)))
    return out


def property_map(pairs: Column) -> Column:
    """P3 step 1: list of [key, value] pairs -> map with '.' -> '_' in keys.

    A later duplicate key wins (the session runs with
    ``spark.sql.mapKeyDedupPolicy=LAST_WIN``).
    """
    return F.map_from_entries(
        F.transform(
            pairs,
            lambda p: F.struct(
                F.replace(F.element_at(p, 1), F.lit("."), F.lit("_")).alias("key"), F.element_at(p, 2).alias("value")
            ),
        )
    )


_CASTERS = {
    "int": lambda c: c.try_cast("bigint"),
    "float": lambda c: c.try_cast("double"),
    "bool": to_bool,
    "bytes": parse_bytes,
    "bytes_mib": parse_bytes_mib,
    "bytes_kib": parse_bytes_kib,
    "ms": parse_ms,
}


def typed_property(props: Column, name: str, casts: dict[str, list[str]] = PROPERTY_CASTS) -> Column:
    """P3 step 2 for one key: the value typed by the key's cast (text when
    the key has none).  ``yarn_scheduler_heartbeat_interval-ms`` is already
    in milliseconds, so it is read with a millisecond default."""
    raw = F.element_at(props, F.lit(name))
    for kind, names in casts.items():
        if name in names:
            if name.endswith("-ms"):
                return parse_ms(raw, default_multiplier=1)
            return _CASTERS[kind](raw)
    return raw


def typed_properties(props: Column, casts: dict[str, list[str]] = PROPERTY_CASTS,
                     only: list[str] | None = None) -> Column:
    """P3 step 2: struct of typed columns, one per key of the cast table (or
    of ``only``).  Absent keys give NULL fields.  Ask for the keys a query
    reads: a struct read several times is computed whole for every row."""
    names = only if only is not None else [n for ns in casts.values() for n in ns]
    return F.struct(*[typed_property(props, n, casts).alias(n) for n in names])


def untyped_properties(props: Column, casts: dict[str, list[str]] = PROPERTY_CASTS) -> Column:
    """The keys not in the cast table, kept as text."""
    typed = [n for names in casts.values() for n in names]
    return F.map_filter(props, lambda k, v: ~k.isin(*typed))


def clean_environment(env: DataFrame, pairs_col: str = "sparkProperties", typed_keys: list[str] | None = None) -> DataFrame:
    """Properties to map (listed keys dropped), typed struct (all keys of
    the cast table, or ``typed_keys``) and text rest; runtime.javaHome and
    the two bulky sections dropped."""
    props = drop_map_keys(property_map(F.col(pairs_col)), DROP_KEYS["sparkProperties"])
    out = env.withColumn(pairs_col, props).withColumn(
        "typedProperties", typed_properties(F.col(pairs_col), only=typed_keys)
    )
    if "runtime" in env.columns and "javaHome" in env.schema["runtime"].dataType.fieldNames():
        out = out.withColumn("runtime", F.col("runtime").dropFields("javaHome"))
    return drop_fields(out, "environment")


def last_attempt(apps: DataFrame, attempts_col: str = "attempts") -> DataFrame:
    """Keep only the newest attempt (attempts are listed newest first)."""
    return apps.withColumn(attempts_col, F.slice(F.col(attempts_col), 1, 1))


def flatten_attempts(apps: DataFrame, attempts_col: str = "attempts", id_field: str = "attemptId") -> DataFrame:
    """One row per attempt with ``isFinalAttempt`` (no id, or the id of
    the first, newest, attempt).  ``posexplode`` keeps each application's
    attempts in its own row: no shuffle."""
    first_id = F.element_at(F.col(attempts_col), 1)[id_field]
    exploded = apps.select(
        *[c for c in apps.columns if c != attempts_col],
        first_id.alias("__first_id"),
        F.posexplode(F.col(attempts_col)).alias("attempt_pos", "attempt"),
    )
    aid = F.col("attempt")[id_field]
    return exploded.withColumn(
        "isFinalAttempt", aid.isNull() | (aid == F.col("__first_id"))
    ).drop("__first_id")


def final_attempt_flag(attempts: DataFrame, app_col: str = "app_id", attempt_col: str = "attempt_id",
                       order_col: str = "startTime") -> DataFrame:
    """P7 on a flat attempts table: an attempt is final when it has no id or
    it is the latest attempt of its application."""
    latest = attempts.groupBy(app_col).agg(F.max_by(attempt_col, order_col).alias("__latest"))
    return attempts.join(latest, app_col, "left").withColumn(
        "isFinalAttempt", F.col(attempt_col).isNull() | (F.col(attempt_col) == F.col("__latest"))
    ).drop("__latest")


def stamp_meta(df: DataFrame, processed_at: Column, host_url: Column | str | None = None,
               host_field: str = "history_host") -> DataFrame:
    """Add ``meta.time_processed`` (a parameter, for determinism) and the
    source host taken from its URL."""
    fields = [processed_at.cast("timestamp").alias("time_processed")]
    if host_url is not None:
        src = F.col(host_url) if isinstance(host_url, str) else host_url
        fields.append(url_host(src).alias(host_field))
    return df.withColumn("meta", F.struct(*fields))


def filter_names(df: DataFrame, predicate: Column | str | None = None, name_col: str = "name") -> DataFrame:
    """Keep rows whose name passes a predicate (default: all)."""
    if predicate is None:
        return df
    return df.where(F.expr(predicate) if isinstance(predicate, str) else predicate)


def attempt_key(attempt_id: Column) -> Column:
    """A missing attempt id means the only attempt ('0')."""
    return F.coalesce(attempt_id.cast("string"), F.lit("0"))


def merge_app_doc(attempts: DataFrame, executors: DataFrame, stages: DataFrame,
                  environment: DataFrame | None = None,
                  keys: tuple[str, str] = ("app_id", "attempt_id"), nested: bool = False,
                  stage_status: str | None = None) -> DataFrame:
    """Attach executors, stages (optionally only those of one
    ``stage_status``) and the environment to their attempt; a missing
    attempt id means '0' on every side.

    ``nested=False`` (default) joins per-attempt summaries: executors and
    stages are each reduced to one row per attempt (``n_executors``,
    ``n_stages``, ``n_status_stages``) before the join, so the joins see
    attempt-sized inputs and no group is gathered anywhere.
    ``nested=True`` builds the document form, arrays ``allexecutors`` and
    ``stages`` on the attempt row via ``collect_list``: only for documents of
    a known small size, since one attempt's rows land in one task.
    """
    app, att = keys
    norm = lambda df: df.withColumn(att, attempt_key(F.col(att)))
    a, e, s = norm(attempts), norm(executors), norm(stages)
    if stage_status is not None:
        s_sel = s.where(F.col("status") == F.lit(stage_status))
    else:
        s_sel = s
    if nested:
        ex_cols = [c for c in e.columns if c not in keys]
        st_cols = [c for c in s_sel.columns if c not in keys]
        ex_side = e.groupBy(app, att).agg(F.collect_list(F.struct(*ex_cols)).alias("allexecutors"))
        st_side = s_sel.groupBy(app, att).agg(F.collect_list(F.struct(*st_cols)).alias("stages"))
    else:
        ex_side = e.groupBy(app, att).agg(F.count(F.lit(1)).alias("n_executors"))
        status_count = (
            F.count_if(F.col("status") == F.lit(stage_status)) if stage_status is not None else F.count(F.lit(1))
        )
        st_side = s.groupBy(app, att).agg(F.count(F.lit(1)).alias("n_stages"), status_count.alias("n_status_stages"))
    out = a.join(ex_side, [app, att], "left").join(st_side, [app, att], "left")
    if environment is not None:
        out = out.join(norm(environment), [app, att], "left")
    return out


def with_typed_properties(df: DataFrame, props_col: str, out: str, casts: dict[str, list[str]] = PROPERTY_CASTS) -> DataFrame:
    """P3 step 2 for all keys of the cast table: the properties of one kind
    are cast by one expression over their part of the map, and the struct
    picks its fields from these (a cast for each of some fifty keys makes
    code that does not compile)."""
    kinds = {kind: (names, _CASTERS[kind]) for kind, names in casts.items()}
    exact = [n for names in casts.values() for n in names if n.endswith("-ms")]
    kinds["exact_ms"] = (exact, lambda c: parse_ms(c, default_multiplier=1))
    staged = df.withColumns({
        f"__{kind}": F.transform_values(F.map_filter(F.col(props_col), lambda k, v: k.isin(*names)), lambda k, v: cast(v))
        for kind, (names, cast) in kinds.items() if names})
    fields = [F.element_at(f"__{'exact_ms' if n in exact else kind}", F.lit(n)).alias(n) for kind, names in casts.items() for n in names]
    return staged.withColumn(out, F.struct(*fields)).drop(*[f"__{kind}" for kind in kinds])


def with_environment(df: DataFrame, source: Column, env_type: T.StructType) -> DataFrame:
    """P4 for an environment inside a document: adds ``environment`` with the
    properties as a map (listed keys dropped), the typed struct, and the
    runtime without its home."""
    staged = df.withColumn("__props", drop_map_keys(property_map(source["sparkProperties"]), DROP_KEYS["sparkProperties"]))
    staged = with_typed_properties(staged, "__props", "__typed")
    fields = [F.col("__props").alias("sparkProperties"), F.col("__typed").alias("typedProperties")]
    if "runtime" in env_type.fieldNames():
        runtime = source["runtime"]
        if "javaHome" in env_type["runtime"].dataType.fieldNames():
            runtime = runtime.dropFields("javaHome")
        fields.append(runtime.alias("runtime"))
    return staged.withColumn("environment", F.when(source.isNotNull(), F.struct(*fields))).drop("__props", "__typed")


def uncast_properties(props: Column, casts: dict[str, list[str]] = PROPERTY_CASTS) -> Column:
    """The int and float properties whose text is no number, as an array
    of (key, value) structs."""
    def is_bad(entry: Column) -> Column:
        out = F.lit(False)
        for kind in ("int", "float"):
            out = out | (entry["key"].isin(*casts[kind]) & entry["value"].isNotNull() & _CASTERS[kind](entry["value"]).isNull())
        return out

    return F.filter(F.map_entries(props), is_bad)


def documents_to_tables(apps: DataFrame, attempts_col: str = "attempts",
                        environment: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P5: nested application documents -> (attempts, executors, stages)
    flat tables keyed by (app_id, attempt_id), times parsed, listed fields
    dropped.  Each ``explode`` works inside one document's row.  With
    ``environment`` the attempts keep theirs, cleaned and typed (P4)."""
    flat = flatten_attempts(apps, attempts_col)
    base = flat.select(
        F.col("id").alias("app_id"), attempt_key(F.col("attempt.attemptId")).alias("attempt_id"), "name",
        "attempt_pos", "isFinalAttempt", "attempt",
    )
    element = apps.schema[attempts_col].dataType.elementType
    at_fields = [f for f in element.fieldNames() if f not in ("allexecutors", "stages", "environment", "attemptId")]
    rows, columns = base, [F.col("attempt")[f].alias(f) for f in at_fields]
    if environment and "environment" in element.fieldNames():
        rows = with_environment(base, F.col("attempt.environment"), element["environment"].dataType)
        columns.append(F.col("environment"))
    attempts = parse_time_fields(
        rows.select("app_id", "attempt_id", "name", "attempt_pos", "isFinalAttempt", *columns), "attempt")
    ex = base.select("app_id", "attempt_id", F.explode("attempt.allexecutors").alias("e")).select("app_id", "attempt_id", "e.*")
    st = base.select("app_id", "attempt_id", F.explode("attempt.stages").alias("s")).select("app_id", "attempt_id", "s.*")
    executors = drop_fields(parse_time_fields(ex, "executor"), "executor")
    stages = drop_fields(parse_time_fields(st, "stage"), "stage")
    return attempts, executors, stages
