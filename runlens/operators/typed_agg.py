"""Type-directed aggregation of a collection per group (A1-A10).

``typed_aggregate`` looks at ``df.schema`` once, on the driver, and builds a
single ``groupBy(keys).agg(...)`` with one expression per (column, aggregate)
chosen by the column's type.  Catalyst prunes every aggregate a consumer does
not select, and Spark splits the aggregate into a map-side partial and a
final step, so only one row per group and map task is shuffled.

Structs are flattened to dotted columns first (lists and maps are left out).

Distinct counts (``nunique``) default to ``"exact"``.  A count of the rows of
each group, made first, tells the groups of more than ``GROUP_ROWS`` rows.
All others count their distinct values in the one aggregation (a group's
values are held by its task, ``GROUP_ROWS`` a column at most).  The large
groups, if there are any, are computed apart: their numeric columns are
turned into one long relation (keys, column number, value), each value in the
column of its own kind (BIGINT, DOUBLE, decimals as text), deduplicated once
(a map-side partial aggregate, then a shuffle on the whole row, so a group
holding a third of all rows is still spread over many tasks), and each
column's rows are counted.  That relation has a row for each value, so only
groups that need it pay for it.  ``nunique="approx"`` uses HyperLogLog++
(``approx_count_distinct``) and ``nunique="set"`` keeps each group's distinct
values in memory without looking at its size; use it only for groups with a
known small bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.session import materialized

GROUP_ROWS = 10_000  # of a group whose distinct values one task may hold
BROADCAST_GROUPS = 100_000

AggFn = Callable[[Column], Column]


def _present(c: Column, value: Column) -> Column:
    """An aggregate of a column that has no value in the group is omitted
    (NULL): the source only aggregates columns it sees with values."""
    return F.when(F.count(c) > 0, value)


def exact_nunique(c: Column) -> Column:
    """Stands for the exact distinct count in a type table; computed by
    ``distinct_counts``.  As a plain expression it is what Spark would do."""
    return _present(c, F.count_distinct(c))


def _nunique(mode: str) -> AggFn | None:
    if mode == "exact":
        return exact_nunique
    if mode == "approx":
        return lambda c: _present(c, F.approx_count_distinct(c))
    if mode == "set":
        return lambda c: _present(c, F.size(F.collect_set(c)).cast("bigint"))
    if mode == "none":
        return None
    raise ValueError(f"unknown nunique mode {mode!r}")


def numeric_aggs(nunique: str = "exact") -> dict[str, AggFn]:
    """``nunique="none"`` leaves the distinct count out (for consumers that
    never read it, e.g. the attempt summary)."""
    aggs = {
        "min": F.min,
        "max": F.max,
        "sum": F.sum,
        "mean": F.avg,
        "nunique": _nunique(nunique),
        "count_zeroes": lambda c: _present(c, F.count_if(c == 0)),
        "count_not_null": lambda c: _present(c, F.count(c)),
    }
    return {k: v for k, v in aggs.items() if v is not None}


TIME_AGGS: dict[str, AggFn] = {"min": F.min, "max": F.max}
BOOL_AGGS: dict[str, AggFn] = {
    "any": F.bool_or,
    "all": F.bool_and,
    "sum": lambda c: _present(c, F.count_if(c)),
}

# Optional aggregates (not in the default table).
EXTRA_NUMERIC_AGGS: dict[str, AggFn] = {
    "rsd": lambda c: F.when(F.avg(c) != 0, F.try_divide(F.stddev_samp(c), F.abs(F.avg(c)))),
}
EXTRA_STRING_AGGS: dict[str, AggFn] = {
    "count_not_null": F.count,
    "concat_unique": lambda c: F.array_join(F.array_sort(F.collect_set(c)), "|"),
}


def default_type_aggs(nunique: str = "exact") -> list[tuple[tuple[type, ...], dict[str, AggFn]]]:
    """Type table: numeric -> 7 aggregates, timestamps -> min/max, bool -> any/all/sum."""
    return [
        ((T.NumericType,), numeric_aggs(nunique)),
        ((T.TimestampType, T.TimestampNTZType), TIME_AGGS),
        ((T.BooleanType,), BOOL_AGGS),
    ]


def agg_column_name(field: str, agg: str) -> str:
    return f"{field}_{agg}"


def aggregate_specs(
    schema: T.StructType,
    exclude: Iterable[str] = (),
    type_aggs: list[tuple[tuple[type, ...], dict[str, AggFn]]] | None = None,
    prefix: str = "",
) -> list[tuple[str, Column]]:
    """(output name, aggregate expression) for every top-level column, chosen by type."""
    type_aggs = type_aggs if type_aggs is not None else default_type_aggs()
    skip = set(exclude)
    specs = []
    for field in schema.fields:
        if field.name in skip:
            continue
        for types, aggs in type_aggs:
            if isinstance(field.dataType, types):
                for agg_name, fn in aggs.items():
                    name = prefix + agg_column_name(field.name, agg_name)
                    specs.append((name, fn(F.col(f"`{field.name}`")).alias(name)))
                break
    return specs


def aggregate_exprs(
    schema: T.StructType,
    exclude: Iterable[str] = (),
    type_aggs: list[tuple[tuple[type, ...], dict[str, AggFn]]] | None = None,
    prefix: str = "",
) -> list[Column]:
    """Aggregate expressions for every top-level column, chosen by type."""
    return [e for _, e in aggregate_specs(schema, exclude, type_aggs, prefix)]


def flattened(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Structs as dotted columns, at any depth (``keep``: names left as they
    are); lists and maps stay opaque."""
    keep = set(keep)
    if not any(isinstance(f.dataType, T.StructType) and f.name not in keep for f in df.schema.fields):
        return df

    def walk(name: str, c: Column, kind: T.DataType) -> list[Column]:
        if not isinstance(kind, T.StructType):
            return [c.alias(name)]
        return [x for f in kind.fields for x in walk(f"{name}.{f.name}", c.getField(f.name), f.dataType)]

    return df.select(*[x for f in df.schema.fields for x in (
        [F.col(f"`{f.name}`")] if f.name in keep else walk(f.name, F.col(f"`{f.name}`"), f.dataType))])


VALUE_KINDS = {"__b": "bigint", "__d": "double", "__x": "string"}


def _value_kind(kind: T.DataType) -> str:
    """Where a value of the type lies unchanged: decimals of one column have
    one scale, so their text tells them apart exactly."""
    return "__b" if isinstance(kind, T.IntegralType) else "__x" if isinstance(kind, T.DecimalType) else "__d"


def distinct_cells(df: DataFrame, keys: list[str], cols: list[str], first: int = 0) -> DataFrame:
    """(keys, __c, __b, __d, __x): one row per non-NULL value, numbered by
    column from ``first`` on."""
    fields = {f.name: f.dataType for f in df.schema.fields}

    def cell(i: int, name: str) -> Column:
        own = _value_kind(fields[name])
        return F.struct(F.lit(i).alias("__c"), *[
            (F.col(f"`{name}`").cast(typ) if kind == own else F.lit(None).cast(typ)).alias(kind) for kind, typ in VALUE_KINDS.items()])

    cells = F.array(*[cell(i, c) for i, c in enumerate(cols, first)])
    return df.select(*keys, F.inline(cells)).where("__b is not null or __d is not null or __x is not null")


def count_cells(cells: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One row per group: the distinct cells of every column, NULL for none."""
    return cells.distinct().groupBy(*keys).agg(
        *[F.nullif(F.count_if(F.col("__c") == i), F.lit(0).cast("bigint")).alias(n) for i, n in enumerate(names)])


def distinct_counts(df: DataFrame, keys: list[str], cols: list[str], prefix: str = "") -> DataFrame:
    """Exact number of distinct non-NULL values of each of ``cols`` per group,
    as ``<prefix><col>_nunique`` columns (see the module doc for the plan).
    Values keep their own type: BIGINT, DOUBLE, or a decimal's text."""
    return count_cells(distinct_cells(df, keys, cols), keys, [f"{prefix}{c}_nunique" for c in cols])


def set_counts(schema: T.StructType, cols: list[str], prefix: str = "") -> list[Column]:
    """The same counts as aggregates of values held as sets (doubles as
    grouping sees them: one zero, one NaN)."""

    def count(name: str) -> Column:
        c = F.col(f"`{name}`")
        if not isinstance(schema[name].dataType, (T.DoubleType, T.FloatType)):
            return F.size(F.collect_set(c))
        nan = F.isnan(c)
        return F.size(F.collect_set(F.when(~nan, c + F.lit(0.0)))) + F.coalesce(F.max(nan.cast("int")), F.lit(0))

    return [F.nullif(count(c).cast("bigint"), F.lit(0).cast("bigint")).alias(f"{prefix}{c}_nunique") for c in cols]


def large_groups(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """Keys of the groups of more than ``GROUP_ROWS`` rows; None without any."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > GROUP_ROWS)
    large = materialized(counts.select(*[F.col(k).alias(f"__large_{k}") for k in keys]))
    n = large.count()
    return None if n == 0 else F.broadcast(large) if n <= BROADCAST_GROUPS else large


def _exact_columns(schema: T.StructType, skip: set[str], type_aggs) -> list[str]:
    """Numeric columns whose type table asks for the exact distinct count."""
    out = []
    for field in schema.fields:
        aggs = next((a for types, a in type_aggs if field.name not in skip and isinstance(field.dataType, types)), {})
        if aggs.get("nunique") is exact_nunique and isinstance(field.dataType, T.NumericType):
            out.append(field.name)
    return out


def _with_exact_nunique(rows: DataFrame, others: DataFrame, keys: list[str], aggs: list[Column], cols: list[str], prefix: str,
                        order: list[str]) -> DataFrame:
    """Aggregates ``aggs`` of ``rows`` by group, with the exact distinct
    counts of ``cols`` among ``others`` (their rows that count: columns
    masked to NULL in the rest), in the given column order.  A group without
    values for a column has no count: NULL, like every other aggregate of
    that column."""

    def ordered(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{n}`") for n in order])

    if not cols:
        return ordered(rows.groupBy(*keys).agg(*aggs))
    counted = [*aggs, *set_counts(rows.schema, cols, prefix)]
    large = large_groups(rows, keys)
    if large is None:
        return ordered(rows.groupBy(*keys).agg(*counted))
    is_large = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__large_{k}")) for k in keys])
    small = rows.join(large, is_large, "left_anti").groupBy(*keys).agg(*counted)
    counts = distinct_counts(others.join(large, is_large, "left_semi"), keys, cols, prefix)
    counts = counts.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    rest = rows.join(large, is_large, "left_semi").groupBy(*keys).agg(*aggs).join(counts, same, "left")
    return ordered(small).unionAll(ordered(rest))


def typed_aggregate(
    df: DataFrame,
    keys: list[str],
    type_aggs: list[tuple[tuple[type, ...], dict[str, AggFn]]] | None = None,
    exclude: Iterable[str] = (),
    prefix: str = "",
    nunique: str = "exact",
) -> DataFrame:
    """One row per group: ``elements_count`` plus ``<column>_<agg>`` columns.

    Aggregates that have no value are NULL, matching the "omitted" results
    of the source format; a column without any value in the group has all
    its aggregates omitted (counts included), so an empty group has only
    ``elements_count``.
    """
    if type_aggs is None:
        type_aggs = default_type_aggs(nunique)
    skip = set(keys) | set(exclude)
    df = flattened(df, skip)
    exact = _exact_columns(df.schema, skip, type_aggs)
    plain = _without_exact(type_aggs)
    exprs = aggregate_exprs(df.schema, exclude=skip, type_aggs=plain, prefix=prefix)
    aggs = [F.count(F.lit(1)).alias(prefix + "elements_count"), *exprs]
    order = [*keys, prefix + "elements_count"] + [
        n for n, _ in aggregate_specs(df.schema, exclude=skip, type_aggs=type_aggs, prefix=prefix)
    ]
    return _with_exact_nunique(df, df, keys, aggs, exact, prefix, order)


def _without_exact(type_aggs):
    return [(types, {k: v for k, v in aggs.items() if v is not exact_nunique}) for types, aggs in type_aggs]


def typed_aggregate_long(wide: DataFrame, keys: list[str], entity: str) -> DataFrame:
    """Long form (keys, entity, field, agg, value DOUBLE) of a wide result.

    Timestamps become epoch milliseconds and booleans 0/1 so that one value
    column holds every aggregate.  NULL aggregates are dropped (omitted).
    """
    value_cols = [c for c in wide.columns if c not in keys]
    casted = []
    for f in wide.schema.fields:
        if f.name not in value_cols:
            continue
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.unix_millis(col.cast("timestamp"))
        casted.append(col.cast("double").alias(f.name))
    values = [F.col(f"`{c}`") for c in value_cols]
    long = wide.select(*keys, *casted).unpivot([F.col(k) for k in keys], values, "name", "value").where(F.col("value").isNotNull())
    split_at = F.regexp_extract("name", r"^(.*)_(min|max|sum|mean|nunique|count_zeroes|count_not_null|any|all)$", 1)
    agg = F.regexp_extract("name", r"^(.*)_(min|max|sum|mean|nunique|count_zeroes|count_not_null|any|all)$", 2)
    return long.select(
        *keys,
        F.lit(entity).alias("entity"),
        F.when(F.col("name") == "elements_count", F.lit("elements_count")).otherwise(split_at).alias("field"),
        F.when(F.col("name") == "elements_count", F.lit("count")).otherwise(agg).alias("agg"),
        "value",
    )


def executor_aggregate(
    executors: DataFrame, keys: list[str], order_col: str | None = None, nunique: str = "exact"
) -> DataFrame:
    """Executors split into the driver (one struct; with several, the last
    one by ``order_col``, default ``addTime``, wins, ties broken by the other
    atomic columns in schema order) and typed aggregates over the other
    executors, prefixed ``executors_``.

    Done in a single aggregation: every non-driver aggregate reads its column
    masked to NULL on driver rows, so executors are shuffled once.
    """
    is_driver = F.col("id") == F.lit("driver")
    payload = [c for c in executors.columns if c not in keys]
    atomic = [
        f.name
        for f in executors.schema.fields
        if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))
    ]
    order = F.struct(F.col(order_col or "addTime"), *[F.col(f"`{c}`") for c in atomic])
    split = executors.select(
        "*",
        F.when(is_driver, F.struct(*[F.col(f"`{c}`") for c in payload])).alias("__driver"),
        F.when(is_driver, order).alias("__driver_order"),
        is_driver.alias("__is_driver"),
    )
    own = {"__driver", "__driver_order", "__is_driver"}
    flat = flattened(split, own)
    skip = set(keys) | {"id"} | own
    masked = flat.select(*keys, *own, *[F.when(~F.col("__is_driver"), F.col(f"`{c}`")).alias(c)
                                        for c in flat.columns if c not in keys and c not in own])
    type_aggs = default_type_aggs(nunique)
    names = [n for n, _ in aggregate_specs(flat.schema, exclude=skip, type_aggs=type_aggs, prefix="executors_")]
    aggs = [
        F.count_if(~F.col("__is_driver")).alias("executors_elements_count"),
        *aggregate_exprs(flat.schema, exclude=skip, type_aggs=_without_exact(type_aggs), prefix="executors_"),
        F.max_by("__driver", "__driver_order").alias("driver"),
    ]
    exact = _exact_columns(flat.schema, skip, type_aggs)
    others = flat.where(~F.col("__is_driver"))
    return _with_exact_nunique(masked, others, keys, aggs, exact, "executors_", [*keys, "executors_elements_count", *names, "driver"])


def concat_first_seen(df: DataFrame, keys: list[str], col: str, position: Column, separator: str = "|") -> DataFrame:
    """A9 in first-seen order: the unique values of a column joined in the
    order of their smallest position (values at one position by themselves).
    Repeated values are reduced to one row each before a group's values meet,
    so a group is held only as what it returns."""
    first = df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).cast("string").alias("__value")).agg(F.min(position).alias("__at"))
    text = F.expr(f"listagg(__value, '{separator}') within group (order by __at, __value)")
    return first.groupBy(*keys).agg(text.alias(f"{col}_concat_unique"))
