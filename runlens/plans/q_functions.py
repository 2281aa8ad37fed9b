"""Queries: scalar column functions (F1-F22) over derived texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens import functions as fn
from runlens.constants import SIZE_UNITS, TIME_UNITS
from runlens.plans import views as V
from runlens.plans.catalog import register
from runlens.plans.oracle_views import r4, sql_cast_number, sql_strip, sql_suffix_parse


def _t(spark, sf_dir):
    return V.texts_v(spark, sf_dir)


@register("fn_from_millis", "SELECT id, ms_value, make_timestamp(ms_value * 1000) AS ts FROM texts_v")
def fn_from_millis(spark, sf_dir):
    """epoch milliseconds -> UTC timestamp."""
    return _t(spark, sf_dir).select("id", "ms_value", fn.from_millis("ms_value").alias("ts"))


@register(
    "fn_to_millis",
    "SELECT id, CAST(round_even(epoch_us(ts_value) / 1000.0, 0) AS BIGINT) AS ms_rounded, "
    "epoch_us(ts_value) // 1000 AS ms_floor FROM texts_v",
)
def fn_to_millis(spark, sf_dir):
    """timestamp -> epoch ms, rounded half to even, and floored."""
    t = _t(spark, sf_dir)
    return t.select("id", fn.to_millis("ts_value").alias("ms_rounded"), fn.to_millis("ts_value", False).alias("ms_floor"))


_DATE_SQL = """coalesce(
  try_strptime(date_text, '%d-%m-%Y %H:%M:%S %z')::TIMESTAMP,
  try_strptime(date_text, '%Y-%m-%d %H:%M:%S %z')::TIMESTAMP,
  try_strptime(date_text, '%d-%m-%Y %H:%M:%S'),
  try_strptime(date_text, '%Y-%m-%d %H:%M:%S'))"""


@register("fn_parse_date", f"SELECT id, date_text, {_DATE_SQL} AS parsed FROM texts_v")
def fn_parse_date(spark, sf_dir):
    """first matching of four run-date formats (with/without zone) -> UTC."""
    return _t(spark, sf_dir).select("id", "date_text", fn.parse_date("date_text").alias("parsed"))


@register(
    "fn_is_number",
    "SELECT id, num_text, regexp_full_match(num_text, '[-+]?[0-9]+') AS is_int, "
    "regexp_full_match(num_text, '[+-]?[0-9]+(\\.[0-9]+)?') AS is_float, "
    "regexp_full_match(num_text, '[+-]?[0-9](>?\\.[0-9]+)?') AS is_float_strict FROM texts_v",
)
def fn_is_number(spark, sf_dir):
    """integer / decimal text checks (default and strict source form)."""
    return _t(spark, sf_dir).select(
        "id", "num_text", fn.is_int("num_text").alias("is_int"), fn.is_float("num_text").alias("is_float"),
        fn.is_float("num_text", strict=True).alias("is_float_strict"),
    )


@register(
    "fn_cast_number",
    f"SELECT id, num_text, {r4(sql_cast_number('num_text'))} AS num FROM texts_v",
)
def fn_cast_number(spark, sf_dir):
    """integer text, else decimal text, as a number; else NULL."""
    return _t(spark, sf_dir).select("id", "num_text", fn.cast_number("num_text").alias("num"))


@register(
    "fn_cast_value",
    f"SELECT id, {r4(sql_cast_number('num_text'))} AS value_num, num_text AS value_str FROM texts_v",
)
def fn_cast_value(spark, sf_dir):
    """number or the text itself (struct of both, flattened)."""
    v = fn.cast_value("num_text")
    return _t(spark, sf_dir).select("id", v["num"].alias("value_num"), v["str"].alias("value_str"))


@register(
    "fn_percentage",
    f"SELECT id, pct_text, {r4(f'CASE WHEN suffix(pct_text, {chr(39)} %{chr(39)}) THEN TRY_CAST({sql_strip('left(pct_text, length(pct_text) - 2)')} AS DOUBLE) / 100.0 END')} AS ratio FROM texts_v",
)
def fn_percentage(spark, sf_dir):
    """'110.01 %' -> 1.1001."""
    return _t(spark, sf_dir).select("id", "pct_text", fn.parse_percentage("pct_text").alias("ratio"))


_ARGS_SQL = """list_transform(list_filter(string_split(cmd_text, '--'), lambda p: p <> ''),
    lambda p: {'k': string_split(trim(p, ' '), ' ')[1],
               'v': array_to_string(string_split(trim(p, ' '), ' ')[2:], ' '),
               'vc': ' ' || array_to_string(string_split(trim(p, ' '), ' ')[2:], '')})"""


def _arg_sql(name: str, field: str = "v") -> str:
    return f"(list_filter(args, lambda e: e.k = '{name}'))[-1].{field}"


@register(
    "fn_cmd_args",
    f"""SELECT id, CAST(len(list_distinct(list_transform(args, lambda e: e.k))) AS INTEGER) AS n_args,
  {_arg_sql('dataset-name')} AS dataset_name, {_arg_sql('report-date')} AS report_date,
  {_arg_sql('num-partitions')} AS num_partitions, {_arg_sql('mode')} AS mode,
  {_arg_sql('mode', 'vc')} AS mode_compat
FROM (SELECT id, {_ARGS_SQL} AS args FROM texts_v)""",
)
def fn_cmd_args(spark, sf_dir):
    """F8: '--key value words' command line -> map (flattened to the keys used)."""
    t = _t(spark, sf_dir)
    m = fn.parse_cmd_args("cmd_text")
    mc = fn.parse_cmd_args("cmd_text", compat=True)
    return t.select(
        "id", F.size(m).alias("n_args"), m["dataset-name"].alias("dataset_name"), m["report-date"].alias("report_date"),
        m["num-partitions"].alias("num_partitions"), m["mode"].alias("mode"), mc["mode"].alias("mode_compat"),
    )


@register("fn_blocks", "SELECT id, byte_value, CAST(ceil(byte_value / 134217728.0) AS BIGINT) AS blocks FROM texts_v")
def fn_blocks(spark, sf_dir):
    """128 MiB blocks needed for a byte count."""
    return _t(spark, sf_dir).select("id", "byte_value", fn.hdfs_blocks("byte_value").alias("blocks"))


@register(
    "fn_parse_bytes",
    f"""SELECT id, size_text, {r4(sql_suffix_parse('size_text', SIZE_UNITS, 1))} AS bytes,
  {r4(sql_suffix_parse('size_text', SIZE_UNITS, 1048576))} AS bytes_mib_default,
  {r4(sql_suffix_parse('size_text', SIZE_UNITS, 1024))} AS bytes_kib_default
FROM texts_v""",
)
def fn_parse_bytes(spark, sf_dir):
    """size text with unit suffix -> bytes (byte, MiB and KiB defaults)."""
    return _t(spark, sf_dir).select(
        "id", "size_text", fn.parse_bytes("size_text").alias("bytes"),
        fn.parse_bytes_mib("size_text").alias("bytes_mib_default"),
        fn.parse_bytes_kib("size_text").alias("bytes_kib_default"),
    )


@register(
    "fn_parse_ms",
    f"SELECT id, time_text, {r4(sql_suffix_parse('time_text', TIME_UNITS, 1000))} AS ms FROM texts_v",
)
def fn_parse_ms(spark, sf_dir):
    """duration text with unit suffix -> ms (seconds default)."""
    return _t(spark, sf_dir).select("id", "time_text", fn.parse_ms("time_text").alias("ms"))


def _sizeof_sql(x: str) -> str:
    parts = []
    for i, p in enumerate(["", "k", "M", "G", "T"]):
        parts.append(f"WHEN abs({x} / {float(1024 ** i)}) < 1024.0 THEN printf('%3.1f{p}B', {x} / {float(1024 ** i)})")
    return f"CASE {' '.join(parts)} ELSE printf('%.1fPB', {x} / {float(1024 ** 5)}) END"


@register("fn_sizeof", f"SELECT id, byte_value, {_sizeof_sql('CAST(byte_value AS DOUBLE)')} AS human FROM texts_v")
def fn_sizeof(spark, sf_dir):
    """human readable size."""
    return _t(spark, sf_dir).select("id", "byte_value", fn.sizeof_fmt("byte_value").alias("human"))


@register("fn_bytes_gb", f"SELECT id, {r4('byte_value / 1073741824.0')} AS gb FROM texts_v")
def fn_bytes_gb(spark, sf_dir):
    """bytes -> GiB."""
    return _t(spark, sf_dir).select("id", fn.bytes_to_gb("byte_value").alias("gb"))


@register(
    "fn_bool",
    "SELECT id, bool_text, CASE WHEN lower(bool_text) IN ('true','1','y','yes') THEN true "
    "WHEN lower(bool_text) IN ('false','0','n','no') THEN false END AS flag FROM texts_v",
)
def fn_bool(spark, sf_dir):
    """true/1/y/yes and false/0/n/no (any case), else NULL."""
    return _t(spark, sf_dir).select("id", "bool_text", fn.to_bool("bool_text").alias("flag"))


@register(
    "fn_get_path",
    "SELECT id, json_extract_string(json_text, '$.a.b') AS a_b, json_extract_string(json_text, '$.k') AS k, "
    "json_extract_string(json_text, '$.a.b.c') AS a_b_c FROM texts_v",
)
def fn_get_path(spark, sf_dir):
    """null-safe path lookup in a document."""
    t = _t(spark, sf_dir)
    return t.select(
        "id", fn.get_path("json_text", ["a", "b"]).alias("a_b"), fn.get_path("json_text", ["k"]).alias("k"),
        fn.get_path("json_text", ["a", "b", "c"]).alias("a_b_c"),
    )


@register(
    "fn_info_date",
    "SELECT id, info_date_text, coalesce(try_strptime(info_date_text, '%d-%m-%Y'), "
    "try_strptime(info_date_text, '%Y-%m-%d')) + INTERVAL 12 HOUR AS info_date, "
    "'str:' || info_date_text AS info_date_str FROM texts_v",
)
def fn_info_date(spark, sf_dir):
    """Information date at noon UTC, and its 'str:' text form."""
    t = _t(spark, sf_dir)
    return t.select(
        "id", "info_date_text", fn.parse_info_date("info_date_text").alias("info_date"),
        fn.info_date_str("info_date_text").alias("info_date_str"),
    )


@register(
    "fn_to_gmt",
    "SELECT id, strftime(ts_value, '%Y-%m-%dT%H:%M:%S.%gGMT') AS gmt, "
    "strptime(strftime(ts_value, '%Y-%m-%dT%H:%M:%S.%gGMT'), '%Y-%m-%dT%H:%M:%S.%gGMT') AS parsed FROM texts_v",
)
def fn_to_gmt(spark, sf_dir):
    """Timestamp -> GMT text, and the text parsed back."""
    t = _t(spark, sf_dir).select("id", fn.to_gmt_string("ts_value").alias("gmt"))
    return t.select("id", "gmt", fn.parse_gmt("gmt").alias("parsed"))


@register(
    "fn_url_host",
    "SELECT id, url, regexp_extract(url, '^[a-z]+://([^/:]+)', 1) AS host FROM texts_v",
)
def fn_url_host(spark, sf_dir):
    """host part of a URL."""
    return _t(spark, sf_dir).select("id", "url", fn.url_host("url").alias("host"))


@register(
    "fn_input_path",
    "SELECT id, '/data/ds_' || CAST(id % 97 AS VARCHAR) || '/' || replace(info_date_text, '-', '/') || '/v' "
    "|| CAST(id % 3 + 1 AS VARCHAR) AS path FROM texts_v",
)
def fn_input_path(spark, sf_dir):
    """Partition path dir/yyyy/mm/dd/vN."""
    t = _t(spark, sf_dir)
    base = F.concat(F.lit("/data/ds_"), (F.col("id") % 97).cast("string"))
    return t.select("id", fn.input_path(base, "info_date_text", F.col("id") % 3 + 1).alias("path"))


@register("fn_info_date_str", "SELECT id, 'str:' || info_date_text AS info_date_str FROM texts_v")
def fn_info_date_str(spark, sf_dir):
    """information date kept as text with the 'str:' prefix."""
    return _t(spark, sf_dir).select("id", fn.info_date_str("info_date_text").alias("info_date_str"))
