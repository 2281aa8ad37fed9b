"""Scalar functions: literal inputs -> values computed by hand from the
behaviour of the source format's parsers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from runlens import functions as fn


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text,expected",
    [("512m", 536870912.0), ("10.5g", 11274289152.0), ("1kib", None), ("1KB ", 1024.0), ("7", 7.0), ("abc", None),
     ("2 t", None), ("2t", 2.0 * 1024 ** 4), ("3P", 3.0 * 1024 ** 5), ("5b", 5.0), (" 4 ", 4.0)],
)
def test_parse_bytes(spark, text, expected):
    assert one(spark, fn.parse_bytes(F.col("x")), text) == expected


def test_parse_bytes_defaults_and_strict(spark):
    assert one(spark, fn.parse_bytes_mib(F.col("x")), "-1") == -1048576.0
    assert one(spark, fn.parse_bytes_kib(F.col("x")), "4") == 4096.0
    # the source's own float check takes one digit before the point only
    assert one(spark, fn.parse_bytes(F.col("x"), strict=True), "10.5g") is None
    assert one(spark, fn.parse_bytes(F.col("x"), strict=True), "1.5k") == 1536.0


@pytest.mark.parametrize(
    "text,expected",
    [("10min", 600000.0), ("5us", None), ("10", 10000.0), ("250ms", 250.0), ("2h", 7200000.0), ("1d", 86400000.0),
     ("3m", 180000.0), ("1.5s", 1500.0)],
)
def test_parse_ms(spark, text, expected):
    assert one(spark, fn.parse_ms(F.col("x")), text) == expected


@pytest.mark.parametrize("text,expected", [("110.01 %", 1.1001), ("50", None), ("x %", None), ("0 %", 0.0)])
def test_parse_percentage(spark, text, expected):
    got = one(spark, fn.parse_percentage(F.col("x")), text)
    assert (got is None and expected is None) or abs(got - expected) < 1e-12


@pytest.mark.parametrize("text,expected", [("Yes", True), ("N", False), ("1", True), ("0", False), ("maybe", None)])
def test_to_bool(spark, text, expected):
    assert one(spark, fn.to_bool(F.col("x")), text) is expected


@pytest.mark.parametrize(
    "text,is_int,is_float,num",
    [("+3", True, True, 3.0), ("3.0", False, True, 3.0), ("1e5", False, False, None),
     ("99999999999999999999", True, True, None), ("3.", False, False, None), ("-12", True, True, -12.0)],
)
def test_numbers(spark, text, is_int, is_float, num):
    assert one(spark, fn.is_int(F.col("x")), text) is is_int
    assert one(spark, fn.is_float(F.col("x")), text) is is_float
    assert one(spark, fn.cast_number(F.col("x")), text) == num


def test_cast_value(spark):
    r = one(spark, fn.cast_value(F.col("x")), "42")
    assert r["num"] == 42.0 and r["str"] == "42"
    r = one(spark, fn.cast_value(F.col("x")), "abc")
    assert r["num"] is None and r["str"] == "abc"


def test_cmd_args(spark):
    m = one(spark, fn.parse_cmd_args(F.col("x")), "--a 1 --b x y --a 2")
    assert m == {"a": "2", "b": "x y"}
    m = one(spark, fn.parse_cmd_args(F.col("x"), compat=True), "--a 1 --b x y")
    assert m == {"a": " 1", "b": " xy"}


def test_redact(spark):
    m = one(spark, fn.redact(fn.parse_cmd_args(F.col("x")), ["report-date"], "redacted"), "--report-date 2020 --k v")
    assert m == {"report-date": "redacted", "k": "v"}


@pytest.mark.parametrize(
    "value,expected",
    [(1536, "1.5kB"), (0, "0.0B"), (3 * 1024 ** 5, "3.0PB"), (int(95.25 * 1024 ** 3), "95.2GB"), (1023, "1023.0B")],
)
def test_sizeof(spark, value, expected):
    assert one(spark, fn.sizeof_fmt(F.col("x")), value, "x long") == expected


@pytest.mark.parametrize("value,expected", [(134217728, 1), (134217729, 2), (0, 0)])
def test_blocks(spark, value, expected):
    assert one(spark, fn.hdfs_blocks(F.col("x")), value, "x long") == expected


def test_bytes_to_gb(spark):
    assert one(spark, fn.bytes_to_gb(F.col("x")), 3 * 1024 ** 3, "x long") == 3.0


def test_parse_date(spark):
    utc = lambda *a: dt.datetime(*a)  # noqa: E731 (session zone is UTC; collected as naive)
    assert one(spark, fn.parse_date(F.col("x")), "15-01-2020 10:00:00 +0200") == utc(2020, 1, 15, 8, 0)
    assert one(spark, fn.parse_date(F.col("x")), "2020-01-15 10:00:00 -01:30") == utc(2020, 1, 15, 11, 30)
    assert one(spark, fn.parse_date(F.col("x")), "2020-01-15 10:00:00") == utc(2020, 1, 15, 10, 0)
    assert one(spark, fn.parse_date(F.col("x"), "Europe/Prague"), "15-01-2020 10:00:00") == utc(2020, 1, 15, 9, 0)
    assert one(spark, fn.parse_date(F.col("x")), "5-1-2020 7:3:9") == utc(2020, 1, 5, 7, 3, 9)
    assert one(spark, fn.parse_date(F.col("x")), "garbage") is None


def test_info_date(spark):
    assert one(spark, fn.parse_info_date(F.col("x")), "15-01-2020") == dt.datetime(2020, 1, 15, 12)
    assert one(spark, fn.parse_info_date(F.col("x")), "2020-01-15") == dt.datetime(2020, 1, 15, 12)
    assert one(spark, fn.parse_info_date(F.col("x")), "2020/01/15") is None
    assert one(spark, fn.info_date_str(F.col("x")), "2020-01-15") == "str:2020-01-15"


def test_gmt_round_trip(spark):
    t = one(spark, fn.parse_gmt(F.col("x")), "2020-01-15T14:59:33.707GMT")
    assert t == dt.datetime(2020, 1, 15, 14, 59, 33, 707000)
    assert one(spark, fn.to_gmt_string(F.col("x")), t, "x timestamp") == "2020-01-15T14:59:33.707GMT"
    assert one(spark, fn.parse_gmt(F.col("x")), "2020-01-15 14:59:33") is None


def test_millis(spark):
    assert one(spark, fn.from_millis(F.col("x")), 1579100373707, "x long") == dt.datetime(2020, 1, 15, 14, 59, 33, 707000)
    half = dt.datetime(2020, 1, 1, 0, 0, 0, 500)
    odd_half = dt.datetime(2020, 1, 1, 0, 0, 0, 1500)
    base = 1577836800000
    assert one(spark, fn.to_millis(F.col("x")), half, "x timestamp") == base  # half to even
    assert one(spark, fn.to_millis(F.col("x")), odd_half, "x timestamp") == base + 2
    assert one(spark, fn.to_millis(F.col("x"), rounded=False), odd_half, "x timestamp") == base + 1


def test_text_helpers(spark):
    assert one(spark, fn.url_host(F.col("x")), "http://hist-1.example.org:18080/api") == "hist-1.example.org"
    assert one(spark, fn.input_path(F.lit("dir"), F.col("x"), F.lit(3)), "2020-01-15") == "dir/2020/01/15/v3"
    assert one(spark, fn.remove_blanks(F.col("x")), " Stage 1 ") == "Stage1"
    assert one(spark, fn.get_path(F.col("x"), ["a", "b"]), '{"a": {"b": 7}}') == "7"
    assert one(spark, fn.get_path(F.col("x"), ["a", "c"]), '{"a": {"b": 7}}') is None
    assert one(spark, fn.version_int(F.col("x")), "12") == 12
    assert one(spark, fn.version_int(F.col("x")), "v2") is None


def test_parse_date_tries_formats_by_shape(spark):
    texts = ["15-01-2020 10:00:00 +0200", "15-01-2020 10:00:00 +02:00", "15-01-2020 10:00:00 Z", "2020-01-15 10:00:00 z",
             "2020-01-15 10:00:00 -0130", "2020-01-15 10:00:00", "0015-01-2020 1:1:1", "-2020-1-1 0:0:0", "15-01-+12020 1:1:1",
             "+12020-1-15 1:1:1", "2020-1-00015 1:1:1", "15-01-020 1:1:1", "2020-01-15", "n/a", "", " ", "sometime else now",
             "2020-01-15  10:00:00", "15-01-2020 10:00:00 ", "31-02-2020 1:1:1", "15-01-2020 10:00:00 GMT+2", None]
    x = F.col("x")
    zoned = [F.try_to_timestamp(x, F.lit(f)) for f in ("d-M-yyyy H:m:s Z", "d-M-yyyy H:m:s XXX", "yyyy-M-d H:m:s Z", "yyyy-M-d H:m:s XXX")]
    local = [F.try_to_timestamp(x, F.lit(f)) for f in ("d-M-yyyy H:m:s", "yyyy-M-d H:m:s")]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    both = df.select("x", F.unix_micros(fn.parse_date(x)).alias("got"), F.unix_micros(F.coalesce(*zoned, *local)).alias("all"))
    assert [(r["x"], r["got"]) for r in both.collect()] == [(r["x"], r["all"]) for r in both.collect()]
    assert both.where("got is not null").count() >= 8
    # every format is guarded: none is tried on a text of another shape
    plan = both.select("got")._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce(CASE WHEN" in plan
