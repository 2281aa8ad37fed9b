"""Time conversions and multi-format date parsing (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runlens.constants import (
    GMT_FORMAT,
    INFO_DATE_FORMATS,
    RUN_DATE_FORMATS_LOCAL,
    RUN_DATE_FORMATS_ZONED,
    RUN_DATE_FORMATS_ZONED_COLON,
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def from_millis(col: Column | str) -> Column:
    """Epoch milliseconds -> UTC timestamp."""
    return F.timestamp_millis(_c(col))


def to_millis(col: Column | str, rounded: bool = True) -> Column:
    """Timestamp (or NTZ timestamp, read as UTC) -> epoch milliseconds.

    ``rounded`` rounds sub-millisecond parts half to even (as Python's
    ``round`` does); otherwise floors.
    """
    ts = _c(col).cast("timestamp")
    if rounded:
        return F.bround(F.unix_micros(ts) / F.lit(1000.0)).cast("bigint")
    return F.unix_millis(ts)


def millis_between(end: Column | str, start: Column | str) -> Column:
    """end - start in milliseconds (BIGINT), NULL when either is NULL."""
    return F.unix_millis(_c(end).cast("timestamp")) - F.unix_millis(_c(start).cast("timestamp"))


def parse_gmt(col: Column | str) -> Column:
    """'2020-01-15T14:59:33.707GMT' -> timestamp; malformed -> NULL."""
    return F.try_to_timestamp(_c(col), F.lit(GMT_FORMAT))


def to_gmt_string(col: Column | str) -> Column:
    """timestamp -> '2020-01-15T14:59:33.707GMT'."""
    return F.date_format(_c(col), GMT_FORMAT)


def parse_date(col: Column | str, default_tz: str = "UTC") -> Column:
    """First matching run-date format, as a UTC timestamp; NULL if none match.

    Texts with a zone offset ('+0200' or '+02:00') are converted with it; texts
    without one are read in ``default_tz``.
    """
    c = _c(col)
    # a format that does not match costs an exception per text, so each is tried
    # only on texts of its shape: a zone follows a second space, a year has four
    # digits at least, and only offsets with a colon (or 'Z') are of the colon kind
    has_zone = F.substring_index(c, " ", 2) != c
    no_zone = (F.instr(c, " ") > 0) & ~has_zone
    colon = F.instr(F.substring_index(c, " ", -1), ":") > 0
    one_letter = F.length(F.substring_index(c, " ", -1)) == 1
    day_first = F.instr(F.substring(F.substring_index(c, " ", 1), -4, 4), "-") == 0
    year_first = F.instr(F.substring(c, 2, 2 ** 31 - 1), "-") >= 4

    def tried(formats: list[str], shape: Column) -> list[Column]:
        return [F.when(shape & order, F.try_to_timestamp(c, F.lit(fmt))) for fmt, order in zip(formats, (day_first, year_first))]

    zoned = tried(RUN_DATE_FORMATS_ZONED, has_zone & ~colon)
    zoned_colon = tried(RUN_DATE_FORMATS_ZONED_COLON, has_zone & (colon | one_letter))
    local = [F.to_utc_timestamp(t, default_tz) for t in tried(RUN_DATE_FORMATS_LOCAL, no_zone)]
    # day-first then year-first, zoned before local (the order of the formats)
    return F.coalesce(zoned[0], zoned_colon[0], zoned[1], zoned_colon[1], *local)


def parse_info_date(col: Column | str) -> Column:
    """ETL information date ('15-01-2020' or '2020-01-15') at noon UTC."""
    c = _c(col)
    day = F.coalesce(*[F.try_to_timestamp(c, F.lit(fmt)) for fmt in INFO_DATE_FORMATS])
    return day + F.expr("INTERVAL 12 HOURS")


def info_date_str(col: Column | str) -> Column:
    """Prefix an information date with 'str:' so stores keep it as text."""
    return F.concat(F.lit("str:"), _c(col))
