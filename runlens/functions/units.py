"""Numbers, sizes, durations, percentages and booleans parsed from strings.

Every function maps Column -> Column with built-in expressions only, so the
work stays inside whole-stage codegen.  Unparsable input gives NULL (ANSI
mode is on in Spark 4, so ``try_*`` forms are used for every cast and
division).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runlens.constants import GIB, HDFS_BLOCK_BYTES, SIZE_UNITS, SIZEOF_PREFIXES, STRICT_FLOAT_PATTERN, TIME_UNITS

INT_PATTERN = r"^[-+]?[0-9]+$"
FLOAT_PATTERN = r"^[+-]?[0-9]+(\.[0-9]+)?$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_all(col: Column | str) -> Column:
    """Remove leading and trailing white space of any kind (not blanks only)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def is_int(col: Column | str) -> Column:
    return _c(col).rlike(INT_PATTERN)


def is_float(col: Column | str, strict: bool = False) -> Column:
    return _c(col).rlike(STRICT_FLOAT_PATTERN if strict else FLOAT_PATTERN)


def cast_number(col: Column | str, strict: bool = False) -> Column:
    """Integer text, else decimal text, as DOUBLE; anything else NULL."""
    c = _c(col)
    return (
        F.when(is_int(c), c.try_cast("bigint").try_cast("double"))
        .when(is_float(c, strict) & ~c.contains(">"), c.try_cast("double"))
    )


def cast_value(col: Column | str, strict: bool = False) -> Column:
    """Number or the text itself: struct<num DOUBLE, str STRING>.

    ``num`` is set when the text is a number; ``str`` always holds the text.
    """
    c = _c(col)
    return F.struct(cast_number(c, strict).alias("num"), c.alias("str"))


def _suffix_parse(col: Column, units: dict, default_multiplier: int, strict: bool) -> Column:
    text = F.lower(strip_all(col))
    # the first suffix (in table order) the text ends with wins
    mult = None
    number_text = None
    for unit, factor in units.items():
        cond = text.endswith(unit)
        cut = F.substring(text, F.lit(1), F.length(text) - F.lit(len(unit)))
        if mult is None:
            mult, number_text = F.when(cond, F.lit(float(factor))), F.when(cond, cut)
        else:
            mult, number_text = mult.when(cond, F.lit(float(factor))), number_text.when(cond, cut)
    mult = mult.otherwise(F.lit(float(default_multiplier)))
    number_text = number_text.otherwise(text)
    return cast_number(number_text, strict) * mult


def parse_bytes(col: Column | str, default_multiplier: int = 1, strict: bool = False) -> Column:
    """'512m' -> 536870912.0; no suffix multiplies by ``default_multiplier``."""
    return _suffix_parse(_c(col), SIZE_UNITS, default_multiplier, strict)


def parse_bytes_mib(col: Column | str, strict: bool = False) -> Column:
    return parse_bytes(col, 1024 * 1024, strict)


def parse_bytes_kib(col: Column | str, strict: bool = False) -> Column:
    return parse_bytes(col, 1024, strict)


def parse_ms(col: Column | str, default_multiplier: int = 1000, strict: bool = False) -> Column:
    """'10min' -> 600000.0; no suffix means seconds."""
    return _suffix_parse(_c(col), TIME_UNITS, default_multiplier, strict)


def parse_percentage(col: Column | str) -> Column:
    """'110.01 %' -> 1.1001; text not ending in ' %' or not a number -> NULL."""
    c = _c(col)
    body = F.substring(c, F.lit(1), F.length(c) - F.lit(2))
    return F.when(c.endswith(" %"), F.try_divide(strip_all(body).try_cast("double"), F.lit(100.0)))


def to_bool(col: Column | str) -> Column:
    """true/1/y/yes -> true, false/0/n/no -> false (any case), else NULL."""
    low = F.lower(_c(col))
    return (
        F.when(low.isin("true", "1", "y", "yes"), F.lit(True))
        .when(low.isin("false", "0", "n", "no"), F.lit(False))
    )


def hdfs_blocks(col: Column | str) -> Column:
    """Number of 128 MiB blocks needed for a byte count (ceil)."""
    return F.ceil(F.try_divide(_c(col), F.lit(HDFS_BLOCK_BYTES)))


def bytes_to_gb(col: Column | str) -> Column:
    return F.try_divide(_c(col), F.lit(float(GIB)))


def sizeof_fmt(col: Column | str, suffix: str = "B") -> Column:
    """Human readable size: 1536 -> '1.5kB'."""
    x = _c(col).cast("double")
    out = None
    for i, prefix in enumerate(SIZEOF_PREFIXES):
        scaled = x / F.lit(float(1024 ** i))
        cond = F.abs(scaled) < F.lit(1024.0)
        # half-to-even first: Python's %-format rounds the exact binary value,
        # Java's formatter rounds half up
        text = F.format_string("%3.1f%s%s", F.bround(scaled, 1), F.lit(prefix), F.lit(suffix))
        out = F.when(cond, text) if out is None else out.when(cond, text)
    last = x / F.lit(float(1024 ** len(SIZEOF_PREFIXES)))
    return F.when(x.isNotNull(), out.otherwise(F.format_string("%.1f%s%s", F.bround(last, 1), F.lit("P"), F.lit(suffix))))
