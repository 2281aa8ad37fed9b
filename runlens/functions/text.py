"""Text helpers: command lines, paths, URLs, versions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_cmd_args(col: Column | str, compat: bool = False) -> Column:
    """'--a 1 --b x y' -> map {a: '1', b: 'x y'} (a later duplicate wins).

    Each '--' starts a key; the words after it form the value.  With
    ``compat=True`` the words are glued without blanks and the value gets a
    leading blank, the way the source store expects it.
    """
    parts = F.filter(F.split(_c(col), "--"), lambda p: p != F.lit(""))

    def entry(p: Column) -> Column:
        words = F.split(F.trim(p), " ")
        rest = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
        value = F.concat(F.lit(" "), F.array_join(rest, "")) if compat else F.array_join(rest, " ")
        return F.struct(F.element_at(words, 1).alias("key"), value.alias("value"))

    return F.map_from_entries(F.transform(parts, entry))


def redact(map_col: Column | str, keys: list[str], marker: str) -> Column:
    """Replace the values of the listed keys of a map by ``marker``."""
    return F.transform_values(
        _c(map_col), lambda k, v: F.when(k.isin(*keys), F.lit(marker)).otherwise(v)
    )


def get_path(col: Column | str, path: list[str]) -> Column:
    """Null-safe path into a JSON text column: missing steps give NULL."""
    json_path = "$" + "".join(f"['{step}']" for step in path)
    return F.get_json_object(_c(col), json_path)


def url_host(col: Column | str) -> Column:
    return F.parse_url(_c(col), F.lit("HOST"))


def input_path(base: Column | str, info_date: Column | str, info_version: Column | str) -> Column:
    """'dir', '2020-01-15', 3 -> 'dir/2020/01/15/v3'."""
    return F.concat(
        _c(base), F.lit("/"), F.replace(_c(info_date), F.lit("-"), F.lit("/")), F.lit("/v"), _c(info_version).cast("string")
    )


def remove_blanks(col: Column | str) -> Column:
    return F.replace(_c(col), F.lit(" "), F.lit(""))


def version_int(col: Column | str) -> Column:
    """Version text made of digits only -> BIGINT, else NULL (the text is kept
    elsewhere, also where it has more than 18 digits)."""
    c = _c(col)
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def values_match(left: Column | str, right: Column | str) -> Column:
    """Equality where two NULLs match."""
    return _c(left).eqNullSafe(_c(right))
