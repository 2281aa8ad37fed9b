"""Scalar column functions (all Column -> Column, built-in expressions only)."""

from runlens.functions.dates import (  # noqa: F401
    from_millis,
    info_date_str,
    millis_between,
    parse_date,
    parse_gmt,
    parse_info_date,
    to_gmt_string,
    to_millis,
)
from runlens.functions.text import (  # noqa: F401
    get_path,
    input_path,
    parse_cmd_args,
    redact,
    remove_blanks,
    url_host,
    values_match,
    version_int,
)
from runlens.functions.units import (  # noqa: F401
    bytes_to_gb,
    cast_number,
    cast_value,
    hdfs_blocks,
    is_float,
    is_int,
    parse_bytes,
    parse_bytes_kib,
    parse_bytes_mib,
    parse_ms,
    parse_percentage,
    sizeof_fmt,
    strip_all,
    to_bool,
)
