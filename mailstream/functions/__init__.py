"""Scalar column functions (all JVM-side expressions, no Python UDFs)."""

from mailstream.functions.text import (  # noqa: F401
    blank_to_null, java_concat, java_hash, java_space_split, lines_of,
    parse_int, pmod_partition, printf_json, xml_escape,
)
from mailstream.functions.time import (  # noqa: F401
    iso_minute, iso_second, lagged_window, minute_floor, minute_start,
    instant_to_ntz,
)
