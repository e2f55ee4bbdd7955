"""Scalar column expressions (all built-in Spark, no Python UDFs)."""

from medallion.functions.exprs import (  # noqa: F401
    EPOCH_FLOOR,
    col_of,
    concat_skip_null,
    display_name,
    file_stamp,
    hour_of,
    instant,
    iso_dow,
    iso_text,
    key_text,
    locality_name,
    quote,
    text_date,
    trim_spaces,
    wall_clock,
)
