"""Column expressions (no actions, no Python on executors)."""

from .clean import (
    cast_int_rounded,
    clean_column_names,
    clean_station_id,
    null_sentinel,
    pad_id,
    parse_yyyymmdd,
    strip_spaces,
    try_cast_columns,
)
from .keys import concat_nullable, decode_codes, surrogate_key, PAYMENT_TYPE_LABELS
from .timezones import localize, local_year, obs_date, utc_of_local_day, year_month

__all__ = [
    "cast_int_rounded",
    "clean_column_names",
    "clean_station_id",
    "null_sentinel",
    "pad_id",
    "parse_yyyymmdd",
    "strip_spaces",
    "try_cast_columns",
    "concat_nullable",
    "decode_codes",
    "surrogate_key",
    "PAYMENT_TYPE_LABELS",
    "localize",
    "local_year",
    "obs_date",
    "utc_of_local_day",
    "year_month",
]
