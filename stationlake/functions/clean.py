"""Value cleaning: sentinels, casts, ids, dates, column names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DATE_FORMAT, MISSING, STATION_ID_WIDTH, clean_name


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_sentinel(c: Column | str, sentinel=MISSING) -> Column:
    """NULL where the value equals the sentinel.

    A text sentinel is compared with the trimmed raw text, before any cast,
    so it also catches text columns and narrow integer columns (a numeric
    ``-999`` can never reach a cloud-cover string or an unsigned byte).
    """
    c = _col(c)
    if isinstance(sentinel, str):
        t = F.trim(c)
        return F.when(t == F.lit(sentinel), F.lit(None)).otherwise(t)
    return F.nullif(c, F.lit(sentinel))


def strip_spaces(c: Column | str) -> Column:
    """Remove every blank inside the value."""
    return F.replace(_col(c), F.lit(" "), F.lit(""))


def pad_id(c: Column | str, width: int = STATION_ID_WIDTH, fill: str = "0") -> Column:
    """Left-pad to ``width``; longer values stay as they are (lpad would cut)."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def clean_station_id(c: Column | str) -> Column:
    return pad_id(strip_spaces(c))


def parse_yyyymmdd(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """Text date -> local midnight as ``timestamp_ntz``; bad input -> NULL.

    For ``yyyyMMdd`` the text is validated with plain expressions (eight
    digits, month 1-12, day within the month) and the date is built
    arithmetically, so an invalid date costs no parser exception: files with
    many bad dates parse as fast as clean ones. Other formats use
    ``try_to_date``.
    """
    s = F.trim(_col(c))
    if fmt != "yyyyMMdd":
        return F.call_function("try_to_date", s, F.lit(fmt)).cast("timestamp_ntz")
    y = F.substring(s, 1, 4).try_cast("int")
    m = F.substring(s, 5, 2).try_cast("int")
    d = F.substring(s, 7, 2).try_cast("int")
    month_start = F.add_months(F.make_date(y, F.lit(1), F.lit(1)), m - 1)
    valid = (
        s.rlike("^[0-9]{8}$")
        & (y >= 1)
        & m.between(1, 12)
        & (d >= 1)
        & (d <= F.dayofmonth(F.last_day(month_start)))
    )
    return F.when(valid, F.date_add(month_start, d - 1)).cast("timestamp_ntz")


def cast_int_rounded(c: Column | str) -> Column:
    """Float -> int rounding half away from zero (a plain cast truncates)."""
    return F.round(_col(c)).try_cast("int")


def try_cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; values that do not fit become NULL."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})


def clean_column_names(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Spaces removed, lower case, then explicit renames (dotted names)."""
    names = [clean_name(n) for n in df.columns]
    names = [(renames or {}).get(n, n) for n in names]
    return df.toDF(*names)
