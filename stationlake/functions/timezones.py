"""Local wall-clock time <-> UTC with explicit handling of DST edges.

Timestamps are ``timestamp_ntz``: a local wall-clock value in, the UTC
wall-clock value out. With the session zone at UTC (``session.SQL_CONF``) the
codegen'd ``from_utc_timestamp`` does the zone arithmetic; under any other
session zone ``convert_timezone`` (zone-independent, slower) is used instead,
so results never depend on the session zone.
"""

from __future__ import annotations

import datetime as dt
import zoneinfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..schemas import LOCAL_ZONE


def _day() -> Column:
    return F.expr("INTERVAL '1' DAY")


def _session_is_utc() -> bool:
    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Z", "+00:00", "Etc/UTC")


def localize(
    local: Column,
    tz: str = LOCAL_ZONE,
    ambiguous_null: bool = True,
    nonexistent_null: bool = True,
) -> Column:
    """Interpret ``local`` as wall-clock time in ``tz``; return UTC.

    The offsets in force one day before and one day after give two candidate
    instants. Equal offsets (almost every value): the candidate is the
    answer. Otherwise a candidate is valid when it maps back to ``local``. No
    valid candidate: the time falls in a gap (non-existent). Two different
    valid candidates: the time is repeated (ambiguous). Either case is NULL
    by default; otherwise the earlier instant is kept for ambiguous times and
    the forward shift for gaps. Assumes at most one offset change within a
    day either side, which holds for civil time zones.
    """
    if _session_is_utc():
        x = local.cast("timestamp")

        def to_local(u: Column) -> Column:
            return F.from_utc_timestamp(u, tz)

        shifted = F.to_utc_timestamp(x, tz)
    else:
        x = local

        def to_local(u: Column) -> Column:
            return F.convert_timezone(F.lit("UTC"), F.lit(tz), u)

        shifted = F.convert_timezone(F.lit(tz), F.lit("UTC"), x)

    day = _day()
    off_before = to_local(x - day) - (x - day)
    off_after = to_local(x + day) - (x + day)
    before = x - off_before
    after = x - off_after
    ok_before = to_local(before) == x
    ok_after = to_local(after) == x
    ambiguous = ok_before & ok_after & (before != after)
    missing = ~ok_before & ~ok_after
    edge = F.when(ok_before & ok_after, F.least(before, after)).when(ok_before, before).when(ok_after, after)
    if ambiguous_null:
        edge = F.when(ambiguous, F.lit(None)).otherwise(edge)
    edge = F.when(missing, F.lit(None) if nonexistent_null else shifted).otherwise(edge)
    value = F.when(x.isNull(), F.lit(None)).when(off_before == off_after, before).otherwise(edge)
    return value.cast("timestamp_ntz")


def local_year(local: Column) -> Column:
    """Calendar year of the local date, as text (the storage partition)."""
    return F.date_format(local, "yyyy")


def obs_date(utc: Column, tz: str = LOCAL_ZONE) -> Column:
    """The local calendar day of a UTC time: the day that was observed. The UTC
    time of a local midnight belongs to the day before, and at a month's edge to
    the month before."""
    if _session_is_utc():
        return F.to_date(F.from_utc_timestamp(utc.cast("timestamp"), tz).cast("timestamp_ntz"))
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), utc.cast("timestamp_ntz")))


def utc_of_local_day(day: dt.date, tz: str = LOCAL_ZONE) -> dt.datetime:
    """UTC wall-clock time at which a local day begins (at the end of a gap, if midnight is in one)."""
    local = dt.datetime.combine(day, dt.time(), zoneinfo.ZoneInfo(tz))
    return local.astimezone(dt.timezone.utc).replace(tzinfo=None)


def year_month(ts: Column) -> Column:
    """``yyyy-MM`` text, the monthly partition value."""
    return F.date_format(ts, "yyyy-MM")
