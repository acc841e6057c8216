"""Consumer queries: grouped and global maxima, distinct values, top-k,
and time-range slices that prune storage partitions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timezones import utc_of_local_day
from ..schemas import LOCAL_ZONE


def group_max(df: DataFrame, keys: Sequence[Column | str], value: str, alias: str) -> DataFrame:
    """max(value) per group (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.max(value).alias(alias))


def global_max(df: DataFrame, value: str, alias: str) -> DataFrame:
    return df.agg(F.max(value).alias(alias))


def distinct_values(df: DataFrame, expr: Column, alias: str) -> DataFrame:
    return df.select(expr.alias(alias)).distinct()


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows under ``order`` (TakeOrderedAndProject: each task
    keeps its own k, the driver merges k per task)."""
    return df.orderBy(*order).limit(k)


def time_slice(
    df: DataFrame,
    ts: str,
    start: dt.datetime | str,
    end: dt.datetime | str,
    partition_col: str | None = None,
    partition_format: str = "%Y-%m",
) -> DataFrame:
    """Rows with ``start <= ts < end``.

    When the table is stored partitioned by a text month (or year) derived
    from ``ts``, the same bounds are added on that column: Spark does not
    derive them from a predicate on ``ts`` alone, and without them every
    partition would be listed and opened.
    """
    start = _as_datetime(start)
    end = _as_datetime(end)
    cond = (F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end))
    if partition_col:
        last = end - dt.timedelta(microseconds=1)
        cond = (
            (F.col(partition_col) >= F.lit(start.strftime(partition_format)))
            & (F.col(partition_col) <= F.lit(last.strftime(partition_format)))
            & cond
        )
    return df.filter(cond)


def local_day_slice(
    df: DataFrame,
    ts: str,
    first: dt.date | str,
    last: dt.date | str,
    tz: str = LOCAL_ZONE,
    partition_col: str | None = None,
) -> DataFrame:
    """Rows whose local day is from ``first`` to ``last``, both included, where
    ``ts`` is UTC. The bounds are the UTC times at which the days begin, so the
    months that are opened are those of UTC: a slice from the first of a month
    opens the month before too."""
    first, last = (dt.date.fromisoformat(d) if isinstance(d, str) else d for d in (first, last))
    after = last + dt.timedelta(days=1)
    return time_slice(df, ts, utc_of_local_day(first, tz), utc_of_local_day(after, tz), partition_col)


def _as_datetime(v: dt.datetime | str) -> dt.datetime:
    return v if isinstance(v, dt.datetime) else dt.datetime.fromisoformat(v)
