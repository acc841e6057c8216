"""Effective-dated (interval) joins.

``fact.ts`` matches a history row when ``start <= ts`` and (``end`` is NULL or
``ts <= end``), both ends inclusive. Overlapping history rows multiply fact
rows (kept on purpose; the quality job reports them). Fact rows without a
match keep NULL attributes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, materialize_counted
from .sweep import sweep_join

# A broadcast history is copied to every executor. Up to this many rows and
# this size (a station history has a few thousand rows) the copy is cheap;
# beyond it facts and history are merged and swept in time order.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20

# A key of a large history is joined pair by pair, in one task, while it has at most so
# many intervals and facts. Keys beyond either are swept, which cuts them over tasks and
# costs the sort plus the result.
MAX_PAIRED_INTERVALS = 256
MAX_PAIRED_FACTS = 100_000


def has_at_most(df: DataFrame, n: int) -> bool:
    """Proves ``count(df) <= n`` without counting past ``n + 1`` rows."""
    return df.limit(n + 1).count() <= n


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row: 8 per fixed-width value, 48 per string or
    other variable-width value, plus a 16-byte row header."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return 16 + sum(8 if isinstance(f.dataType, fixed) else 48 for f in df.schema.fields)


def row_bytes(df: DataFrame):
    """Bytes of a row as its values have them: 8 per fixed-width value, the
    length of each string, plus a 16-byte row header."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    size = F.lit(16 + 8 * len(df.columns)).cast("long")
    for name in strings:
        size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    return size


def broadcastable(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Row count (proved, never counted past the bound) and estimated size
    are both below the bounds."""
    rows = min(max_rows, max_bytes // row_width(df))
    return has_at_most(df, rows)


def fits_broadcast(
    rows: int, size: int, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether a history of so many rows and bytes is broadcast (else swept)."""
    return rows <= max_rows and size <= max_bytes


def effective_dated_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    start: str,
    end: str,
    how: str = "left",
    dim_key: str | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    materialize_dim: bool = True,
    dim_rows: int | None = None,
    dim_bytes: int | None = None,
) -> DataFrame:
    """Join each fact row to the history rows valid at ``fact[ts]``.

    Small history (row count and bytes checked, ``fits_broadcast``): broadcast
    hash join on ``key`` with the range as residual condition; the fact is not
    shuffled and keeps its order. Large history: both sides are shuffled by key
    (``_large_join``), after which rows are in no order; keys with many intervals or
    facts go through ``sweep_join``. All give the same rows.

    A derived history is first written once to the shared folder
    (``materialize_dim``), its rows counted during that write: the join does
    not recompute it and the size check needs no job. ``dim_rows`` and
    ``dim_bytes`` pass a count and size (``row_bytes``) already known for ``dim``.
    """
    dim_key = dim_key or key
    if materialize_dim:
        dim, metrics = materialize_counted(dim, "history", bytes=F.coalesce(F.sum(row_bytes(dim)), F.lit(0)))
        small = fits_broadcast(metrics["rows"], metrics["bytes"], max_broadcast_rows, max_broadcast_bytes)
    elif dim_rows is not None:
        size = dim_rows * row_width(dim) if dim_bytes is None else dim_bytes
        small = fits_broadcast(dim_rows, size, max_broadcast_rows, max_broadcast_bytes)
    else:
        small = broadcastable(dim, max_broadcast_rows, max_broadcast_bytes)
    if not small:
        return _large_join(fact, dim, key, ts, start, end, how, dim_key)
    return _paired(fact, dim, key, ts, start, end, how, dim_key, F.broadcast)


def _paired(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    start: str,
    end: str,
    how: str,
    dim_key: str,
    hint: Callable[[DataFrame], DataFrame] = lambda d: d,
) -> DataFrame:
    """Equality on the key, the range as residual condition."""
    d = dim.withColumnRenamed(dim_key, "__dk")
    cond = (
        (F.col(key) == F.col("__dk"))
        & (F.col(ts) >= F.col(start))
        & (F.col(end).isNull() | (F.col(ts) <= F.col(end)))
    )
    return fact.join(hint(d), cond, how).drop("__dk")


def _dense_keys(fact: DataFrame, dim: DataFrame, key: str, dim_key: str) -> tuple[DataFrame, int]:
    """Keys with more intervals or facts than are joined in one task, and their
    number. NULL is one of them when as many facts have no key."""

    def above(df: DataFrame, column: str, bound: int) -> DataFrame:
        sizes = df.groupBy(F.col(column).alias("__dense")).agg(F.count(F.lit(1)).alias("__n"))
        return sizes.filter(F.col("__n") > bound).select("__dense")

    many = above(dim.filter(F.col(dim_key).isNotNull()), dim_key, MAX_PAIRED_INTERVALS)
    dense, seen = materialize_counted(many.union(above(fact, key, MAX_PAIRED_FACTS)).distinct(), "dense-keys")
    return dense, seen["rows"]


def _large_join(
    fact: DataFrame, dim: DataFrame, key: str, ts: str, start: str, end: str, how: str, dim_key: str
) -> DataFrame:
    """The join with a history that is not broadcast. The fact is written once
    first: its keys are counted, and a range shuffle of the result samples it."""
    fact = materialize(fact, "fact")
    dense, n = _dense_keys(fact, dim, key, dim_key)
    if not n:
        return _paired(fact, dim, key, ts, start, end, how, dim_key)
    marked = F.broadcast(dense) if n <= MAX_BROADCAST_ROWS else dense

    def split(df: DataFrame, column: str, kind: str) -> DataFrame:
        return df.join(marked, F.col(column).eqNullSafe(F.col("__dense")), kind)

    few = _paired(split(fact, key, "left_anti"), split(dim, dim_key, "left_anti"), key, ts, start, end, how, dim_key)
    many = sweep_join(
        split(fact, key, "left_semi"), split(dim, dim_key, "left_semi"), key, ts, start, end, how, dim_key
    )
    # Written once: what follows may pass over it twice.
    return few.union(materialize(many, "swept"))


# Units tried from coarse to fine, with their length in seconds.
_UNITS = [("year", 365 * 86400), ("month", 30 * 86400), ("day", 86400), ("hour", 3600), ("minute", 60), ("second", 1)]


def choose_bucket(df: DataFrame, ts: str, min_buckets: int = 10_000) -> str:
    """The coarsest time unit that cuts the span of ``ts`` into at least
    ``min_buckets`` buckets (one small aggregate): a key holding a third of
    the rows is then spread over that many cells at least, while the
    across-bucket level keeps few rows per key."""
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    if lo is None:
        return "day"
    span = max((hi - lo).total_seconds(), 1.0)
    for unit, seconds in _UNITS:
        if span / seconds >= min_buckets:
            return unit
    return "second"


def intervals_from_starts(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    touching: bool = False,
    bucket: str = "day",
    extra: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """History rows ``[ts, next ts of the same key)`` from a list of starts.

    ``end`` is one microsecond before the next start (``touching=False``) or
    the next start itself (``touching=True``: boundaries match twice); the
    last interval is open (NULL). Starts at the same instant are ordered by
    ``tiebreak`` so that the result is deterministic.

    The next start is found in two levels so that no key is sorted whole in
    one task: within (key, time bucket) by a window, and across buckets from
    one row per (key, bucket) (its first start), joined back on (key,
    bucket). A hot key is split over its buckets; ``bucket`` should be fine
    enough for the data's time span that one (key, bucket) cell stays small.
    ``bucket="auto"`` picks it from the span (``choose_bucket``).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if bucket == "auto":
        bucket = choose_bucket(df, ts)
    b = df.select(*keys, ts, *extra).withColumn("__b", F.date_trunc(bucket, F.col(ts)))
    inner = Window.partitionBy(*keys, "__b").orderBy(ts, *tiebreak)
    b = b.withColumn("__next", F.lead(ts).over(inner))
    firsts = b.groupBy(*keys, "__b").agg(F.min(ts).alias("__first"))
    across = Window.partitionBy(*keys).orderBy("__b")
    firsts = firsts.select(*keys, "__b", F.lead("__first").over(across).alias("__next_bucket"))
    b = b.join(firsts, [*keys, "__b"], "left")
    nxt = F.coalesce(F.col("__next"), F.col("__next_bucket"))
    end = nxt if touching else nxt - F.expr("INTERVAL '0.000001' SECOND")
    return b.select(*keys, *extra, F.col(ts).alias("start"), end.alias("end"))
