"""Keep one row per key (row_number() = 1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(
    df: DataFrame, keys: Sequence[str], first: Sequence[tuple[str, bool]] = ()
) -> list[Column]:
    """``first`` as (column, descending) pairs, then every other non-key
    column ascending.

    The source ranks duplicates without an order, so any row may win. A total
    order makes the winner deterministic (and testable against another
    engine) while staying one of the outcomes the source allows.
    """
    named = set(keys) | {name for name, _ in first}
    head = [F.col(n).desc_nulls_last() if desc else F.col(n).asc_nulls_first() for n, desc in first]
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in named]
    return [*head, *rest]


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    drop_null_keys: bool = True,
) -> DataFrame:
    """One row per ``keys``: the first under ``order``.

    Plan: Spark places a partial ``WindowGroupLimit`` before the shuffle, so
    each map task forwards at most one row per key. A key holding a third of
    the input therefore costs one row per map task in the exchange, not a
    third of the data in one task.
    """
    if drop_null_keys:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        df = df.filter(cond)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
