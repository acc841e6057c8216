"""Parallelism for CPU-heavy per-row work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def spread(df: DataFrame, keys: Sequence[str] = (), min_partitions: int | None = None) -> DataFrame:
    """Spread ``df`` over at least ``min_partitions`` tasks (default: the
    cluster's parallelism) when its scan yields fewer.

    A single large file with one row group is read by one task; per-row
    work on long texts or archives then runs on one core. A large input made
    of many files already has enough splits and is returned unchanged, so
    no shuffle is added where the scan parallelises by itself.

    Only for a table scan with at most projections and filters over it: asking
    a plan with shuffles for its number of partitions would run them.

    ``keys`` must be unique or nearly so (row ids): rows are then hashed on
    them, which is deterministic on retry without the local sort that
    round-robin needs. Without keys the split is round-robin, which no hot
    value can skew.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # sessions without RDD access (Spark Connect)
        return df
    if splits >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)
