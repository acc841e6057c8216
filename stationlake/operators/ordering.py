"""Rows in a total order: gapless positions, and files that keep them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Low bits of a row number that count the rows of one task.
_TASK_BITS = 33


def order_columns(order: Sequence[tuple[str, bool]]) -> list[Column]:
    """(column, descending) pairs; NULLs last when descending, first otherwise."""
    return [F.col(f"`{c}`").desc_nulls_last() if desc else F.col(f"`{c}`").asc_nulls_first() for c, desc in order]


def with_position(df: DataFrame, order: Sequence[tuple[str, bool]], position: str = "position") -> DataFrame:
    """``df`` plus its place (from 1, without gaps) in the order of all rows.

    A window over everything would sort in one task. Here one range shuffle
    sorts, the sorted partitions are written once, and each partition gets the
    number of rows before it: a table of a row per partition, which bounds its
    broadcast. Rows equal in all of ``order`` follow each other in any order,
    and may be cut over partitions however many they are.
    """
    by = [*order_columns(order), F.col("__tie").asc()]
    rows = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    rows = rows.withColumn("__part", F.spark_partition_id())
    rows = rows.withColumn("__nr", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _TASK_BITS) - 1)))
    rows = materialize(rows.drop("__tie"), "ordered")
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")
    offsets = sizes.select("__part", before.alias("__before"))
    out = rows.join(F.broadcast(offsets), "__part").withColumn(position, F.col("__nr") + F.col("__before") + 1)
    return out.drop("__part", "__nr", "__before")


def write_ordered(df: DataFrame, path: str, order: Sequence[tuple[str, bool]], position: str = "position") -> str:
    """Parquet files whose names follow the order and whose rows are sorted; a
    reader that takes the files one after the other gets the whole order."""
    rows = with_position(df, order, position)
    rows.repartitionByRange(position).sortWithinPartitions(position).write.mode("overwrite").parquet(path)
    return path
