"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.session import materialize_counted

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays as it is.

    ``lower`` is several times faster and does the same on pure ASCII.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def portions(batch: Any, rows: int = 512) -> Iterator[Any]:
    """A pandas batch in parts of so many rows. Spark bounds a batch's bytes, not
    what a function makes of them: results are built part by part."""
    for at in range(0, len(batch), rows):
        yield batch.iloc[at : at + rows]


def global_rank(
    df: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = ()
) -> tuple[DataFrame, int]:
    """``df`` plus ``rank`` (gapless from 0 within ``group`` by ``order``, nulls
    first), and the number of rows.

    One range shuffle sorts the rows; they are written with their partition
    and place in it, and each (group, partition) run gets the number of rows
    before it. There are at most partitions + groups such runs, which bounds
    the broadcast. Fully equal rows get consecutive ranks in no stated order,
    and are told apart by a row number so that they can be split over tasks.
    """
    keys = [*group, *order]
    by = [F.col(c).asc_nulls_first() for c in keys] + [F.col("_tie").asc()]
    staged = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .drop("_tie")
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_idx", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    rows, seen = materialize_counted(staged, name)
    runs = rows.groupBy(*group, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_idx").alias("_lo"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_pid")) - F.col("_n")
    offsets = runs.select(*group, "_pid", (before - F.col("_lo")).alias("_off"))
    ranked = rows.join(F.broadcast(offsets), [*group, "_pid"]).withColumn("rank", F.col("_idx") + F.col("_off"))
    return ranked.drop("_pid", "_idx", "_off"), seen["rows"]
