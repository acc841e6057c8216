"""Parquet and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(
    spark: SparkSession, path: str, partition_types: dict[str, str] | None = None
) -> DataFrame:
    """Parquet directory with partition discovery. Partition columns are
    cast to the given types (discovery would turn ``year=2023`` into an int
    and keep ``2024-01`` a string)."""
    df = spark.read.parquet(path)
    for name, t in (partition_types or {}).items():
        df = df.withColumn(name, df[name].cast(t))
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with header and an explicit schema: ids stay text (no inference
    turning ``00044`` into 44)."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
