"""Durable record of the files that are stored, by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .links import new_files


class Ledger:
    """Files (by name) that a batch has stored, as a Parquet table by batch id.

    ``record`` comes after the batch's rows are written. It replaces the batch's
    own partition and no other, so a batch that is tried again, for whatever
    reason, lists nothing twice; one that failed before it was recorded is still
    pending as a whole.
    """

    SCHEMA = T.StructType([T.StructField("href", T.StringType()), T.StructField("batch", T.LongType())])

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        # The empty table, so that there is something to read before the first batch.
        spark.createDataFrame([], self.SCHEMA).write.mode("append").parquet(path)

    def entries(self) -> DataFrame:
        """(href, batch) of all recorded files."""
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def stored(self) -> DataFrame:
        """Names of the recorded files, each once."""
        return self.entries().select("href").distinct()

    def pending(self, links: DataFrame, on: str = "href") -> DataFrame:
        """The links whose file no batch has recorded."""
        return new_files(links, self.stored().withColumnRenamed("href", on), on)

    def record(self, files: DataFrame, batch: int, on: str = "href") -> None:
        """Record the distinct names in ``files`` as stored by ``batch``.

        Names that an earlier batch has recorded stay with it; NULL is no name.
        """
        earlier = self.entries().where(F.col("batch") != batch).select("href")
        names = files.select(F.col(on).alias("href")).where(F.col(on).isNotNull()).distinct()
        new = names.join(earlier, "href", "left_anti").withColumn("batch", F.lit(batch).cast("long"))
        writer = new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch").parquet(self.path)
