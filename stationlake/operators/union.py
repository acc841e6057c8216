"""Union of the data categories (recent / historical) by column name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_categories(parts: Mapping[str, DataFrame], column: str = "category") -> DataFrame:
    """Stack the parts by name, each tagged with its category; a column
    missing from one part is NULL there."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(column, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
