"""Connected components of a link table, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.session import materialize, materialize_counted


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reached) for every node of ``links`` (a, b).

    Each round takes the smallest label among the neighbours (combined
    map-side, so a hub is one row a task) and then the label's own label, until
    nothing changes. Rounds are written to the shared folder, which cuts the
    lineage.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.where("a != b").distinct(), "edges")
    label = materialize(
        edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels"
    )
    while True:
        near = edges.join(label.select(F.col("node").alias("b"), F.col("component").alias("c")), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        low = label.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "c").alias("mid"))
        up = label.select(F.col("node").alias("mid"), F.col("component").alias("top"))
        step = low.join(up, "mid").select("node", "old", F.least("mid", "top").alias("component"))
        moved, seen = materialize_counted(step, "labels", moved=F.sum(F.when(F.col("old") != F.col("component"), 1).otherwise(0)))
        label = moved.select("node", "component")
        if not seen["moved"]:
            return label
