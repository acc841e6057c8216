"""Good rows and rejects, split in one write."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_counted


class Quarantine(NamedTuple):
    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]  # rows, rejects


def quarantine(df: DataFrame, name: str, evidence: Sequence[str], reason: str = "reason", keep: Sequence[str] = ()) -> Quarantine:
    """Split ``df`` by whether ``reason`` is NULL.

    One pass writes both to the shared folder, each in a folder of its own, and
    counts them while it writes; nothing is judged twice and nothing is lost:
    every row of ``df`` is in one of the two. ``rejects`` has the ``evidence``
    columns, ``rows`` all others and those of ``keep``.
    """
    parted = df.withColumn("__rejected", F.col(reason).isNotNull())
    both, seen = materialize_counted(parted, name, ["__rejected"], rejects=F.count_if(F.col("__rejected")))
    good = [c for c in df.columns if c not in evidence or c in keep]
    return Quarantine(
        both.filter(~F.col("__rejected")).select(*[F.col(f"`{c}`") for c in good]),
        both.filter("__rejected").select(*[F.col(f"`{c}`") for c in evidence]),
        {"rows": seen["rows"] - seen["rejects"], "rejects": seen["rejects"]},
    )
