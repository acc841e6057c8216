"""Rendezvous hashing of record keys over weighted shards.

Every record scores each shard with ``-weight / ln(u)``, ``u`` a uniform hash
of (key, shard), and goes to the highest score. A new shard only takes the
records it wins, so about ``w / total`` of them move, all into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm._common import global_rank


def shard_of(keys: Sequence[Column], weights: Sequence[float]) -> Column:
    """Index of the shard for the key columns. Weights must be positive.

    NULL keys hash like any other key (all of them to one shard); equal scores
    go to the lower index.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")

    def score(s: int, w: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(s)), 11)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((F.lit(-float(w)) / F.log(u)).alias("score"), F.lit(-s).alias("neg"))

    best = F.array_max(F.array(*[score(s, w) for s, w in enumerate(weights)])) if len(weights) > 1 else score(0, weights[0])
    return (-best["neg"]).cast("int")


def assign_shards(
    docs: DataFrame, shards: int = 8, weights: Sequence[float] | None = None, grown_weight: float = 1.0
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``slot`` counts the rows of a shard from 0 without gaps, by doc_id, then
    checksum and size. A NULL text has size 1 and checksum 0, as an empty one.
    Repeated rows share a shard and get slots of their own; an empty table
    gives no rows; other columns of ``docs`` are left out.
    """
    weights = list(weights or [1.0] * shards)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + F.lit(1).cast("long")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of([F.col("doc_id")], weights).alias("shard"),
        shard_of([F.col("doc_id")], [*weights, grown_weight]).alias("grown_shard"),
    )
    ranked, _ = global_rank(rows, ["doc_id", "text_crc32", "size"], "shard-slots", group=["shard"])
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("rank").alias("slot"), "grown_shard"
    )
