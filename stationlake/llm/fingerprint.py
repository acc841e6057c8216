"""Threshold-scaled sketches: every shingle hash below a fixed fraction.

A sketch is the sorted set of the 64-bit hashes of a text's word shingles that
fall into the lowest ``fraction`` of the hash range. Its size follows the
text's, so a short text's containment in a very long one can be estimated, and
the sketch of a union is the union of sketches. A text with words but no hash
that low keeps its smallest one, so that only texts without words have an
empty sketch (``merge`` drops such a stand-in again where it can).

Words are runs of non-white-space of the lower-cased text; fewer than ``k``
words are one shingle. NULL is an empty text. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm._common import global_rank

SHINGLE = 5
FRACTION = 1 / 8


def _bound(fraction: float) -> Column:
    if not 0 < fraction < 1:
        raise ValueError("fraction must lie between 0 and 1")
    return F.lit(-(1 << 63) + int(fraction * (1 << 64))).cast("long")


def with_sketch(df: DataFrame, text: Column, name: str, fraction: float = FRACTION, k: int = SHINGLE) -> DataFrame:
    """``df`` plus the sketch of ``text`` as array<bigint> column ``name``."""
    w, h, s, low = (f"_{name}_{x}" for x in ("w", "h", "s", "low"))
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+", -1), "")
    hashes = F.transform(
        F.slice(h, F.lit(1), F.size(h) - (k - 1)),
        lambda x, i: F.xxhash64(x, *[F.get(F.col(h), i + j) for j in range(1, k)]),
    )
    short = F.when(F.size(h) > 0, F.array(F.xxhash64(F.col(h)))).otherwise(F.array().cast("array<bigint>"))
    some = F.when((F.size(low) == 0) & (F.size(s) > 0), F.array(F.array_min(s))).otherwise(F.col(low))
    return (
        df.withColumn(w, words)
        .withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
        .withColumn(s, F.when(F.size(h) >= k, hashes).otherwise(short))
        .withColumn(low, F.filter(s, lambda x: x < _bound(fraction)))
        .withColumn(name, F.array_sort(F.array_distinct(some)))
        .drop(w, h, s, low)
    )


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Sketch of the union of two shingle sets."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda h: h < _bound(fraction))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; two empty sketches are equal (1.0)."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; 1.0 for an empty ``a``."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_string(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next_head(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its sketch, beside the next document's sketch and head.

    The order is ascending doc_id (then text hash), the first follows the
    last; rows equal in both are one place in it. Adds ``head``, the next
    text's first floor(n_chars / 4) code points, and ``next_sketch``. Order
    and neighbours come from ids and lengths alone; whole texts with their
    sketches are shuffled once (one exchange serves both joins), heads once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))
    rows = with_sketch(rows, F.col("text"), "sketch", fraction)
    places = rows.select("doc_id", "th", F.char_length("text").alias("n"))
    places = places.groupBy("doc_id", "th").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    ranked, total = global_rank(places, ["doc_id", "th"], "document-order")
    prev = ranked.select(
        F.pmod(F.col("rank") + 1, F.lit(max(total, 1))).alias("rank"),
        F.col("doc_id").alias("prev_id"),
        F.col("th").alias("prev_th"),
        F.col("n").alias("prev_n"),
    )
    links = ranked.select("rank", "doc_id", "th").join(prev, "rank").drop("rank")
    same = links["doc_id"].eqNullSafe(rows["doc_id"]) & (links["th"] == rows["th"])
    heads = rows.join(links, same).select(
        "prev_id",
        "prev_th",
        F.substring("text", F.lit(1), F.floor(F.col("prev_n") / 4).cast("int")).alias("head"),
        F.col("sketch").alias("next_sketch"),
    )
    if ranked.agg(F.max("copies")).first()[0] not in (None, 1):
        heads = heads.dropDuplicates(["prev_id", "prev_th"])
    follows = heads["prev_id"].eqNullSafe(rows["doc_id"]) & (heads["prev_th"] == rows["th"])
    return rows.join(heads, follows).select("doc_id", "text", "sketch", "head", "next_sketch")


def edited_fingerprints(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Fingerprint of every text and of its edited text (its last quarter
    replaced by the next document's head), and their likeness."""
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    rows = with_next_head(docs, fraction)
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - quarter), F.col("head")))
    rows = with_sketch(rows, F.col("edited"), "edited_sketch", fraction)
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"),
        as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_in_text"),
    )
