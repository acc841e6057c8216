"""Repeated three-line windows, removed everywhere but at their first place.

Each run of three consecutive lines is hashed to 128 bits. Windows that occur
more than once keep their first occurrence (by doc_id, then text hash, then
line); later ones mark their three lines, and the union of marked lines goes.
Built-in functions only.

Lines end at ``\\n`` and are compared exactly. Texts of fewer than three lines
are untouched unless ``short`` is set, which makes such a text one window.
Windows of white space only are never touched; a NULL text stays NULL. A
text whose lines all go becomes empty. Rows repeated with one doc_id and text
count as one document, so a repetition removes nothing. Other columns of
``docs`` pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = 3


def _windows(docs: DataFrame, size: int, short: bool) -> DataFrame:
    lines = F.split(F.col("text"), "\n", -1)
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), lines.alias("lines"))
    rows = rows.where(F.size("lines") >= (1 if short else size))
    last = F.size("lines") - (size - 1)
    last = F.greatest(last, F.lit(1)) if short else last
    at = rows.select("id", "th", "lines", F.explode(F.sequence(F.lit(1), last)).alias("pos"))
    at = at.select("id", "th", "pos", F.slice("lines", F.col("pos"), size).alias("win"))
    at = at.where(F.concat_ws("", "win").rlike(r"\S"))
    # Two chained hashes that start from different constants.
    return at.select(
        F.xxhash64(F.lit(1), "win").alias("k1"), F.xxhash64(F.lit(2), "win").alias("k2"), F.struct("id", "th", "pos").alias("at")
    )


def repeated_lines(docs: DataFrame, size: int = LINES, short: bool = False) -> DataFrame:
    """``id, th`` (text hash) and ``starts``: the windows of a document that
    occurred before. Grouping combines map-side, so a hot window is one row a
    task; the join back is a plain equi-join that adaptive execution may split."""
    windows = _windows(docs, size, short)
    firsts = windows.groupBy("k1", "k2").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    firsts = firsts.where(F.col("first") != F.col("last")).drop("last")
    later = windows.join(firsts, ["k1", "k2"]).where(F.col("at") > F.col("first"))
    return later.groupBy(F.col("at.id").alias("id"), F.col("at.th").alias("th")).agg(
        F.collect_set("at.pos").alias("starts")
    )


def _kept(lines: Column, starts: Column, size: int) -> Column:
    gone = F.flatten(F.transform(starts, lambda s: F.sequence(s, s + (size - 1))))
    keep = F.array_except(F.sequence(F.lit(1), F.size(lines)), gone)
    return F.transform(keep, lambda i: F.element_at(lines, i))


def dedup_lines(docs: DataFrame, size: int = LINES, short: bool = False) -> DataFrame:
    """``docs`` with repeated lines cut from ``text``, plus ``n_lines`` and ``n_removed``.

    Columns of those names in ``docs`` are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    marks = repeated_lines(docs, size, short)
    joined = docs.alias("d").join(
        marks.alias("m"),
        F.col("d.doc_id").eqNullSafe(F.col("m.id")) & (F.xxhash64(F.col("d.text")) == F.col("m.th")),
        "left",
    )
    lines = F.split(F.col("d.text"), "\n", -1)
    starts = F.col("m.starts")
    kept = F.when(starts.isNotNull(), _kept(lines, starts, size))
    out = joined.select(F.struct("d.*").alias("d"), F.size(lines).alias("all"), kept.alias("kept"))
    n_lines = F.when(F.col("d.text").isNull(), 0).otherwise(F.col("all")).cast("long")
    n_removed = F.when(F.col("kept").isNull(), 0).otherwise(F.col("all") - F.size("kept")).cast("long")
    text = F.when(F.col("kept").isNull(), F.col("d.text")).otherwise(F.array_join("kept", "\n"))
    cols = [text.alias(c) if c == "text" else F.col("d").getField(c).alias(c) for c in docs.columns]
    return out.select(*cols, n_lines.alias("n_lines"), n_removed.alias("n_removed"))
