"""Quality rules from the frequency of lines across the documents of a host.

Lines are normalised (A-Z lowered, runs of white space one space, trimmed) and
hashed to 128 bits. A line found in more than ``MIN_DOCS`` documents of a host
and in more than ``SHARE_PERCENT`` of them is boilerplate there and removed.
Documents are told apart by text: exact copies and repeated rows count once, so
a text is not boilerplate because it was crawled often. A document that loses
more than ``MAX_LOST_PERCENT`` of its words is depleted and rejected; rules on
the text alone (``measures``) reject others before. Built-in functions only.

Words are ``[^\\x20\\x09-\\x0D]+``. A NULL text is empty: no words, rejected. A
NULL host is a host of its own. Lines without words are never counted or
removed. Rows are judged one by one, so repeated ones get equal verdicts, and a
NULL doc_id changes nothing. An empty table gives no rows. All columns of
``docs`` stay in the struct ``doc``, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm._common import ascii_lower
from stationlake.session import materialize, materialize_counted

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
MIN_DOCS, SHARE_PERCENT, MAX_LOST_PERCENT = 20, 2, 50
#: Up to so many removed lines are broadcast; more are joined by a shuffle.
MAX_BROADCAST_LINES = 500_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _length(text: Column) -> Column:
    return F.char_length(text).cast("long")


def measures(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` plus ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``.

    The last counts the words that lie in windows of eight words found twice or
    more in the text. Hashes only say which texts have no such window; in the
    others equal windows are brought together by a sort that ends with the words
    themselves, so the count is exact and its cost n log n.
    """
    t, w, h, win, runs, at = (f"_{x}" for x in ("t", "w", "h", "win", "runs", "at"))
    lines = F.filter(F.split(F.col(t), "\n", -1), lambda x: F.length(_without(x, SPACES)) > 0)
    df = docs.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn(w, words_of(F.col(t))).withColumn("_lines", lines)
    df = df.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": _length(_without(F.col(t), SPACES)),
            "n_symbols": _length(F.col(t)) - _length(_without(F.col(t), SYMBOLS)),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            h: F.transform(w, lambda x: F.xxhash64(x)),
        }
    ).drop("_lines")
    hashes = F.transform(
        F.slice(h, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(F.col(h), i + j) for j in range(1, WINDOW)]),
    )
    df = df.withColumn(win, hashes)
    placed = F.transform(
        F.col(win),
        lambda x, i: F.struct(x.alias("h"), F.slice(F.col(w), i + 1, WINDOW).alias("words"), i.alias("i")),
    )
    df = df.withColumn(runs, F.when(F.size(F.array_distinct(win)) < F.size(win), F.sort_array(placed)))

    def beside(x: Column, k: Column) -> Column:
        other = F.get(F.col(runs), k)
        return F.coalesce((other["h"] == x["h"]) & (other["words"] == x["words"]), F.lit(False))

    again = F.filter(F.col(runs), lambda x, k: beside(x, k - 1) | beside(x, k + 1))
    df = df.withColumn(at, F.sort_array(F.transform(again, lambda x: x["i"])))
    # Each window covers its words up to the next one's start.
    covers = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(at), k + 1) - p, F.lit(WINDOW))))
    total = F.aggregate(covers, F.lit(0).cast("long"), lambda s, x: s + x)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop(t, w, h, win, runs, at)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEAT_PERCENT)


def _lines(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line, from 1: ``keep``, ``pos``, the hash ``k1, k2`` of the normalised
    line and its ``words`` (0: without words). A NULL text is one line without words."""
    whole = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    # Only runs that are not a single space need replacing.
    plain = F.regexp_replace(whole, r"(?:\x20(?=[\x20\t\x0B\f\r])|[\t\x0B\f\r])[\x20\t\x0B\f\r]*", " ")
    at = df.select(*keep, F.posexplode(F.split(plain, "\n", -1)).alias("_pos", "_line"))
    at = at.select(*keep, (F.col("_pos") + 1).alias("pos"), F.trim("_line").alias("_norm"))
    return at.select(
        *keep,
        "pos",
        # Two hashes that start from different constants.
        F.xxhash64(F.lit(1), "_norm").alias("k1"),
        F.xxhash64(F.lit(2), "_norm").alias("k2"),
        F.when(F.col("_norm") == "", 0)
        .otherwise(F.octet_length("_norm") - F.octet_length(F.replace("_norm", F.lit(" "), F.lit(""))) + 1)
        .cast("long")
        .alias("words"),
    )


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS, share_percent: int = SHARE_PERCENT) -> DataFrame:
    """``host, k1, k2`` of the lines above the limits, from ``host, th`` (text
    hash), ``k1, k2, words`` of all lines. Each text is counted once per host and
    line: made distinct first (no group larger than a text's copies in a task),
    then counted, both combined map-side."""
    each = lines.where("words > 0").select("host", "k1", "k2", "th").distinct()
    found = each.groupBy("host", "k1", "k2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_docs)
    hosts = lines.where("pos = 1").select("host", "th").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"))
    found = found.join(hosts, "host").where(F.col("n") * 100 > F.col("n_docs") * share_percent)
    return found.select("host", "k1", "k2")


def judge(
    docs: DataFrame,
    keep: Sequence[str] | None = None,
    text: str = "text",
    host: str = "source",
    min_docs: int = MIN_DOCS,
    share_percent: int = SHARE_PERCENT,
    max_lost_percent: int = MAX_LOST_PERCENT,
) -> DataFrame:
    """Per row of ``docs``: ``doc`` (struct of its columns, or of ``keep``), the
    ``measures``, ``base_failed``, ``removed`` (positions of removed lines, from
    1), ``n_lost`` (their words) and ``kept``.

    The texts are read once: measures and line hashes are written to the shared
    folder, and both the frequencies and the verdicts come from there.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("doc"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.col(f"`{text}`")).alias("th"),
        F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")).alias("host"),
        F.monotonically_increasing_id().alias("rid"),
    )
    lines = _lines(measures(rows, "text"), "text", "rid", "host", "th", "doc", *counts)
    # A row goes along with its first line only.
    first = [F.when(F.col("pos") == 1, F.col(c)).alias(c) for c in ("doc", *counts)]
    lines = materialize(lines.select("rid", "host", "th", "pos", "k1", "k2", "words", *first), "judged-lines")

    found, seen = materialize_counted(frequent_lines(lines, min_docs, share_percent), "frequent-lines")
    found = found.withColumn("gone", F.lit(True))
    found = F.broadcast(found) if seen["rows"] <= MAX_BROADCAST_LINES else found
    hits = lines.join(found, ["host", "k1", "k2"], "left")
    gone = F.coalesce(F.col("gone"), F.lit(False)) & (F.col("words") > 0)
    out = hits.groupBy("rid").agg(
        F.first("doc", ignorenulls=True).alias("doc"),
        *[F.max(c).alias(c) for c in counts],
        F.sort_array(F.collect_list(F.when(gone, F.col("pos")))).alias("removed"),
        F.sum(F.when(gone, F.col("words")).otherwise(0)).alias("n_lost"),
    )
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    depleted = F.col("n_lost") * 100 > F.col("n_words") * max_lost_percent
    return out.select("doc", *counts, failed.alias("base_failed"), "removed", "n_lost", (~failed & ~depleted).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", **limits: int) -> DataFrame:
    """The kept rows of ``docs`` with their boilerplate lines cut from ``text``; ``limits`` as for ``judge``."""
    seen = judge(docs, None, text, host, **limits).where("kept")
    lines = F.split(F.col("doc").getField(text), "\n", -1)
    left = F.filter(lines, lambda x, i: ~F.array_contains("removed", i + 1))
    cut = F.when(F.size("removed") > 0, F.array_join(left, "\n")).otherwise(F.col("doc").getField(text))
    return seen.select(*[(cut if c == text else F.col("doc").getField(c)).alias(c) for c in docs.columns])
