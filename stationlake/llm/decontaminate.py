"""Benchmark decontamination with a broadcast set of test n-grams.

The benchmark's windows of ``n`` consecutive words (an item with fewer words
is one window) form a hash set. Every window of every document probes the
set; a hit is verified word by word. Built-in functions only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered.
NULL and empty texts have no words and are never contaminated. Repeated rows
are judged one by one. An empty benchmark flags nothing; an item without
words has no window. Columns of ``docs`` keep their names: all working
columns live beside a struct of the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm._common import ascii_lower
from stationlake.session import materialize_counted

# What stands between words, once A-Z are lowered (fixed by the contract).
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The set is broadcast up to this many windows and bytes; a larger one is
# joined by a shuffle on the same hash.
MAX_BROADCAST_WINDOWS = 1_000_000
MAX_BROADCAST_BYTES = 256 << 20


def words_of(text: Column) -> Column:
    # Splitting is several times faster than extracting with the negated class.
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1), "")


def window_hash(hashes: Column, pos: Column, size: int) -> Column:
    """Hash of ``size`` word hashes from ``pos`` (from 1) on; NULL beyond the end."""
    inside = pos + (size - 1) <= F.size(hashes)
    return F.when(inside, F.xxhash64(*[F.get(hashes, pos + (j - 1)) for j in range(size)]))


def benchmark_windows(benchmark: DataFrame, n: int = 13) -> DataFrame:
    """Distinct windows: ``gram`` (words), ``gram_len``, ``gram_hash``, ``items``."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("k", F.least(F.lit(n), F.size("w")))
    at = items.select("item", "w", "k", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("p"))
    grams = at.select("item", F.slice("w", F.col("p"), F.col("k")).alias("gram"))
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).select(
        "gram",
        F.size("gram").alias("gram_len"),
        F.xxhash64(F.transform("gram", lambda x: F.xxhash64(x))).alias("gram_hash"),
        "items",
    )


def covered(spans: Column) -> Column:
    """Number of positions in the union of [pos, pos + len) spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(s: Column, h: Column) -> Column:
        end = F.greatest(s["end"], h["pos"] + h["len"])
        return F.struct(end.alias("end"), (s["n"] + (end - F.greatest(s["end"], h["pos"])).cast("long")).alias("n"))

    return F.aggregate(F.array_sort(spans), start, step, lambda s: s["n"])


def scan(
    docs: DataFrame, benchmark: DataFrame, n: int = 13, keep: Sequence[str] | None = None, text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: ``doc`` (struct of its columns, or of ``keep``), ``n_words``,
    ``spans`` (array of pos, len over words, from 1), ``n_hit``, ``items``.

    The document goes along once, on the extra position 0 that every row has;
    only that and the hits reach the one shuffle.
    """
    grams, seen = materialize_counted(
        benchmark_windows(benchmark, n),
        "benchmark-windows",
        bytes=F.coalesce(F.sum(F.octet_length(F.concat_ws(" ", "gram")) + F.octet_length(F.concat_ws(" ", "items"))), F.lit(0)),
    )
    lens = sorted({n, *(r[0] for r in grams.select("gram_len").distinct().collect())})  # n values at most
    small = seen["rows"] <= MAX_BROADCAST_WINDOWS and seen["bytes"] <= MAX_BROADCAST_BYTES

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("doc"),
        F.monotonically_increasing_id().alias("rid"),
        words_of(F.col(text)).alias("w"),
    )
    rows = rows.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    at = rows.select("doc", "rid", "w", "h", F.explode(F.sequence(F.lit(0), F.size("w"))).alias("pos"))
    if len(lens) > 1:
        at = at.select("*", F.explode(F.array(*[F.lit(k) for k in lens])).alias("len"))
        at = at.where((F.col("pos") > 0) | (F.col("len") == n))
    else:
        at = at.withColumn("len", F.lit(n))
    key = F.when(F.col("pos") == 0, F.lit(None).cast("long"))
    for k in lens:
        key = key.when(F.col("len") == k, window_hash(F.col("h"), F.col("pos"), k))
    words = F.slice("w", F.greatest(F.col("pos"), F.lit(1)), F.col("len"))
    at = at.select(
        "rid",
        "pos",
        "len",
        F.when(F.col("pos") == 0, F.col("doc")).alias("doc"),
        F.when(F.col("pos") == 0, F.size("w")).alias("n_words"),
        key.alias("key"),
        "w" if small else words.alias("words"),  # a shuffled row carries its own window only
    )
    same = (F.col("key") == F.col("gram_hash")) & (F.col("len") == F.col("gram_len"))
    hits = at.join(F.broadcast(grams) if small else grams, same, "left")
    # Verified after the join: as a join key, every window would be built, not only the matches.
    verified = (words if small else F.col("words")) == F.col("gram")
    hits = hits.where((F.col("pos") == 0) | verified)
    per_row = hits.groupBy("rid").agg(
        F.first("doc", ignorenulls=True).alias("doc"),
        F.max("n_words").cast("long").alias("n_words"),
        F.collect_list(F.when(F.col("pos") > 0, F.struct("pos", "len"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return per_row.select("doc", "n_words", "spans", covered(F.col("spans")).alias("n_hit"), "items")


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one hit word, and hit words are 5 % of all words or more."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns unchanged.

    Equal texts are judged alike, so only text hashes (128 bits) go through the
    scan's exchange, and the few contaminated ones come back to the rows."""
    keys = [F.xxhash64(F.lit(i), "text").alias(f"k{i}") for i in (1, 2)]
    seen = scan(docs.select(*keys, "text"), benchmark, n, keep=["k1", "k2"])
    bad = seen.where(contaminated(F.col("n_hit"), F.col("n_words"))).select("doc.k1", "doc.k2").distinct()
    bad, found = materialize_counted(bad, "contaminated-texts")
    bad = F.broadcast(bad) if found["rows"] <= MAX_BROADCAST_WINDOWS else bad
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    same = [F.xxhash64(F.lit(i), "doc.text") == F.col(f"k{i}") for i in (1, 2)]
    kept = rows.join(bad, same[0] & same[1], "left_anti")
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """``docs`` with the hit words cut out of ``text`` of contaminated rows.

    Everything that is not a hit word stays, separators included; other rows
    come back unchanged.
    """
    seen = scan(docs, benchmark, n)
    text = F.col("doc").getField("text")
    hit = F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1)))
    seen = seen.select("doc", "n_words", "n_hit", F.array_distinct(hit).alias("hit"))
    any_case = GAP.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    # A leading gap before the first word keeps gaps and words in step: word i follows gap i.
    pieces = F.split(F.concat(F.lit("\n"), text), any_case, -1)
    parts = F.array_remove(pieces, "")
    gaps = F.regexp_extract_all(F.concat(F.lit("\n"), text, F.lit("\n")), F.lit(any_case), F.lit(0))
    joined = F.transform(
        parts, lambda w, i: F.concat(F.get(gaps, i), F.when(F.array_contains("hit", i + 1), F.lit("")).otherwise(w))
    )
    cut = F.concat(F.array_join(joined, ""), F.get(gaps, F.size(parts)))
    cut = cut.substr(F.lit(2), F.char_length(cut) - 2)
    bad = contaminated(F.col("n_hit"), F.col("n_words"))
    return seen.select(
        *[
            (F.when(bad, cut).otherwise(text) if c == "text" else F.col("doc").getField(c)).alias(c)
            for c in docs.columns
        ]
    )
