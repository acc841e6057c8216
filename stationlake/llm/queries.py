"""The corpus operators as queries over the driver's tables, with DuckDB SQL
where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm import (
    alignment,
    bpe,
    decontaminate,
    filter_audit,
    fingerprint,
    html_diff,
    line_dedup,
    line_rules,
    ngram_join,
    pii,
    quality,
    sharding,
    warc,
)
from stationlake.llm._common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated three-line windows cut from all ``documents``; digest of what is left."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.char_length("text").cast("long").alias("kept_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


OP1_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos
  FROM documents WHERE text IS NOT NULL
), wins AS (
  SELECT doc_id, pos, line AS l0,
         lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, pos) AS nth
  FROM wins WHERE l2 IS NOT NULL AND regexp_matches(l0 || l1 || l2, '[^ \\t\\n\\x0B\\f\\r]')
), gone AS (
  SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM ranked WHERE nth > 1
), cut AS (
  SELECT doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
         coalesce(string_agg(CASE WHEN g.pos IS NULL THEN line END, chr(10) ORDER BY l.pos), '') AS text
  FROM lines l LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       length(cut.text) AS kept_chars, sha256(cut.text) AS kept_sha256
FROM documents d LEFT JOIN cut USING (doc_id)
"""


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` over 8 shards by rendezvous hashing, and over 9."""
    return sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), 8)


def op7_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled sketches of all ``documents`` and of their edited texts."""
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-word windows of ``benchmark`` found in all ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), 13, keep=["doc_id"])
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


OP8_SQL = """
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), bp AS (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS p FROM bw WHERE len(w) > 0
), grams AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, w[p:p + least(13, len(w)) - 1] AS g FROM bp
), lens AS (SELECT DISTINCT len(g) AS k FROM grams),
wins AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dw, lens WHERE len(w) >= k
), hits AS (
  SELECT doc_id, p, k, item FROM wins JOIN grams ON wins.w[p:p + k - 1] = grams.g
), pos AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all ``documents`` whose 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 90)


def word_vocabulary() -> str:
    """Path of the public word-level BPE vocabulary; ``STATIONLAKE_WORD_BPE`` names another."""
    return public_vocabulary("word_bpe_49k.json", "STATIONLAKE_WORD_BPE")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` encoded with a public BPE vocabulary and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode(docs, word_vocabulary(), ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as web archives, read back and assembled to captures."""
    captures = warc.archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    digest = F.coalesce("response.payload_digest", "response.digest")
    return captures.select(
        F.col("metadata.page_id").alias("page_id"),
        F.coalesce("response.payload_bytes", "metadata.payload_bytes").alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("original.page_id").alias("refers_to"),
    )


OP6_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op5_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all ``pages`` by structure and nearest-URL differencing."""
    return html_diff.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all ``documents``, learned from ``labels.quality`` outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and credentials in all ``documents``."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in pii.PATTERNS],
        F.sha2(pii.as_string(base).cast("binary"), 256).alias("base_sha256"),
        pii.as_string(F.col("spans")).alias("spans"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all ``documents``, audited in all 120 orders per language."""
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d
), f AS (
  SELECT doc_id, part, concat(
    CASE WHEN len(words) < 100 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN doc_id > first THEN 'E' ELSE '' END) AS fails
  FROM w
), m AS (
  SELECT part, fails, count(*) AS n,
         count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS good,
         count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS toxic
  FROM f GROUP BY ALL
), k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (
  SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM k a, k b, k c, k d, k e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
), g AS (
  SELECT part, fails, n, good, toxic, filter_order,
         CASE WHEN fails = '' THEN 6
              ELSE list_min(list_transform(string_split(fails, ''), lambda x: strpos(filter_order, x))) END AS gone
  FROM m, o
), s AS (SELECT DISTINCT part, filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM m, o),
r AS (
  SELECT s.part, s.filter_order, s.step, substr(s.filter_order, s.step, 1) AS filter,
         sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
         sum(n) FILTER (gone < step AND contains(fails, substr(s.filter_order, s.step, 1))) AS redundant,
         sum(n) FILTER (fails = substr(s.filter_order, s.step, 1)) AS unique_fails,
         sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
  FROM s JOIN g USING (part, filter_order) GROUP BY ALL
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, filter), 0) AS BIGINT) AS shapley
FROM r
"""


def public_vocabulary(name: str, variable: str) -> str:
    """Path of a public tokenizer's file; the environment variable names another."""
    named = os.environ.get(variable)
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path(name)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of a byte-level BPE and of a sentencepiece model aligned over all ``documents``."""
    a = public_vocabulary("byte_bpe_50k.json", "STATIONLAKE_BYTE_BPE")
    b = public_vocabulary("piece_bpe_32k.model", "STATIONLAKE_PIECE_BPE")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = alignment.align_documents(docs, a, b, groups=False)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` judged by their own words and by lines that are frequent on their source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    seen = line_rules.judge(docs, ["doc_id"])
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    lost = [F.size("removed").cast("long").alias("n_removed_lines"), F.col("n_lost").alias("n_lost_words")]
    return seen.select(F.col("doc.doc_id").alias("doc_id"), *cols, *lost)


_LOWER = "translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP13_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), p AS (
  SELECT rid, unnest(range(1, len(w) - 6)) AS p, w FROM d WHERE len(w) >= 8
), g AS (SELECT rid, p, array_to_string(w[p:p + 7], ' ') AS g FROM p),
again AS (SELECT rid, p FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
rep AS (
  SELECT rid, count(DISTINCT q) AS n_repeat_words FROM (SELECT rid, unnest(range(p, p + 8)) AS q FROM again) GROUP BY rid
), l AS (
  SELECT rid, host, t, unnest(string_split(t, chr(10))) AS line FROM d
), n AS (
  SELECT rid, host, t, line, regexp_extract_all({_LOWER.format(c="line")}, '[^\\x20\\x09-\\x0D]+') AS lw FROM l
), c AS (
  SELECT rid, host, t, line, array_to_string(lw, ' ') AS norm, len(lw) AS words FROM n WHERE len(lw) > 0
), freq AS (
  SELECT host, norm FROM c GROUP BY host, norm HAVING count(DISTINCT t) > {line_rules.MIN_DOCS}
), hosts AS (SELECT host, count(DISTINCT t) AS n_docs FROM d GROUP BY host),
cut AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT t) AS n FROM c JOIN freq USING (host, norm) GROUP BY host, norm)
  JOIN hosts USING (host) WHERE n * 100 > n_docs * {line_rules.SHARE_PERCENT}
), by_line AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (cut.norm IS NOT NULL) AS n_removed_lines,
         coalesce(sum(words) FILTER (cut.norm IS NOT NULL), 0) AS n_lost_words
  FROM c LEFT JOIN cut USING (host, norm) GROUP BY rid
), r AS (
  SELECT doc_id, len(w) AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_removed_lines, 0) AS n_removed_lines, CAST(coalesce(n_lost_words, 0) AS BIGINT) AS n_lost_words
  FROM d LEFT JOIN by_line USING (rid) LEFT JOIN rep USING (rid)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
       AND n_lost_words * 100 <= n_words * {line_rules.MAX_LOST_PERCENT} AS kept
FROM r
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op3_sharding": op3_sharding,
    "op7_scaled_sketch": op7_scaled_sketch,
    "op8_decontamination": op8_decontamination,
    "op9_ngram_join": op9_ngram_join,
    "op10_bpe": op10_bpe,
    "op6_warc": op6_warc,
    "op5_page_diff": op5_page_diff,
    "op4_quality": op4_quality,
    "op2_pii": op2_pii,
    "op11_filter_audit": op11_filter_audit,
    "op12_alignment": op12_alignment,
    "op13_line_rules": op13_line_rules,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op8_decontamination": OP8_SQL,
    "op6_warc": OP6_SQL,
    "op11_filter_audit": OP11_SQL,
    "op13_line_rules": OP13_SQL,
}

#: Queries that SQL cannot express: the tests (in tests/llm) that compare them with brute force.
BRUTE_FORCE: dict[str, str] = {
    "op2_pii": "test_free.py::test_pii_base_spans",
    "op3_sharding": "test_native.py::test_sharding_brute_force",
    "op4_quality": "test_mended.py::test_word_vectors_brute_force",
    "op5_page_diff": "test_free.py::test_page_text_of_articles",
    "op7_scaled_sketch": "test_native.py::test_fingerprints_brute_force",
    "op9_ngram_join": "test_free.py::test_join_brute_force",
    "op10_bpe": "test_free.py::test_bpe_is_the_library",
    "op12_alignment": "test_rules.py::test_alignment_brute_force",
}
