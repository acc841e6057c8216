"""Documents to tokens: quality, repeated lines, near copies, contamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes every stage to the
shared folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from stationlake.llm._common import table
from stationlake.llm.queries import word_vocabulary
from stationlake.session import configure, materialize

#: Near copies: shingles of five words, Jaccard similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network does not reject."""
    configure(spark)  # the library's session settings, for stages that are called one by one
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line windows go everywhere but at their first place; n_chars follows the text."""
    # What dedup_lines adds must not replace a column of docs.
    others = [c for c in docs.columns if c != "text"]
    out = line_dedup.dedup_lines(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in others]).alias("doc")))
    values = {c: F.col("doc").getField(c) for c in others} | {"text": F.col("text")}
    if "n_chars" in values:
        values["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(values["n_chars"])
    return out.select(*[values[c].alias(c) for c in docs.columns])


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_one(docs, SHINGLE, PERCENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the digest of their decoded text."""
    out = bpe.encode(docs.select("doc_id", "text"), word_vocabulary())
    return out.drop("text")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_copies", near_copy_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

#: The classifier and the tokenizer have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None
BRUTE_FORCE = "test_free.py::test_pipeline_stages"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
