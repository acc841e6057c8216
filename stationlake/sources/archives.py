"""Zip archives: one row per member, routed by name.

The only place where Python runs on executors: ``mapInPandas`` opens each
archive (one binary row) and emits its members. Archives are read one at a
time inside a task; member bodies are not cut.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MEASUREMENT_FILE_TOKEN, METADATA_FILE_TOKEN

MEMBER_SCHEMA = "archive string, member string, body binary"


def _members(batches: Iterator[pd.DataFrame], token: str = "") -> Iterator[pd.DataFrame]:
    for batch in batches:
        for archive, content in zip(batch["archive"], batch["content"]):
            rows = {"archive": [], "member": [], "body": []}
            with zipfile.ZipFile(io.BytesIO(content)) as zf:
                for info in zf.infolist():
                    if info.is_dir() or token not in info.filename:
                        continue
                    rows["archive"].append(archive)
                    rows["member"].append(info.filename)
                    rows["body"].append(zf.read(info))
            if rows["member"]:
                yield pd.DataFrame(rows)


def explode_archives(
    archives: DataFrame, name: str = "archive", content: str = "content", token: str = ""
) -> DataFrame:
    """(archive name, zip bytes) rows -> (archive, member, body) rows. Only
    members whose name holds ``token`` are unpacked."""
    src = archives.select(F.col(name).alias("archive"), F.col(content).alias("content"))
    return src.mapInPandas(lambda batches: _members(batches, token), MEMBER_SCHEMA)


def read_archives(spark: SparkSession, path: str, glob: str = "*.zip", token: str = "") -> DataFrame:
    """Zip files under ``path`` -> (archive, member, body). Keep single
    archives well below ``spark.sql.sources.binaryFile.maxLength``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return explode_archives(files.select(F.col("path").alias("archive"), "content"), token=token)


def route(member: Column, data_token: str = MEASUREMENT_FILE_TOKEN, meta_token: str = METADATA_FILE_TOKEN) -> Column:
    """'tables' for data members, 'metadata' for metadata members except
    ``.html`` ones (they are removed from the metadata folder), else NULL."""
    base = F.regexp_extract(member, r"([^/]*)$", 1)
    return (
        F.when(F.contains(member, F.lit(data_token)), F.lit("tables"))
        .when(
            F.contains(member, F.lit(meta_token)) & ~F.lower(base).endswith(".html"),
            F.lit("metadata"),
        )
    )


def route_members(members: DataFrame) -> DataFrame:
    """Members with their route; members without a route are dropped, as
    the unzip step extracts only the two kinds."""
    return members.withColumn("route", route(F.col("member"))).filter(F.col("route").isNotNull())


def member_lines(members: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Members -> (file, line) rows (file = archive!member), the shape the
    header-bound reader takes. CRLF is normalised; the whole body is used."""
    text = F.regexp_replace(F.decode(F.col("body"), encoding), "\r\n?", "\n")
    return members.select(
        F.concat_ws("!", F.col("archive"), F.col("member")).alias("file"),
        F.explode(F.split(F.regexp_replace(text, "\n\\z", ""), "\n", -1)).alias("line"),
    )
