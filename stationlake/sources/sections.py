"""Sectioned text: the table after a marker line, footer line dropped.

A text in a column is cut by expressions (``section_lines``). Files are read line
by line, so a file of any size is many splits: lines get their number in the file
from the split's offset and their place in it, and marker, end and footer are
found as line numbers (``numbered_lines``, ``read_sectioned``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, materialize_counted


def _literal_regex(text: str) -> str:
    # split() takes a Java regex; quote the marker as a literal.
    return "\\Q" + text + "\\E"


def normalize_newlines(text: Column) -> Column:
    """CRLF / CR -> LF, as a text-mode file read does."""
    return F.regexp_replace(text, "\r\n?", "\n")


def section_body(text: Column, marker: str | None) -> Column:
    """Text between the first and second occurrence of ``marker`` (the whole
    text when no marker is given). NULL when the marker is missing."""
    if marker is None:
        return text
    parts = F.split(text, _literal_regex(marker), -1)
    return F.when(F.size(parts) > 1, F.get(parts, 1))


def section_lines(
    df: DataFrame,
    text: str,
    marker: str | None = None,
    drop_last: int = 1,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per line of the section, the last ``drop_last`` lines
    (footer) dropped: (*keep, line_no, line). Rows whose marker is missing
    give no lines. The whole text is processed; nothing is cut."""
    body = section_body(normalize_newlines(F.col(text)), marker)
    # A final newline ends the last line; it does not start an empty one.
    body = F.regexp_replace(body, "\n\\z", "")
    lines = F.split(body, "\n", -1)
    lines = F.slice(lines, 1, F.greatest(F.size(lines) - drop_last, F.lit(0)))
    return df.filter(body.isNotNull()).select(
        *keep, F.posexplode(lines).alias("line_no", "line")
    )


def sectioned_rows(
    files: DataFrame,
    marker: str,
    columns: Sequence[str],
    sep: str = ";",
) -> tuple[DataFrame, DataFrame]:
    """(file, text) rows -> (rows, rejects).

    rows: one row per data line, named ``columns`` by position, with
    ``file``. rejects: files in which the marker was not found, so that a
    bad file is reported instead of failing the job.
    """
    body = section_body(normalize_newlines(F.col("text")), marker)
    rejects = files.filter(body.isNull()).select("file")
    lines = section_lines(files, "text", marker, keep=["file"])
    cells = F.split(F.col("line"), sep, -1)
    rows = lines.select(
        "file",
        *[F.try_element_at(cells, F.lit(i + 1)).alias(c) for i, c in enumerate(columns)],
    )
    return rows, rejects


# Per split and per file tables are broadcast up to this many rows.
MAX_BROADCAST_SPLITS = 200_000


def numbered_lines(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8", glob: str | None = None
) -> DataFrame:
    """(file, nr, line) for every line of every file, ``nr`` from 0 without gaps.

    Files are split like any text. A split is one task's, in order, so a line's
    number is the number of lines in the file's earlier splits plus its place in
    its own. The lines are written once to the shared folder (the text is read
    once); the splits' sizes are a small table.
    """
    reader = spark.read.format("text")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.load(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        # The reader hands the bytes of a line on as they are.
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
    )
    lines = materialize(lines, "numbered-lines")
    splits, seen = materialize_counted(
        lines.groupBy("file", "split").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "splits"
    )
    before = F.sum("n").over(Window.partitionBy("file").orderBy("split")) - F.col("n")
    offsets = splits.select("file", "split", (before - F.col("first")).alias("offset"))
    if seen["rows"] <= MAX_BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    return lines.join(offsets, ["file", "split"]).select("file", (F.col("at") + F.col("offset")).alias("nr"), "line")


def _marker_places(lines: DataFrame, pieces: Sequence[str]) -> DataFrame:
    """(file, top): the lines ``top`` at whose end a marker begins that reaches
    over the next ``len(pieces) - 1`` lines."""
    # The longest whole line of the marker is rare; only around it the others are looked at.
    anchor = max(range(1, len(pieces) - 1), key=lambda i: len(pieces[i]))
    found = lines.filter(F.col("line") == pieces[anchor]).select("file", (F.col("nr") - anchor).alias("top"))
    found, seen = materialize_counted(found.filter("top >= 0"), "marker-lines")
    last = len(pieces) - 1
    others = [i for i in range(len(pieces)) if i != anchor]
    wanted = found.select("file", "top", F.explode(F.array(*[F.lit(i) for i in others])).alias("i"))
    wanted = wanted.withColumn("nr", F.col("top") + F.col("i"))
    if seen["rows"] * len(others) <= MAX_BROADCAST_SPLITS:
        wanted = F.broadcast(wanted)
    near = lines.join(wanted, ["file", "nr"])
    fits = F.lit(False)
    for i in others:
        piece = F.lit(pieces[i])
        one = F.endswith("line", piece) if i == 0 else F.startswith("line", piece) if i == last else F.col("line") == piece
        fits = F.when(F.col("i") == i, one).otherwise(fits)
    whole = near.filter(fits).groupBy("file", "top").agg(F.count(F.lit(1)).alias("n"))
    return whole.filter(F.col("n") == len(others)).select("file", "top")


def section_bounds(lines: DataFrame, marker: str) -> DataFrame:
    """(file, top, stop): the line at whose end the marker begins and the line at
    whose end the next one does (NULL: the section ends with the file)."""
    pieces = marker.split("\n")
    places = _marker_places(lines, pieces)
    first = places.groupBy("file").agg(F.min("top").alias("top"))
    # The next marker begins where the first has ended, in its last line at the earliest.
    rest = places.withColumnRenamed("top", "next").join(first, "file").filter(F.col("next") >= F.col("top") + len(pieces) - 1)
    if pieces[0] and pieces[-1]:  # both in one line: it must hold the one's end and the other's start
        shared = lines.select("file", F.col("nr").alias("next"), F.char_length("line").alias("chars"))
        rest = rest.join(shared, ["file", "next"]).filter(
            (F.col("next") > F.col("top") + len(pieces) - 1) | (F.col("chars") >= len(pieces[0]) + len(pieces[-1]))
        )
    stop = rest.groupBy("file").agg(F.min("next").alias("stop"))
    return first.join(stop, "file", "left")


def read_sectioned(
    spark: SparkSession,
    path: str,
    marker: str,
    columns: Sequence[str],
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    glob: str | None = None,
    drop_last: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Sectioned files under ``path`` -> (rows, rejects), as ``sectioned_rows``
    gives them for texts in a column, but for files of any size: a section may
    reach over many splits. ``marker`` must hold a whole line. Files without the
    marker, empty ones among them, are rejects."""
    pieces = marker.split("\n")
    if len(pieces) < 3:
        raise ValueError("the marker must hold a whole line, between two line ends")
    lines = numbered_lines(spark, path, encoding, glob)
    bounds, seen = materialize_counted(section_bounds(lines, marker), "sections")
    small = seen["rows"] <= MAX_BROADCAST_SPLITS
    sections = F.broadcast(bounds) if small else bounds
    body = lines.join(sections, "file")
    start = F.col("top") + len(pieces) - 1
    body = body.filter((F.col("nr") >= start) & (F.col("stop").isNull() | (F.col("nr") <= F.col("stop"))))
    line = F.col("line")
    if pieces[0]:  # the next marker begins inside the section's last line
        line = F.when(F.col("nr") == F.col("stop"), line.substr(F.lit(1), F.char_length(line) - len(pieces[0]))).otherwise(line)
    if pieces[-1]:  # the marker ends inside the section's first line
        line = F.when(F.col("nr") == start, line.substr(F.lit(len(pieces[-1]) + 1), F.char_length(line))).otherwise(line)
    body = body.select("file", "nr", line.alias("line"), start.alias("start"), "stop")
    # A line end right before the next marker ends the last line; it does not start an empty one.
    blank = (F.col("nr") == F.col("stop")) & (F.col("nr") > F.col("start")) & (F.col("line") == "")
    body = body.filter(~F.coalesce(blank, F.lit(False)))
    last = body.groupBy("file").agg(F.max("nr").alias("last"))
    body = body.join(F.broadcast(last) if small else last, "file").filter(F.col("nr") <= F.col("last") - drop_last)
    cells = F.split(F.col("line"), sep, -1)
    rows = body.select("file", *[F.try_element_at(cells, F.lit(i + 1)).alias(c) for i, c in enumerate(columns)])

    listing = spark.read.format("binaryFile")
    if glob:
        listing = listing.option("pathGlobFilter", glob)
    files = listing.load(path).select(F.col("_metadata.file_path").alias("file"))  # names only, no contents
    return rows, files.join(bounds.select("file"), "file", "left_anti")
