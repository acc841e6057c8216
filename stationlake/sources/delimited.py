"""Delimited text bound to columns by header name, file by file.

Spark's CSV reader takes the header of one file and binds every other file
by position, silently: two files with swapped columns come back with their
values swapped. Here each line is split once and every file is bound by its
own header line. The text is read once, however often the rows are used:

1. one scan writes all lines to the shared folder, header lines (a cell names
   the id column) apart from data lines;
2. the few header rows give, per file, the position of each wanted column;
3. data rows are joined to their file's positions, split, and the cells picked.

A line is written as one value: as an array of its cells it took four times as
long. Whoever passes over the rows more than once (the sampling of a
range-partitioned write does) writes the typed rows first (``materialize``).

Columns beyond the wanted ones are ignored; a wanted column missing from a
file is NULL for that file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import null_sentinel
from ..operators.quarantine import Quarantine, quarantine
from ..schemas import MISSING, clean_name
from ..session import materialize_counted

# Files are few compared to lines: the per-file position table is broadcast
# up to this many header lines, shuffled beyond it.
MAX_BROADCAST_FILES = 200_000

# Why a line is rejected.
NO_HEADER, WRONG_CELLS, NO_VALUE, BAD_VALUE = "no header line", "wrong number of cells", "no value in ", "bad value in "


def _pos(name: str) -> str:
    return "__p_" + name.replace(".", "_")


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8", glob: str | None = None
) -> DataFrame:
    """(file, line) for every line; decoded with ``encoding``."""
    reader = (
        spark.read.format("csv")
        .schema("line string")
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .option("escape", "\u0000")
        .option("header", "false")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("encoding", encoding)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return reader.load(paths).select(F.col("_metadata.file_path").alias("file"), "line")


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Mapping[str, str],
    id_column: str,
    sep: str = ";",
    encoding: str = "UTF-8",
    glob: str | None = None,
    sentinel: str | None = MISSING,
    renames: Mapping[str, str] | None = None,
    max_broadcast_files: int = MAX_BROADCAST_FILES,
) -> DataFrame:
    """Typed columns named ``clean_name(header)``.

    ``columns`` maps the header cell as published (e.g. ``"  FX"``) to a Spark
    type name. Values are trimmed, the text sentinel becomes NULL before any
    cast, and casts that fail give NULL. ``renames`` maps clean names to
    output names (e.g. dotted names). The result also carries ``file``.
    """
    lines = read_lines(spark, paths, encoding, glob)
    return bind_by_header(lines, columns, id_column, sep, sentinel, renames, max_broadcast_files)


def read_delimited_checked(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Mapping[str, str],
    id_column: str,
    sep: str = ";",
    encoding: str = "UTF-8",
    glob: str | None = None,
    sentinel: str | None = MISSING,
    renames: Mapping[str, str] | None = None,
    max_broadcast_files: int = MAX_BROADCAST_FILES,
    required: Sequence[str] = (),
    valid: Mapping[str, Column] | None = None,
) -> Quarantine:
    """``read_delimited`` with the lines that are not as declared set apart
    (see ``bind_checked``): one pass writes good rows and rejects, counted."""
    lines = read_lines(spark, paths, encoding, glob)
    rows = bind_checked(lines, columns, id_column, sep, sentinel, renames, max_broadcast_files, required, valid)
    return quarantine(rows, "delimited", ["file", "line", "reason"], keep=["file"])


def _names(cells: Column) -> Column:
    return F.transform(cells, lambda z: F.lower(F.replace(z, F.lit(" "), F.lit(""))))


def _staged(lines: DataFrame, id_column: str, sep: str) -> tuple[DataFrame, int]:
    """(file, line, kind) of all lines that are not blank, written once with
    header lines in a folder of their own, and the number of header lines."""
    names = _names(F.split(F.col("line"), sep, -1))
    id_name = clean_name(id_column)
    # A header line has a cell naming the id column, wherever it stands. The
    # substring test is cheap and rules out data lines before any split.
    is_header = F.lower(F.col("line")).contains(id_name) & F.array_contains(names, id_name)
    rows = lines.filter(F.trim(F.col("line")) != "").select(
        "file", "line", F.when(is_header, "header").otherwise("data").alias("kind")
    )
    rows, seen = materialize_counted(rows, "lines", ["kind"], headers=F.count_if(F.col("kind") == "header"))
    return rows, seen["headers"]


def _bound(
    lines: DataFrame, wanted: Mapping[str, str], id_column: str, sep: str, max_broadcast_files: int
) -> DataFrame:
    """Data lines (file, cells) with their file's positions and header width; NULLs without a header line."""
    staged, headers = _staged(lines, id_column, sep)
    staged = staged.select("file", F.split(F.col("line"), sep, -1).alias("cells"), "kind")
    names = _names(F.col("cells"))
    positions = staged.filter(F.col("kind") == "header").select(
        F.col("file").alias("__file"),
        F.size("cells").alias("__width"),
        *[F.array_position(names, F.lit(name)).cast("int").alias(_pos(name)) for name in wanted],
    )
    positions = positions.dropDuplicates(["__file"])  # a header line that a file repeats binds it once
    if headers <= max_broadcast_files:
        positions = F.broadcast(positions)
    data = staged.filter(F.col("kind") == "data").drop("kind")
    return data.join(positions, F.col("file") == F.col("__file"), "left")


def _raw_cell(name: str) -> Column:
    pos = F.col(_pos(name))
    return F.when(pos > 0, F.try_element_at(F.col("cells"), pos))


def _cell(name: str, sentinel: str | None) -> Column:
    raw = _raw_cell(name)
    return null_sentinel(raw, sentinel) if sentinel is not None else F.trim(raw)


def _typed(text: Column, dtype: str) -> Column:
    return text if dtype == "string" else text.try_cast(dtype)


def bind_by_header(
    lines: DataFrame,
    columns: Mapping[str, str],
    id_column: str,
    sep: str = ";",
    sentinel: str | None = MISSING,
    renames: Mapping[str, str] | None = None,
    max_broadcast_files: int = MAX_BROADCAST_FILES,
) -> DataFrame:
    """(file, line) rows -> typed columns, each file bound by its own header
    line (the line with a cell naming ``id_column``). A file with data lines
    and no header line fails the run."""
    wanted = {clean_name(h): t for h, t in columns.items()}
    data = _bound(lines, wanted, id_column, sep, max_broadcast_files)
    # Lines of a file without a header line fail the run; they are not left out.
    lost = F.raise_error(F.concat(F.lit(f"{NO_HEADER} in "), F.col("file"))).cast("boolean")
    data = data.filter(F.when(F.col("__file").isNull(), lost).otherwise(F.lit(True)))
    renames = renames or {}
    # Trimmed texts become columns before they are compared with the sentinel: each is made once.
    data = data.withColumns({f"__t_{k}": F.trim(_raw_cell(n)) for k, n in enumerate(wanted)})
    text = [F.col(f"__t_{k}") for k in range(len(wanted))]
    if sentinel is not None:
        text = [F.when(t != F.lit(sentinel), t) for t in text]
    return data.select("file", *[_typed(c, t).alias(renames.get(n, n)) for c, (n, t) in zip(text, wanted.items())])


def bind_checked(
    lines: DataFrame,
    columns: Mapping[str, str],
    id_column: str,
    sep: str = ";",
    sentinel: str | None = MISSING,
    renames: Mapping[str, str] | None = None,
    max_broadcast_files: int = MAX_BROADCAST_FILES,
    required: Sequence[str] = (),
    valid: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``bind_by_header`` that judges instead of failing: the typed columns,
    ``file`` and ``reason``, NULL for good lines, and for the others ``line`` as read.

    The first that applies is the reason: the file has no header line; the line
    has not as many cells as its header; the id column or one of ``required``
    (output names) is missing; a value that is there is not of its type or fails
    its condition in ``valid`` (by output name; NULL fails).
    """
    wanted = {clean_name(h): t for h, t in columns.items()}
    named = {n: (renames or {}).get(n, n) for n in wanted}
    data = _bound(lines, wanted, id_column, sep, max_broadcast_files)
    # Texts and values become columns before they are judged: each is made once.
    data = data.withColumns({f"__t_{k}": _cell(n, sentinel) for k, n in enumerate(wanted)})
    data = data.withColumns({named[n]: _typed(F.col(f"__t_{k}"), t) for k, (n, t) in enumerate(wanted.items())})
    text = {named[n]: F.col(f"__t_{k}") for k, n in enumerate(wanted)}
    needed = dict.fromkeys([named[clean_name(id_column)], *required])
    # An empty cell is a missing value.
    there = {n: t.isNotNull() & (t != "") for n, t in text.items()}
    reason = F.when(F.col("__file").isNull(), NO_HEADER).when(F.size("cells") != F.col("__width"), WRONG_CELLS)
    for name in needed:
        reason = reason.when(~F.coalesce(there[name], F.lit(False)), NO_VALUE + name)
    for name in text:
        ok = F.col(f"`{name}`").isNotNull()
        if valid and name in valid:
            ok = ok & F.coalesce(valid[name], F.lit(False))
        reason = reason.when(there[name] & ~ok, BAD_VALUE + name)
    data = data.withColumn("reason", reason)
    line = F.when(F.col("reason").isNotNull(), F.array_join("cells", sep, ""))
    return data.select("file", *[F.col(f"`{n}`") for n in text], line.alias("line"), "reason")
