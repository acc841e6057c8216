"""The observation pipeline: raw text -> clean tables -> star schema.

Entry point A (raw): ``fetch_*`` read the category folders
(``<root>/<category>/tables`` and ``<root>/<category>/metadata``) or, with
``*_from_archives``, the zip archives themselves; ``transform_*`` clean them;
``run_raw`` writes the measurements partitioned by local year and the two
histories as CSV. ``listing_links`` / ``links_to_fetch`` select what to
download.

Entry point B (marts): ``stg_measurements`` (a view in the source: one row
per station and day, typed, keyed), ``dim_geo``, ``dim_operator`` and
``fact_measurements`` (effective-dated joins); ``run_marts`` publishes the
fact partitioned by UTC month and clustered by time, then reports the
declared tests. ``run_all`` / ``main`` run both; ``station_year_max``,
``years_since`` and ``hottest_days`` are the exploratory queries.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    cast_int_rounded,
    clean_station_id,
    concat_nullable,
    localize,
    local_year,
    parse_yyyymmdd,
    surrogate_key,
    year_month,
)
from ..operators import (
    Check,
    ObservedChecks,
    Quarantine,
    check_relationships,
    check_unique,
    distinct_values,
    effective_dated_join,
    fits_broadcast,
    group_max,
    keep_first,
    quality_report,
    raise_on_error,
    row_checks,
    top_k,
    total_order,
    union_categories,
)
from ..operators.effective import row_bytes
from ..schemas import (
    CATEGORIES,
    FACT_COLUMNS,
    GEO_COLUMNS,
    GEO_DIM_COLUMNS,
    GEO_FILE_GLOB,
    GEO_RENAMES,
    LISTING_KEEP,
    MEASUREMENT_COLUMNS,
    MEASUREMENT_FILE_TOKEN,
    OPERATOR_COLUMNS,
    OPERATOR_DIM_COLUMNS,
    OPERATOR_FILE_GLOB,
    OPERATOR_MARKER,
    PRECIPITATION_FORMS,
    QUALITY_LEVELS,
    STAGING_COLUMNS,
)
from ..session import at_once, materialize, materialize_counted
from ..sinks import create_view, drop_partitions, partition_values, publish_version, write_csv, write_partitioned
from ..sources import (
    extract_links,
    member_lines,
    new_files,
    read_archives,
    read_delimited,
    read_delimited_checked,
    read_sectioned,
    read_table,
)
from ..sources.delimited import bind_by_header
from ..sources.sections import sectioned_rows
from ..sources.tables import read_csv_table, read_parquet

GEO_CSV_SCHEMA = (
    "stations_id string, stationshoehe double, geogr_breite double, geogr_laenge double, "
    "von_datum timestamp_ntz, bis_datum timestamp_ntz, stationsname string"
)
OPERATOR_CSV_SCHEMA = (
    "stations_id string, betreibername string, betrieb_von_datum timestamp_ntz, "
    "betrieb_bis_datum timestamp_ntz"
)

#: Stations to expect in a row group, for its Bloom filter.
STATIONS = 10_000

# ---------------------------------------------------------------------------
# Raw
# ---------------------------------------------------------------------------


DEFAULT_GLOBS = {"main": "*.txt", "metadata_geo": GEO_FILE_GLOB, "metadata_operator": OPERATOR_FILE_GLOB}


def fetch_measurements(
    spark: SparkSession, root: str, categories: Sequence[str] = CATEGORIES, glob: str = DEFAULT_GLOBS["main"]
) -> DataFrame:
    """All daily files of all categories, bound by header name, tagged with
    their category."""

    def read(c: str) -> DataFrame:
        return read_delimited(spark, f"{root}/{c}/tables", MEASUREMENT_COLUMNS, "STATIONS_ID", glob=glob)

    parts = dict(zip(categories, at_once(*[lambda c=c: read(c) for c in categories])))
    return union_categories(parts).drop("file")


def fetch_measurements_checked(
    spark: SparkSession, root: str, categories: Sequence[str] = CATEGORIES, glob: str = DEFAULT_GLOBS["main"]
) -> Quarantine:
    """``fetch_measurements`` with the lines that are not as declared set apart:
    wrong number of cells, no station or day, a value that is not of its type."""
    found = {
        c: read_delimited_checked(
            spark, f"{root}/{c}/tables", MEASUREMENT_COLUMNS, "STATIONS_ID", glob=glob, required=["mess_datum"]
        )
        for c in categories
    }
    counts = {k: sum(q.counts[k] for q in found.values()) for k in ("rows", "rejects")}
    rows = union_categories({c: q.rows for c, q in found.items()}).drop("file")
    return Quarantine(rows, union_categories({c: q.rejects for c, q in found.items()}), counts)


def listing_links(pages: DataFrame, html: str = "html", carry: Sequence[str] = ("category",)) -> DataFrame:
    """Archive, text and pdf links of the listing pages (one row per link)."""
    return extract_links(pages, html, keep=LISTING_KEEP, carry=carry)


def links_to_fetch(links: DataFrame, stored: DataFrame) -> DataFrame:
    """Listed links whose file (the href) is not stored yet."""
    return new_files(links, stored, "href")


def _archive_members(spark: SparkSession, root: str, category: str, token: str) -> DataFrame:
    """Members of ``<root>/<category>/download/*.zip`` whose name holds
    ``token``."""
    return read_archives(spark, f"{root}/{category}/download", token=token)


def measurements_from_archives(
    spark: SparkSession, root: str, categories: Sequence[str] = CATEGORIES, encoding: str = "ISO-8859-1"
) -> DataFrame:
    """The daily files read straight out of the zip archives of each
    category (no unpacking to disk): members named like the data files,
    each bound by its own header, tagged with the category."""
    parts = {
        c: bind_by_header(
            member_lines(_archive_members(spark, root, c, MEASUREMENT_FILE_TOKEN), encoding),
            MEASUREMENT_COLUMNS,
            "STATIONS_ID",
        )
        for c in categories
    }
    return union_categories(parts).drop("file")


def geo_from_archives(spark: SparkSession, root: str, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    parts = {
        c: bind_by_header(
            member_lines(_archive_members(spark, root, c, GEO_FILE_GLOB.rstrip("*")), "ISO-8859-1"),
            GEO_COLUMNS,
            "Stations_id",
            renames=GEO_RENAMES,
        )
        for c in categories
    }
    return union_categories(parts).drop("file", "category")


def operator_from_archives(
    spark: SparkSession, root: str, categories: Sequence[str] = ("recent",)
) -> tuple[DataFrame, DataFrame]:
    rows, rejects = None, None
    for c in categories:
        members = _archive_members(spark, root, c, OPERATOR_FILE_GLOB.rstrip("*"))
        files = members.select(
            F.concat_ws("!", "archive", "member").alias("file"), F.decode("body", "ISO-8859-1").alias("text")
        )
        r, j = sectioned_rows(files, OPERATOR_MARKER, OPERATOR_COLUMNS)
        rows = r if rows is None else rows.unionByName(r)
        rejects = j if rejects is None else rejects.unionByName(j)
    return rows.drop("file"), rejects


def transform_measurements(df: DataFrame) -> DataFrame:
    """Ids stripped and padded; the date parsed, localised to UTC (DST
    edges NULL) and its local year kept as the storage partition."""
    # The parsed date is its own column: localize() refers to its input
    # about ten times, and an inlined parser would be copied into each.
    df = df.withColumn("__local", parse_yyyymmdd("mess_datum"))
    local = F.col("__local")
    return df.withColumns(
        {
            "stations_id": clean_station_id("stations_id"),
            "year": local_year(local),
            "mess_datum": localize(local),
        }
    ).drop("__local")


def fetch_geo(
    spark: SparkSession, root: str, categories: Sequence[str] = CATEGORIES, glob: str = DEFAULT_GLOBS["metadata_geo"]
) -> DataFrame:

    def read(c: str) -> DataFrame:
        return read_delimited(
            spark,
            f"{root}/{c}/metadata",
            GEO_COLUMNS,
            "Stations_id",
            encoding="ISO-8859-1",
            glob=glob,
            renames=GEO_RENAMES,
        )

    parts = dict(zip(categories, at_once(*[lambda c=c: read(c) for c in categories])))
    return union_categories(parts).drop("file", "category")


def transform_history(df: DataFrame, id_col: str, date_cols: Sequence[str]) -> DataFrame:
    """Ids stripped and padded; interval dates parsed and localised (the
    parsed values first as their own columns, see transform_measurements)."""
    df = df.withColumns({f"__local_{c}": parse_yyyymmdd(c) for c in date_cols})
    out = {id_col: clean_station_id(id_col)}
    out.update({c: localize(F.col(f"__local_{c}")) for c in date_cols})
    return df.withColumns(out).drop(*[f"__local_{c}" for c in date_cols])


def fetch_operator(
    spark: SparkSession,
    root: str,
    categories: Sequence[str] = ("recent",),
    glob: str = DEFAULT_GLOBS["metadata_operator"],
) -> tuple[DataFrame, DataFrame]:
    """Operator tables from the sectioned files (recent only by default, as
    published). Returns (rows, rejected files)."""
    rows, rejects = None, None
    for c in categories:
        r, j = read_sectioned(spark, f"{root}/{c}/metadata", OPERATOR_MARKER, OPERATOR_COLUMNS, glob=glob)
        rows = r if rows is None else rows.unionByName(r)
        rejects = j if rejects is None else rejects.unionByName(j)
    return rows.drop("file"), rejects


def run_raw(
    spark: SparkSession,
    root: str,
    out: str,
    counts: dict[str, int] | None = None,
    globs: dict[str, str] | None = None,
    from_archives: bool = False,
    quarantine: bool = False,
) -> dict[str, str]:
    """Raw -> clean files: measurements by local year (gzip Parquet, sorted
    by time), histories as CSV with header. Full refresh.

    An operator history without its marker line fails the run, and values that are
    not of their type become NULL. With ``quarantine`` the run goes on instead:
    such files, and measurement lines that are not as declared, are written to
    ``rejects`` (dataset, category, file, line, reason) and counted there.

    Row counts are observed while writing (no second job) and stored in
    ``counts`` when given. ``from_archives``: read the zips under
    ``<root>/<category>/download`` directly instead of unpacked folders.
    """
    globs = {**DEFAULT_GLOBS, **(globs or {})}
    lines: Quarantine | None = None

    def cleaned(rows: DataFrame) -> DataFrame:
        # Written once: the range-partitioned write samples its input before it shuffles it.
        return materialize(transform_measurements(rows), "measurements")

    if from_archives:
        main, geo_raw = cleaned(measurements_from_archives(spark, root)), geo_from_archives(spark, root)
        op_rows, rejects = operator_from_archives(spark, root)
    else:

        def fetch_main() -> tuple[Quarantine | None, DataFrame]:
            if not quarantine:
                return None, cleaned(fetch_measurements(spark, root, glob=globs["main"]))
            found = fetch_measurements_checked(spark, root, glob=globs["main"])
            return found, cleaned(found.rows)

        (lines, main), geo_raw, (op_rows, rejects) = at_once(
            fetch_main,
            lambda: fetch_geo(spark, root, glob=globs["metadata_geo"]),
            lambda: fetch_operator(spark, root, glob=globs["metadata_operator"]),
        )
    bad = [r["file"] for r in rejects.select("file").limit(20).collect()]
    if bad and not quarantine:
        raise ValueError(f"operator history without its marker line: {', '.join(bad)}")
    geo = transform_history(geo_raw, "stations_id", ["von_datum", "bis_datum"])
    op = transform_history(op_rows, "stations_id", ["betrieb_von_datum", "betrieb_bis_datum"])
    obs = {name: Observation(name) for name in ("main", "metadata_geo", "metadata_operator")}
    geo = geo.observe(obs["metadata_geo"], F.count(F.lit(1)).alias("rows"))
    op = op.observe(obs["metadata_operator"], F.count(F.lit(1)).alias("rows"))
    writes = {
        "main": lambda: write_partitioned(
            main,
            f"{out}/main",
            ["year"],
            cluster_by=["mess_datum", "stations_id"],
            compression="gzip",
            observation=obs["main"],
            full_refresh=True,
        ),
        "metadata_geo": lambda: write_csv(geo, f"{out}/metadata_geo"),
        "metadata_operator": lambda: write_csv(op, f"{out}/metadata_operator"),
    }
    # The three writes are independent Spark jobs: submitted from separate
    # driver threads, the small history writes use slots the large write
    # leaves idle instead of waiting for it.
    paths = dict(zip(writes, at_once(*writes.values())))
    if counts is not None:
        counts.update({name: o.get["rows"] for name, o in obs.items()})
    if quarantine:
        none = F.lit(None).cast("string")
        left = rejects.select(
            F.lit("metadata_operator").alias("dataset"),
            none.alias("category"),
            "file",
            none.alias("line"),
            F.lit("no marker line").alias("reason"),
        )
        if lines is not None:
            left = left.unionByName(lines.rejects.select(F.lit("main").alias("dataset"), "category", "file", "line", "reason"))
        seen = Observation("rejects")
        paths["rejects"] = write_partitioned(left, f"{out}/rejects", [], observation=seen)
        if counts is not None:
            counts["rejects"] = seen.get["rows"]
    return paths


# ---------------------------------------------------------------------------
# Marts
# ---------------------------------------------------------------------------


def stg_measurements(raw: DataFrame, test_run: bool = False) -> DataFrame:
    """One typed, keyed row per (station, day).

    Duplicates (the same day in both categories, or twice in one) are ranked
    historical first, then higher quality codes, then every other column.
    """
    keys = ["stations_id", "mess_datum"]
    first = []
    if "category" in raw.columns:
        raw = raw.withColumn("__hist", (F.col("category") == "historical").cast("int"))
        first.append(("__hist", True))
    first += [("qn_4", True), ("qn_3", True)]
    dedup = keep_first(raw, keys, total_order(raw, keys, first=first))
    cols = [surrogate_key(dedup, keys).alias("measurement_id")]
    for raw_name, (name, kind) in STAGING_COLUMNS.items():
        c = F.col(raw_name)
        if kind == "int":
            c = cast_int_rounded(c.try_cast("double"))
        elif kind == "round2":
            c = F.round(c.try_cast("double"), 2)
        elif kind == "ts":
            c = c.cast("timestamp_ntz")
        else:
            c = c.cast("string")
        cols.append(c.alias(name))
    stg = dedup.select(*cols)
    if test_run:
        stg = stg.orderBy("measurement_id").limit(100)
    return stg


def _dim(history: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    return history.select(*[F.col(raw).cast(kind).alias(name) for raw, (name, kind) in columns.items()])


def dim_geo(geo: DataFrame) -> DataFrame:
    return _dim(geo, GEO_DIM_COLUMNS)


def dim_operator(op: DataFrame) -> DataFrame:
    return _dim(op, OPERATOR_DIM_COLUMNS)


def fact_measurements(
    stg: DataFrame,
    geo: DataFrame,
    op: DataFrame,
    geo_size: dict | None = None,
    op_size: dict | None = None,
    **join_options,
) -> DataFrame:
    """Measurements with the location and operator valid on their day.
    Overlapping history rows multiply measurements (reported by the unique
    check); measurements without a valid history row keep NULLs.
    ``geo_size`` / ``op_size``: known ``rows`` and ``bytes`` of already
    materialised histories (then pass ``materialize_dim=False``)."""

    def known(size: dict | None) -> dict:
        return {"dim_rows": size["rows"], "dim_bytes": size["bytes"]} if size else {}

    f = effective_dated_join(
        stg, geo, "station_id", "dt_measurement_utc", "dt_geo_start", "dt_geo_end", **known(geo_size), **join_options
    )
    f = effective_dated_join(
        f, op, "station_id", "dt_measurement_utc", "dt_op_start", "dt_op_end", **known(op_size), **join_options
    )
    f = f.withColumn("lat_long", concat_nullable(F.col("latitude"), F.col("longitude")))
    return f.select(*FACT_COLUMNS)


def staging_checks() -> ObservedChecks:
    """The row tests declared for the staging model, counted while its rows pass."""
    return ObservedChecks(
        not_null=[("measurement_id", "warn"), ("station_id", "warn"), ("dt_measurement_utc", "warn")],
        accepted=[
            ("quality_niveau_3", QUALITY_LEVELS, "error"),
            ("quality_niveau_4", QUALITY_LEVELS, "error"),
            ("precipitation_type_qn4", PRECIPITATION_FORMS, "error"),
        ],
        name="staging",
    )


def fact_checks(fact: DataFrame, geo: DataFrame, op: DataFrame) -> tuple[list[Check], DataFrame]:
    """The declared tests of the fact table: the key and referential checks
    as their own jobs, the row-level ones fused into two passes."""
    checks = [
        Check("unique", "measurement_id", check_unique(fact, "measurement_id"), "warn"),
        Check("relationships", "station_id->dim_geo", check_relationships(fact, "station_id", geo, "station_id"), "warn", count_rows=True),
        Check("relationships", "station_id->dim_operator", check_relationships(fact, "station_id", op, "station_id"), "warn", count_rows=True),
    ]
    rows = row_checks(
        fact,
        not_null=[("measurement_id", "warn"), ("station_id", "warn"), ("dt_measurement_utc", "warn")],
        accepted=[
            ("quality_niveau_3", QUALITY_LEVELS, "error"),
            ("quality_niveau_4", QUALITY_LEVELS, "error"),
            ("precipitation_type_qn4", PRECIPITATION_FORMS, "error"),
        ],
    )
    return checks, rows


def read_raw(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    main = read_parquet(spark, paths["main"], {"year": "string"})
    geo = read_csv_table(spark, paths["metadata_geo"], GEO_CSV_SCHEMA)
    op = read_csv_table(spark, paths["metadata_operator"], OPERATOR_CSV_SCHEMA)
    return main, geo, op


class FactBuild(NamedTuple):
    """A fact that is ready to be written, and what it was joined to."""

    fact: DataFrame  # with its month column
    geo: DataFrame
    op: DataFrame
    ordered: bool  # still range-partitioned on (day, station): both histories were broadcast


def _join_histories(stg: DataFrame, geo: DataFrame, op: DataFrame, **join_options) -> FactBuild:
    # Both histories are written once to the shared folder (lineage cut,
    # rows and bytes counted during the write), in parallel: they are independent jobs.
    def written(dim: DataFrame, name: str) -> tuple[DataFrame, dict]:
        return materialize_counted(dim, name, bytes=F.coalesce(F.sum(row_bytes(dim)), F.lit(0)))

    (geo, geo_size), (op, op_size) = at_once(lambda: written(geo, "dim_geo"), lambda: written(op, "dim_operator"))
    limits = {k.replace("max_broadcast", "max"): v for k, v in join_options.items() if k.startswith("max_broadcast")}
    ordered = all(fits_broadcast(size["rows"], size["bytes"], **limits) for size in (geo_size, op_size))
    fact = fact_measurements(stg, geo, op, geo_size, op_size, materialize_dim=False, **join_options)
    return FactBuild(fact.withColumn("month", year_month(F.col("dt_measurement_utc"))), geo, op, ordered)


def build_fact(
    spark: SparkSession, paths: dict[str, str], **join_options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fact with its month column, dim_geo, dim_operator) from the raw files."""
    return _build_fact(spark, paths, **join_options)[:3]


def _build_fact(spark: SparkSession, paths: dict[str, str], **join_options) -> FactBuild:
    """One shuffle for the whole fact build: a range partition on (day,
    station) puts every station-day in one task (what the dedup window
    needs) and gives each task a contiguous time range (what the
    month-partitioned, time-clustered write needs). Broadcast history joins
    keep this partitioning; a history too large for that is swept, which ends
    the order, and ``ordered`` says so.
    """
    main, geo_raw, op_raw = read_raw(spark, paths)
    main = main.repartitionByRange("mess_datum", "stations_id")
    # The staging model is a view: evaluated inside the fact build.
    create_view(stg_measurements(main), "stg_measurements")
    stg = read_table(spark, "stg_measurements")
    return _join_histories(stg, dim_geo(geo_raw), dim_operator(op_raw), **join_options)


def run_marts(spark: SparkSession, paths: dict[str, str], out: str, **join_options) -> tuple[str, DataFrame]:
    """Raw files -> published dims (``dim_geo``, ``dim_operator``) and fact (by
    UTC month, clustered by time), and the quality report of the published fact."""
    fact, geo, op, ordered = _build_fact(spark, paths, **join_options)
    _, _, path = at_once(
        lambda: geo.write.mode("overwrite").parquet(f"{out}/dim_geo"),
        lambda: op.write.mode("overwrite").parquet(f"{out}/dim_operator"),
        lambda: write_partitioned(
            fact,
            f"{out}/fact_measurements",
            ["month"],
            cluster_by=["dt_measurement_utc", "station_id"],
            range_partitioned=ordered,
            full_refresh=True,
            bloom={"station_id": STATIONS},
        ),
    )
    published = spark.read.parquet(path)
    checks, rows = fact_checks(published, geo, op)
    return path, quality_report(checks, [rows])


def publish_marts(
    spark: SparkSession, paths: dict[str, str], prefix: str = "", fail_on_error: bool = True, **join_options
) -> dict[str, str]:
    """Raw files -> catalog tables that readers find by name: the raw
    measurements by month, both dims and the fact by month.

    Each is a new version behind its name (``sinks.publish_version``): a load
    that fails leaves the version before readable. The staging model and the
    fact read what was published. The declared tests of staging are counted while
    its rows pass, those of the fact run on the new version; both are published
    as ``quality_report`` before the fact's name is moved, so rows that fail at
    error level are never visible by name (unless ``fail_on_error`` is off).
    """
    tables = ("raw_measurements", "dim_geo", "dim_operator", "fact_measurements", "quality_report")
    names = {t: f"{prefix}{t}" for t in tables}
    main, geo_raw, op_raw = read_raw(spark, paths)
    month = year_month(F.col("mess_datum").cast("timestamp_ntz"))
    publish_version(
        main.withColumn("month", month), names["raw_measurements"], ["month"], cluster_by=["mess_datum", "stations_id"]
    )
    publish_version(dim_geo(geo_raw), names["dim_geo"])
    publish_version(dim_operator(op_raw), names["dim_operator"])

    raw = read_table(spark, names["raw_measurements"]).drop("month")
    geo, op = read_table(spark, names["dim_geo"]), read_table(spark, names["dim_operator"])
    declared = staging_checks()
    # Behind the range shuffle and its sampling, in front of what writes the rows: counted once.
    stg = declared.attach(stg_measurements(raw.repartitionByRange("mess_datum", "stations_id")))
    built = _join_histories(stg, geo, op, **join_options)

    def audit(version: DataFrame) -> None:
        checks, rows = fact_checks(version, built.geo, built.op)
        report = quality_report(checks, [rows])
        staging = quality_report([], [declared.report(spark)])
        both = report.withColumn("model", F.lit("fact_measurements")).union(staging.withColumn("model", F.lit("stg_measurements")))
        both = materialize(both, "quality-report")
        publish_version(both, names["quality_report"])
        if fail_on_error:
            raise_on_error(both)

    publish_version(
        built.fact,
        names["fact_measurements"],
        ["month"],
        cluster_by=["dt_measurement_utc", "station_id"],
        range_partitioned=built.ordered,
        audit=audit,
    )
    return names


def month_summary(fact: DataFrame) -> DataFrame:
    """Per month of the fact: rows, first and last time, highest temperature. Small
    (a row per month), and enough for the fact's maxima, counts and years."""
    return fact.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("dt_measurement_utc").alias("first_utc"),
        F.max("dt_measurement_utc").alias("last_utc"),
        F.max("max_temperature_2m_c_qn4").alias("max_temperature"),
    )


def refresh_months(
    spark: SparkSession,
    rows: DataFrame,
    out: str,
    geo: DataFrame,
    op: DataFrame,
    batch: int,
    **join_options,
) -> list[str]:
    """Take late ``rows`` (clean measurements, see ``transform_measurements``) into
    ``out`` and return the months they touch.

    ``out/raw_measurements`` (by month and batch), ``out/fact_measurements`` and
    ``out/month_summary`` (by month) keep all other months as they are, file by
    file: only the touched ones are read, deduplicated (a station-day has one month) and replaced. A batch that
    is delivered again replaces its own rows. Rows without a valid day have no
    month and are in no fact; they are left out.
    """
    raw, target, summary = (f"{out}/{t}" for t in ("raw_measurements", "fact_measurements", "month_summary"))
    month = year_month(F.col("mess_datum").cast("timestamp_ntz"))
    late = rows.filter(F.col("mess_datum").isNotNull()).withColumn("month", month)
    late = materialize(late, "late-rows")
    own = f"{raw}/batch={batch}"
    # A row per month; those the batch touched before are recomputed too.
    months = {r["month"] for r in late.select("month").distinct().collect()} | set(partition_values(spark, own, "month"))
    if not months:
        return []
    # Raw rows first: what fails after this is made up for by the batch's next delivery.
    write_partitioned(late, own, ["month"], cluster_by=["mess_datum", "stations_id"], full_refresh=True)
    schema = T.StructType([*late.schema.fields, T.StructField("batch", T.LongType())])
    stored = spark.read.schema(schema).parquet(raw).filter(F.col("month").isin(sorted(months)))
    stg = stg_measurements(stored.drop("month", "batch").repartitionByRange("mess_datum", "stations_id"))
    built = _join_histories(stg, geo, op, **join_options)
    write_partitioned(
        built.fact,
        target,
        ["month"],
        cluster_by=["dt_measurement_utc", "station_id"],
        range_partitioned=built.ordered,
        bloom={"station_id": STATIONS},
    )
    fresh = spark.read.schema(built.fact.schema).parquet(target).filter(F.col("month").isin(sorted(months)))
    write_partitioned(month_summary(fresh), summary, ["month"])
    # A month whose last rows went with the batch's earlier delivery is replaced by nothing.
    left = {r["month"] for r in stored.select("month").distinct().collect()}
    for path in (target, summary):
        drop_partitions(spark, path, "month", sorted(months - left))
    return sorted(months)


# ---------------------------------------------------------------------------
# Analytics on the fact (the exploratory queries)
# ---------------------------------------------------------------------------


def station_year_max(fact: DataFrame, value: str = "max_temperature_2m_c_qn4") -> DataFrame:
    """Highest value per station and year, highest first."""
    out = group_max(
        fact, ["station_id", F.year("dt_measurement_utc").alias("year")], value, "max_value"
    )
    return out.orderBy(F.col("max_value").desc_nulls_last(), "station_id", "year")


def years_since(fact: DataFrame, since: str = "1900-01-01") -> DataFrame:
    """Distinct years with measurements on or after ``since``, newest first."""
    recent = fact.filter(F.to_date("dt_measurement_utc") >= F.lit(since).cast("date"))
    return distinct_values(recent, F.year("dt_measurement_utc"), "year").orderBy(F.col("year").desc())


def hottest_days(fact: DataFrame, k: int = 40) -> DataFrame:
    """The ``k`` highest daily maxima (ties by station and time)."""
    return top_k(
        fact.filter(F.col("max_temperature_2m_c_qn4").isNotNull()),
        k,
        [F.col("max_temperature_2m_c_qn4").desc(), F.col("station_id"), F.col("dt_measurement_utc")],
    )


# ---------------------------------------------------------------------------
# Whole run
# ---------------------------------------------------------------------------


def run_all(spark: SparkSession, root: str, out: str, fail_on_error: bool = True, from_archives: bool = False) -> dict:
    """Raw files -> clean files -> published fact -> checked report.

    ``root`` holds ``<category>/tables`` and ``<category>/metadata`` folders
    (the unpacked archives); ``out`` is the shared output folder. Warn-level
    failures are reported; error-level failures raise when ``fail_on_error``.
    """
    counts: dict[str, int] = {}
    paths = run_raw(spark, root, f"{out}/raw", counts=counts, from_archives=from_archives)
    fact_path, report = run_marts(spark, paths, f"{out}/marts")
    rows = raise_on_error(report) if fail_on_error else report.collect()
    return {"paths": {**paths, "fact": fact_path}, "rows": counts, "report": [r.asDict() for r in rows]}


def main(argv: Sequence[str] | None = None) -> None:
    import argparse
    import json

    from ..session import build_session

    ap = argparse.ArgumentParser(description="Build the observation star schema.")
    ap.add_argument("root", help="folder with <category>/tables and <category>/metadata (or <category>/download)")
    ap.add_argument("out", help="shared output folder")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit on a cluster")
    ap.add_argument("--warn-only", action="store_true", help="do not fail on error-level checks")
    ap.add_argument("--from-archives", action="store_true", help="read <root>/<category>/download/*.zip directly")
    args = ap.parse_args(argv)
    spark = build_session(master=args.master)
    result = run_all(spark, args.root, args.out, not args.warn_only, args.from_archives)
    print(json.dumps(result, default=str, indent=2))


if __name__ == "__main__":
    main()
