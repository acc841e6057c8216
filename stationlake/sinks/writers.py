"""Writers.

Layout for time-partitioned tables: rows are range-partitioned on the
clustering timestamp, so each task holds one contiguous time range. A task
then writes to one or two partition folders (not to every month it happens
to hold), files come out sorted by time (row-group min/max skipping works),
and a month holding a third of the data is split over many tasks instead of
landing in one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import ObservedChecks

# A published name is a view; its property tells the version it reads.
_VERSION = "__v"
_POINTS_TO = "stationlake.version"


def _clustered(
    df: DataFrame,
    partition_by: Sequence[str],
    cluster_by: str | Sequence[str] | None,
    partitions: int | None,
    range_partitioned: bool = False,
) -> DataFrame:
    if cluster_by is None:
        return df
    cols = [cluster_by] if isinstance(cluster_by, str) else list(cluster_by)
    if range_partitioned:
        pass
    elif partitions:
        df = df.repartitionByRange(partitions, *cols)
    else:
        df = df.repartitionByRange(*cols)
    return df.sortWithinPartitions(*partition_by, *cols)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    cluster_by: str | Sequence[str] | None = None,
    compression: str = "snappy",
    mode: str = "overwrite",
    partitions: int | None = None,
    max_records_per_file: int | None = None,
    observation: Observation | None = None,
    range_partitioned: bool = False,
    full_refresh: bool = False,
    checks: ObservedChecks | None = None,
    bloom: Mapping[str, int] | None = None,
) -> str:
    """Hive-style partitioned Parquet. With the session's dynamic overwrite
    mode only the partitions present in ``df`` are replaced; a
    ``full_refresh`` replaces the whole table, old partitions included.

    ``observation`` receives the written row count (``rows``). It is taken
    after the range shuffle, so the partitioner's sampling pass over the
    input does not count.

    ``cluster_by``: the time column, then tie-breakers (e.g. the id). Range
    bounds are taken over all of them, so one timestamp (or NULL) holding a
    third of the rows is still split over many tasks.

    ``range_partitioned``: ``df`` is already range-partitioned on the
    clustering time (e.g. by an upstream step that needed that shuffle
    anyway); only the local sort is added.

    ``checks``: row tests whose failures are counted by this write, at the same
    place as ``observation``.

    ``bloom``: columns by which rows are looked up beside the clustering (with
    the distinct values to expect in a row group). Files sorted by time hold
    every station in each row group, whose min and max then say nothing; a Bloom
    filter per row group lets a station slice pass over those without it.
    """
    out = _clustered(df, partition_by, cluster_by, partitions, range_partitioned)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    if checks is not None:
        out = checks.attach(out)
    w = out.write.mode(mode)
    w = w.option("compression", compression)
    for column, values in (bloom or {}).items():
        w = w.option(f"parquet.bloom.filter.enabled#{column}", "true")
        w = w.option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
    if full_refresh:
        w = w.option("partitionOverwriteMode", "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.partitionBy(*partition_by).parquet(path)
    return path


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition folders ``<path>/<column>=...``, from the listing alone."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{column}="))


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    """Delete the partition folders of ``values``: dynamic overwrite replaces
    partitions that have new rows, and leaves those that have none any more."""
    for value in values:
        folder, files = _folder(spark, f"{path}/{column}={value}")
        files.delete(folder, True)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with header (no row-index column)."""
    df.write.mode(mode).option("header", "true").csv(path)
    return path


def publish_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    cluster_by: str | Sequence[str] | None = None,
    mode: str = "overwrite",
    partitions: int | None = None,
) -> str:
    """Replace a catalog table (drop-and-load), partitioned and clustered."""
    w = _clustered(df, partition_by, cluster_by, partitions).write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return name


def _versions(spark: SparkSession, name: str) -> list[str]:
    """The versions of a published name, oldest first."""
    database, _, table = name.rpartition(".")
    inside = f" IN {database}" if database else ""
    head = f"{table}{_VERSION}"
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES{inside}").select("tableName").collect()]
    numbers = sorted(int(t[len(head) :]) for t in found if t.startswith(head) and t[len(head) :].isdigit())
    return [f"{name}{_VERSION}{n}" for n in numbers]


def _current(spark: SparkSession, name: str) -> str | None:
    """The version that ``name`` points to; None if there is no such name."""
    if not spark.catalog.tableExists(name):
        return None
    told = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == _POINTS_TO).collect()
    if not told:
        raise ValueError(f"{name} exists and is not a published name")
    return told[0]["value"]


def publish_version(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    cluster_by: str | Sequence[str] | None = None,
    partitions: int | None = None,
    range_partitioned: bool = False,
    audit: Callable[[DataFrame], None] | None = None,
    keep: int = 1,
) -> str:
    """Publish ``df`` as a new version of ``name`` and return the version's table.

    Readers use ``name``, a catalog view over one version. The version is a
    table with files of its own: it is loaded in full, then ``audit`` (if any)
    gets it and may raise, and only then the view is replaced, which is one
    catalog operation. At every moment ``name`` gives a whole version; a load or
    an audit that fails drops its own version and changes nothing else.

    ``keep`` versions before the new one stay for readers that have already
    begun; older ones, and those that a lost driver left behind, are dropped.
    A name has one loader at a time.
    """
    spark = df.sparkSession
    now = _current(spark, name)
    before = _versions(spark, name)
    number = int(before[-1].rpartition(_VERSION)[2]) + 1 if before else 1
    version = f"{name}{_VERSION}{number}"
    w = _clustered(df, partition_by, cluster_by, partitions, range_partitioned).write.mode("errorifexists").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.saveAsTable(version)
        # By name and in the order of df, so that a read gives its columns back.
        table = spark.table(version).select(*[F.col(f"`{c}`") for c in df.columns])
        if audit is not None:
            audit(table)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_POINTS_TO}' = '{version}') AS SELECT {columns} FROM {version}"
    )
    stay = before[: before.index(now) + 1][-keep:] if now in before and keep else []
    for old in before:
        if old not in stay:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    return version


def create_view(df: DataFrame, name: str) -> str:
    """Lazy model: a temporary view, evaluated inside every query using it."""
    df.createOrReplaceTempView(name)
    return name
