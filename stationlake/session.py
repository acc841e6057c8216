"""Spark session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# SQL settings every job relies on. They are runtime-settable, so they can be
# applied to a session someone else built (``configure``).
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Observation files reach back before 1900 (Julian/Gregorian switch).
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    # Long texts go to Python workers in small batches (Spark bounds a batch's bytes at 64 MiB too).
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # The JVM compiles no method above this size: a stage whose generated loop is longer (many
    # parsed or localised columns) would be interpreted. It runs operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Re-running a load replaces only the partitions it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    master: str | None = "local[*]",
    app: str = "stationlake",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for jobs and tests. On a cluster pass ``master=None``: shuffle
    partitions and memory are then what the cluster's configuration says."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SQL_CONF)
    conf.update(
        {
            "spark.ui.enabled": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        }
    )
    if master:
        shuffle_partitions, driver_memory = shuffle_partitions or 8, driver_memory or "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SQL_CONF`` to an existing session."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach: under ``spark.checkpoint.dir``.

    The cluster names that folder; it is read from the session. Only when it
    is unset on a local master (tests, laptops) is a fresh one created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    base = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="stationlake-"))
        base = sc.getCheckpointDir()
    return "/".join([base.rstrip("/"), *parts])


def at_once(*jobs: Callable) -> list:
    """Results of independent jobs, submitted from driver threads of their own: a
    small one uses the slots that a large one leaves idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the plan) and makes the row count a metadata read. ``partition_by``: rows
    that are read apart lie in folders of their own.
    """
    path = shared_dir(df.sparkSession, "materialized", f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    if not partition_by:
        writer.parquet(path)
        return df.sparkSession.read.parquet(path)
    writer.partitionBy(*partition_by).parquet(path)
    # The schema is known: folders may be missing, and their names are not guessed at.
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize_counted(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), **counts: Column
) -> tuple[DataFrame, dict]:
    """``materialize`` plus row counts observed during the write (``rows``
    and any named aggregate in ``counts``), so no second job counts them."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()]]
    out = materialize(df.observe(obs, *metrics), name, partition_by)
    return out, obs.get


def release(df: DataFrame) -> None:
    """Delete the files of a ``materialize`` result that nothing reads any more.

    Only what lies in the shared folder's own place for such tables is deleted,
    and only when its successors are written: a lost executor re-reads those.
    """
    spark = df.sparkSession
    own = shared_dir(spark, "materialized") + "/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if own.split(":", 1)[-1].lstrip("/") in folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
