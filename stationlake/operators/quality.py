"""Data-quality checks as Spark jobs and one combined report.

Each ``check_*`` returns the failing values (or rows). ``quality_report``
turns a list of checks into one row per check: name, column, severity,
failure count, status. Only the report (one row per check) ever reaches the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values occurring more than once: (value, n_rows)."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is NULL."""
    return df.filter(F.col(column).isNull())


def check_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child values without a parent: (value, n_rows).

    The child is reduced to one row per value first (partial aggregation),
    so a value held by a third of the child rows is one row in the
    anti-join, and the parent side is reduced to distinct keys.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(F.col(parent_column).alias("__parent")).distinct()
    return keys.join(parents, F.col(column) == F.col("__parent"), "left_anti")


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    failing: DataFrame
    severity: str = "error"  # "warn" reports, "error" fails the job
    count_rows: bool = False  # failures = sum(n_rows) instead of row count


def _failures(check: Check) -> DataFrame:
    if check.count_rows:
        n = F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long")
    else:
        n = F.count(F.lit(1)).cast("long")
    return check.failing.agg(n.alias("failures")).select(
        F.lit(check.name).alias("check_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        "failures",
    )


def row_checks(
    df: DataFrame,
    not_null: Sequence[tuple[str, str]] = (),
    accepted: Sequence[tuple[str, Sequence, str]] = (),
) -> DataFrame:
    """Row-level checks of one table in two passes instead of one per check.

    ``not_null``: (column, severity) pairs, counted in one global
    aggregation. ``accepted``: (column, values, severity) triples; every
    column's outside values are stacked into (check, value) pairs, reduced to
    distinct pairs (partial aggregation) and counted per check. Rows in the
    report schema of ``quality_report`` (without status).
    """
    parts = []
    if not_null:
        counts = df.agg(
            *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"n{i}") for i, (c, _) in enumerate(not_null)]
        )
        for i, (c, sev) in enumerate(not_null):
            parts.append(
                counts.select(
                    F.lit("not_null").alias("check_name"),
                    F.lit(c).alias("column_name"),
                    F.lit(sev).alias("severity"),
                    F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("long").alias("failures"),
                )
            )
    if accepted:
        pairs = F.array(
            *[
                F.struct(
                    F.lit(i).alias("check"),
                    F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(values)), F.col(c).cast("string")).alias("value"),
                )
                for i, (c, values, _) in enumerate(accepted)
            ]
        )
        bad = (
            df.select(F.inline(pairs))
            .filter(F.col("value").isNotNull())
            .distinct()
            .groupBy("check")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        meta = df.sparkSession.createDataFrame(
            [(i, c, sev) for i, (c, _, sev) in enumerate(accepted)], "check int, column_name string, severity string"
        )
        # ``bad`` has at most one row per accepted-values check.
        parts.append(
            meta.join(F.broadcast(bad), "check", "left")
            .select(
                F.lit("accepted_values").alias("check_name"),
                "column_name",
                "severity",
                F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("failures"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ObservedChecks:
    """Not-null and accepted-value tests counted while their rows are written.

    ``attach`` adds the counters to the rows; when an action has run over them,
    ``report`` gives one row per test in the schema of ``quality_report``, without
    reading anything again. The counters see every row that passes them, so they
    belong behind the last step that may run twice (a range shuffle's sampling):
    directly before a write. ``failures`` are rows, for both sorts of tests.
    """

    def __init__(
        self,
        not_null: Sequence[tuple[str, str]] = (),
        accepted: Sequence[tuple[str, Sequence, str]] = (),
        name: str = "checks",
    ):
        self.tests = [("not_null", c, sev) for c, sev in not_null] + [("accepted_values", c, sev) for c, _, sev in accepted]
        conditions = [F.col(f"`{c}`").isNull() for c, _ in not_null]
        # NULL passes: it is neither in the list nor outside it.
        conditions += [F.coalesce(~F.col(f"`{c}`").isin(list(v)), F.lit(False)) for c, v, _ in accepted]
        self.counters = [F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions)]
        self.seen = Observation(name)

    def attach(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *self.counters)

    @property
    def rows(self) -> int:
        return self.seen.get["rows"]

    def report(self, spark: SparkSession) -> DataFrame:
        found = self.seen.get
        rows = [(name, c, sev, int(found[f"c{i}"])) for i, (name, c, sev) in enumerate(self.tests)]
        return spark.createDataFrame(rows, "check_name string, column_name string, severity string, failures long")


def quality_report(checks: Sequence[Check], reports: Sequence[DataFrame] = ()) -> DataFrame:
    """One row per check with status pass / warn / fail. ``reports`` are
    already-counted rows (e.g. from ``row_checks``)."""
    rows = [_failures(c) for c in checks] + list(reports)
    report = rows[0]
    for r in rows[1:]:
        report = report.unionByName(r)
    status = (
        F.when(F.col("failures") == 0, F.lit("pass"))
        .when(F.col("severity") == "warn", F.lit("warn"))
        .otherwise(F.lit("fail"))
    )
    return report.withColumn("status", status)


def raise_on_error(report: DataFrame) -> list:
    """Collect the (small) report; raise when an error-severity check fails."""
    rows = report.collect()
    failed = [r for r in rows if r["status"] == "fail"]
    if failed:
        raise AssertionError(f"quality checks failed: {[r.asDict() for r in failed]}")
    return rows
