"""Dedup, effective-dated joins, quality checks, slices."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from planutil import plan_text
from stationlake.operators import (
    Check,
    check_accepted_values,
    check_not_null,
    check_relationships,
    check_unique,
    effective_dated_join,
    intervals_from_starts,
    keep_first,
    quality_report,
    total_order,
)

D = dt.datetime


def test_keep_first_total_order(spark):
    df = spark.createDataFrame(
        [(1, D(2020, 1, 1), "b"), (1, D(2020, 1, 2), "a"), (1, D(2020, 1, 2), "c"), (None, D(2020, 1, 1), "x")],
        "k long, t timestamp_ntz, v string",
    )
    out = keep_first(df, ["k"], total_order(df, ["k"], first=[("t", True)])).collect()
    assert [(r.k, r.v) for r in out] == [(1, "a")]


def _fact_dim(spark):
    fact = spark.createDataFrame(
        [
            ("s1", D(2020, 1, 1)),  # equals start of A: inclusive
            ("s1", D(2020, 1, 31)),  # equals end of A: inclusive
            ("s1", D(2020, 2, 15)),  # in the gap: no match
            ("s1", D(2021, 6, 1)),  # open interval C
            ("s2", D(2020, 1, 5)),  # overlapping B1 and B2: two rows
            ("s3", D(2020, 1, 5)),  # no history
        ],
        "station_id string, ts timestamp_ntz",
    )
    dim = spark.createDataFrame(
        [
            ("s1", "A", D(2020, 1, 1), D(2020, 1, 31)),
            ("s1", "C", D(2020, 3, 1), None),
            ("s2", "B1", D(2019, 12, 1), D(2020, 2, 1)),
            ("s2", "B2", D(2020, 1, 1), None),
        ],
        "station_id string, name string, start timestamp_ntz, end timestamp_ntz",
    )
    return fact, dim


EXPECTED = sorted(
    [
        ("s1", D(2020, 1, 1), "A"),
        ("s1", D(2020, 1, 31), "A"),
        ("s1", D(2020, 2, 15), None),
        ("s1", D(2021, 6, 1), "C"),
        ("s2", D(2020, 1, 5), "B1"),
        ("s2", D(2020, 1, 5), "B2"),
        ("s3", D(2020, 1, 5), None),
    ],
    key=str,
)


def test_effective_join_broadcast(spark):
    fact, dim = _fact_dim(spark)
    j = effective_dated_join(fact, dim, "station_id", "ts", "start", "end")
    assert sorted([(r.station_id, r.ts, r.name) for r in j.collect()], key=str) == EXPECTED
    assert "BroadcastHashJoin" in plan_text(j)


def test_effective_join_swept_matches(spark):
    fact, dim = _fact_dim(spark)
    j = effective_dated_join(fact, dim, "station_id", "ts", "start", "end", max_broadcast_rows=0)
    assert sorted([(r.station_id, r.ts, r.name) for r in j.collect()], key=str) == EXPECTED


def test_intervals_from_starts_matches_window_lead(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter("event_type = 'signup'")
    got = intervals_from_starts(ev, "user_id", "ts", extra=["event_id"], tiebreak=["event_id"])
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = ev.select(
        "user_id", "event_id", F.col("ts").alias("start"),
        (F.lead("ts").over(w) - F.expr("INTERVAL '0.000001' SECOND")).alias("end"),
    )
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_quality_report_statuses(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (9, "z")], "k long, v string")
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    rep = quality_report(
        [
            Check("unique", "k", check_unique(child, "k"), "warn"),
            Check("not_null", "v", check_not_null(child, "v"), "warn"),
            Check("relationships", "k", check_relationships(child, "k", parent, "k"), "warn", count_rows=True),
            Check("accepted_values", "v", check_accepted_values(child, "v", ["a", "b", "z"])),
            Check("accepted_values", "v2", check_accepted_values(child, "v", ["a"])),
        ]
    ).collect()
    got = [(r.check_name, r.failures, r.status) for r in rep]
    assert got == [
        ("unique", 1, "warn"),
        ("not_null", 1, "warn"),
        ("relationships", 1, "warn"),
        ("accepted_values", 0, "pass"),
        ("accepted_values", 2, "fail"),
    ]


def test_row_checks_match_single_checks(spark):
    from stationlake.operators import row_checks

    df = spark.createDataFrame(
        [(1, "a", 3), (None, "b", 3), (2, None, 7), (3, "q", 7), (4, "q", 8)], "k long, v string, c int"
    )
    fused = quality_report([], [row_checks(df, [("k", "warn"), ("v", "warn")], [("v", ["a", "b"], "error"), ("c", [3, 7, 8], "error")])])
    got = sorted((r.check_name, r.column_name, r.failures, r.status) for r in fused.collect())
    assert got == [
        ("accepted_values", "c", 0, "pass"),
        ("accepted_values", "v", 1, "fail"),  # one distinct bad value: 'q'
        ("not_null", "k", 1, "warn"),
        ("not_null", "v", 1, "warn"),
    ]


def test_swept_join_without_timestamps(spark):
    fact, dim = _fact_dim(spark)
    empty = fact.filter("ts is null")
    j = effective_dated_join(empty, dim, "station_id", "ts", "start", "end", max_broadcast_rows=0)
    assert j.count() == 0 and "name" in j.columns
    nulls = fact.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    j = effective_dated_join(nulls, dim, "station_id", "ts", "start", "end", max_broadcast_rows=0)
    assert j.count() == fact.count() and j.filter("name is not null").count() == 0


def test_raise_on_error_only_for_error_severity(spark):
    import pytest

    from stationlake.operators import raise_on_error

    df = spark.createDataFrame([("a",), ("z",)], "v string")
    warn_only = quality_report([Check("accepted_values", "v", check_accepted_values(df, "v", ["a"]), "warn")])
    assert [r.status for r in raise_on_error(warn_only)] == ["warn"]
    failing = quality_report([Check("accepted_values", "v", check_accepted_values(df, "v", ["a"]))])
    with pytest.raises(AssertionError, match="accepted_values"):
        raise_on_error(failing)


def test_choose_bucket_from_span(spark):
    from stationlake.operators.effective import choose_bucket

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")  # about a month
    assert choose_bucket(ev, "ts") == "minute"
    days = spark.sql("select explode(sequence(date'1781-01-01', date'2030-12-31')) as d").selectExpr(
        "cast(d as timestamp_ntz) as ts"
    )
    assert choose_bucket(days, "ts") == "day"


def test_large_history_path_skips_reversed_intervals(spark):
    """An interval that ends before it starts matches nothing, on either path."""
    fact = spark.sql("SELECT 'a' k, timestamp_ntz'2024-03-05 00:00:00' ts UNION ALL SELECT 'b', timestamp_ntz'2024-01-01 00:00:00'")
    dim = spark.sql(
        "SELECT 'a' k, timestamp_ntz'2024-03-10 00:00:00' s, timestamp_ntz'2024-01-02 00:00:00' e, 1 v "
        "UNION ALL SELECT 'a', timestamp_ntz'2024-02-01 00:00:00', NULL, 2"
    )
    from stationlake.operators.effective import effective_dated_join

    got = [
        sorted(map(str, effective_dated_join(fact, dim, "k", "ts", "s", "e", max_broadcast_rows=n).collect())) for n in (100, 0)
    ]
    assert got[0] == got[1] and "v=2" in got[0][0]
