"""Semantics of the column functions."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from stationlake.functions import (
    cast_int_rounded,
    clean_column_names,
    try_cast_columns,
    clean_station_id,
    concat_nullable,
    decode_codes,
    localize,
    local_year,
    null_sentinel,
    parse_yyyymmdd,
    surrogate_key,
)


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (3.5,), (2.4,), (None,)], "x double")
    got = [r.y for r in df.select(cast_int_rounded("x").alias("y")).collect()]
    assert got == [3, -3, 4, 2, None]


def test_pad_never_shortens(spark):
    df = spark.createDataFrame([("  44",), ("1234",), ("12345",), (" 123456",), (None,)], "s string")
    got = [r.y for r in df.select(clean_station_id("s").alias("y")).collect()]
    assert got == ["00044", "01234", "12345", "123456", None]


def test_parse_invalid_dates_are_null(spark):
    df = spark.createDataFrame([("20230231",), ("20240229",), (" 19370101 ",), ("x",), (None,)], "s string")
    got = [r.d for r in df.select(parse_yyyymmdd("s").alias("d")).collect()]
    assert got == [None, dt.datetime(2024, 2, 29), dt.datetime(1937, 1, 1), None, None]


def test_localize_dst_edges(spark):
    days = ["1892-05-01", "1916-10-01", "1914-11-08", "1916-05-01", "2023-01-01", "2023-07-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(
        F.col("d"), F.to_date("d").cast("timestamp_ntz").alias("l")
    )
    got = {r.d: r.u for r in df.select("d", localize(F.col("l")).alias("u")).collect()}
    # Ambiguous (1892-05-01, 1916-10-01) and non-existent (1914-11-08,
    # 1916-05-01) local midnights are NULL.
    assert got["1892-05-01"] is None
    assert got["1916-10-01"] is None
    assert got["1914-11-08"] is None
    assert got["1916-05-01"] is None
    assert got["2023-01-01"] == dt.datetime(2022, 12, 31, 23, 0)
    assert got["2023-07-01"] == dt.datetime(2023, 6, 30, 22, 0)


def test_localize_does_not_depend_on_session_zone(spark):
    df = spark.sql(
        "select explode(sequence(date'1890-01-01', date'1925-12-31')) as d"
    ).select(F.col("d").cast("timestamp_ntz").alias("l"))
    a = df.select("l", localize(F.col("l")).alias("u")).collect()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        b = df.select("l", localize(F.col("l")).alias("u")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert a == b
    assert sum(r.u is None for r in a) == 4


def test_local_year_before_shift(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1),)], "l timestamp_ntz")
    r = df.select(local_year(F.col("l")).alias("y"), localize(F.col("l")).alias("u")).first()
    assert r.y == "2023" and r.u.year == 2022


def test_sentinel_on_text_before_cast(spark):
    df = spark.createDataFrame([(" -999", "-999"), ("  12", " 3/8")], "a string, nm string")
    got = df.select(
        null_sentinel("a").try_cast("short").alias("a"), null_sentinel("nm").alias("nm")
    ).collect()
    assert [tuple(r) for r in got] == [(None, None), (12, "3/8")]


def test_surrogate_key_text(spark):
    df = spark.createDataFrame(
        [("00044", dt.datetime(2022, 12, 31, 23, 0)), (None, dt.datetime(2022, 12, 31, 23, 0))],
        "s string, t timestamp_ntz",
    )
    got = [r.k for r in df.select(surrogate_key(df, ["s", "t"]).alias("k")).collect()]
    assert got[0] == hashlib.md5(b"00044-2022-12-31 23:00:00+00").hexdigest()
    assert got[1] == hashlib.md5(b"_dbt_utils_surrogate_key_null_-2022-12-31 23:00:00+00").hexdigest()


def test_concat_propagates_null(spark):
    df = spark.createDataFrame([("52.1", "8.2"), ("52.1", None)], "a string, b string")
    got = [r.c for r in df.select(concat_nullable(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got == ["52.1,8.2", None]


def test_decode_unknown_is_null(spark):
    df = spark.createDataFrame([(1,), (6,), (7,), (None,)], "c int")
    got = [r.l for r in df.select(decode_codes("c").alias("l")).collect()]
    assert got == ["Credit card", "Voided trip", None, None]


def test_parse_matches_try_to_date(spark):
    # every day number 00-39 of every month 00-13 in leap and common years,
    # plus malformed text
    rows = [(f"{y}{m:02d}{d:02d}",) for y in (1900, 2000, 2023, 2024, 1) for m in range(14) for d in range(40)]
    rows += [("2024021",), ("202402011",), ("2024-2-1",), ("abcdefgh",), ("",), ("00010101",)]
    df = spark.createDataFrame(rows, "s string")
    got = df.select("s", parse_yyyymmdd("s").alias("a"),
                    F.expr("cast(try_to_date(s, 'yyyyMMdd') as timestamp_ntz)").alias("b"))
    bad = got.filter("not (a <=> b)").collect()
    assert bad == []


def test_clean_names_and_cast_map(spark):
    df = spark.createDataFrame([("44", " 12", "x")], "`STATIONS_ID` string, `  SHK_TAG` string, `Geogr.Breite` string")
    df = clean_column_names(df, {"geogr.breite": "geogr_breite"})
    assert df.columns == ["stations_id", "shk_tag", "geogr_breite"]
    r = try_cast_columns(df.withColumn("shk_tag", F.trim("shk_tag")), {"shk_tag": "int", "geogr_breite": "double"}).first()
    assert (r.shk_tag, r.geogr_breite) == (12, None)
