"""Months refreshed alone, the ledger, total order, checks inside the write, Bloom filters, quarantine of the raw run."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from planutil import plan_text
from stationlake.operators import ObservedChecks, quality_report, with_position, write_ordered
from stationlake.plans import weather
from stationlake.sinks import write_partitioned
from stationlake.sources import Ledger

RAW = (
    "stations_id string, mess_datum timestamp, qn_3 short, fx double, fm double, qn_4 short, rsk double, rskf short, sdk double, "
    "shk_tag int, nm string, vpm double, pm double, tmk double, upm double, txk double, tnk double, tgk double, category string, year string"
)


def raw(spark, rows):
    """(station, day, value, quality) -> clean measurement rows."""
    full = []
    for station, day, value, quality in rows:
        ts = None if day is None else dt.datetime.fromisoformat(day)
        full.append((station, ts, 10, value, None, quality, None, 0, None, None, None, None, None, value, None, None, None, None, "recent", day and day[:4]))
    return spark.createDataFrame(full, RAW)


def histories(spark):
    geo = spark.createDataFrame(
        [("a", 1.0, "1", "2", dt.datetime(2000, 1, 1), None, "A"), ("b", 2.0, "3", "4", dt.datetime(2000, 1, 1), None, "B")],
        "station_id string, station_height_m double, latitude string, longitude string, dt_geo_start timestamp_ntz, dt_geo_end timestamp_ntz, station_name string",
    )
    op = spark.createDataFrame(
        [("a", "O", dt.datetime(2000, 1, 1), None)], "station_id string, operator_name string, dt_op_start timestamp_ntz, dt_op_end timestamp_ntz"
    )
    return geo, op


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_late_row_changes_one_month(spark, tmp_path):
    out, dims = str(tmp_path / "out"), histories(spark)
    first = [(s, f"2023-{m:02d}-{d:02d}", 1.0 * m, 3) for s in "ab" for m in range(1, 7) for d in (1, 15)]
    assert weather.refresh_months(spark, raw(spark, first), out, *dims, batch=0) == [f"2023-{m:02d}" for m in range(1, 7)]
    before = files(f"{out}/fact_measurements")
    late = [("a", "2023-03-15", 99.0, 10), ("c", "2023-03-16", 5.0, 1), ("a", None, 1.0, 1)]
    for _ in range(2):  # delivered twice
        assert weather.refresh_months(spark, raw(spark, late), out, *dims, batch=1) == ["2023-03"]
    after = files(f"{out}/fact_measurements")
    same = {f for f in before if before[f] == after.get(f)}
    assert {f.split("month=")[1][:7] for f in set(before) - same} == {"2023-03"}
    assert {f.split("month=")[1][:7] for f in same} == {f"2023-{m:02d}" for m in (1, 2, 4, 5, 6)}
    fact = spark.read.parquet(f"{out}/fact_measurements")
    march = {(r.station_id, r.dt_measurement_utc.day): r.max_wind_gust_mps_qn3 for r in fact.where("month = '2023-03'").collect()}
    assert march == {("a", 1): 3.0, ("a", 15): 99.0, ("b", 1): 3.0, ("b", 15): 3.0, ("c", 16): 5.0}
    assert fact.count() == 25 and spark.read.parquet(f"{out}/raw_measurements").count() == 26
    summary = {r.month: (r.n_rows, r.max_temperature) for r in spark.read.parquet(f"{out}/month_summary").collect()}
    assert summary == {f"2023-{m:02d}": (5 if m == 3 else 4, None) for m in range(1, 7)}
    # A batch that shrinks takes its rows back; an empty one touches nothing.
    assert weather.refresh_months(spark, raw(spark, [("c", "2023-03-16", 6.0, 1)]), out, *dims, batch=1) == ["2023-03"]
    assert weather.refresh_months(spark, raw(spark, []), out, *dims, batch=2) == []
    march = {(r.station_id, r.dt_measurement_utc.day): r.max_wind_gust_mps_qn3 for r in spark.read.parquet(f"{out}/fact_measurements").where("month = '2023-03'").collect()}
    assert march == {("a", 1): 3.0, ("a", 15): 3.0, ("b", 1): 3.0, ("b", 15): 3.0, ("c", 16): 6.0}
    # One that moves to another month leaves nothing behind; a month without rows goes.
    assert weather.refresh_months(spark, raw(spark, [("d", "2024-07-01", 7.0, 1)]), out, *dims, batch=1) == ["2023-03", "2024-07"]
    assert weather.refresh_months(spark, raw(spark, []), out, *dims, batch=1) == ["2024-07"]
    fact = spark.read.parquet(f"{out}/fact_measurements")
    assert fact.count() == 24 and fact.where("station_id in ('c', 'd')").count() == 0
    assert sorted(r.month for r in spark.read.parquet(f"{out}/month_summary").collect()) == [f"2023-{m:02d}" for m in range(1, 7)]


def test_ledger_lists_nothing_twice(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.entries().count() == 0
    links = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "href string")
    assert {r.href for r in ledger.pending(links.dropna()).collect()} == {"a", "b", "c"}
    for _ in range(2):
        ledger.record(links.where("href < 'c'"), 7)
    ledger.record(links, 8)  # names of an earlier batch stay with it
    assert sorted(map(tuple, Ledger(spark, str(tmp_path / "ledger")).entries().collect())) == [("a", 7), ("b", 7), ("c", 8)]
    assert ledger.pending(links.dropna()).count() == 0 and ledger.stored().count() == 3
    ledger.record(links.limit(0), 9)
    assert ledger.entries().count() == 3


def test_positions_are_gapless(spark):
    rows = [(i % 5 if i % 7 else None, "s" if i % 2 else None, i) for i in range(400)] + [(1, "same", 0)] * 300
    df = spark.createDataFrame(rows, "a int, b string, position int").repartition(7).drop("position")
    got = [(r.position, r.a, r.b) for r in with_position(df, [("a", True), ("b", False)]).collect()]
    got.sort()
    assert [p for p, *_ in got] == list(range(1, 701))
    want = sorted(((a, b) for a, b, _ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    assert [(a, b) for _, a, b in got] == want
    assert with_position(df.limit(0), [("a", True)]).count() == 0


def test_files_follow_the_order(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(6)
    path = write_ordered(df, str(tmp_path / "o"), [("v", True)])
    names = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    found = [r.v for f in names for r in spark.read.parquet(f"{path}/{f}").coalesce(1).collect()]
    assert found == list(range(4999, -1, -1))


def test_checks_are_counted_by_the_write(spark, tmp_path):
    rows = [(1, 5, "x"), (None, 4, "x"), (None, None, "y"), (4, 99, None), (4, 99, "z")]
    df = spark.createDataFrame(rows, "id int, code int, c0 string")
    checks = ObservedChecks([("id", "warn"), ("c0", "error")], [("code", [4, 5], "error"), ("c0", ["x", "y", "z"], "warn")])
    path = write_partitioned(df, str(tmp_path / "t"), [], cluster_by=["id", "code"], checks=checks)
    report = quality_report([], [checks.report(spark)])
    got = {(r.check_name, r.column_name): (r.failures, r.severity, r.status) for r in report.collect()}
    assert got == {
        ("not_null", "id"): (2, "warn", "warn"), ("not_null", "c0"): (1, "error", "fail"),
        ("accepted_values", "code"): (2, "error", "fail"), ("accepted_values", "c0"): (0, "warn", "pass"),
    }
    assert checks.rows == 5 == spark.read.parquet(path).count()
    none = ObservedChecks([("id", "warn")])
    write_partitioned(df.limit(0), str(tmp_path / "e"), [], checks=none)
    assert none.rows == 0 and none.report(spark).first().failures == 0


def scanned(df):
    """Rows that the scan below ``df`` has given out."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    rows = df.collect()
    leaves = plan.collectLeaves() if plan.nodeName() != "AdaptiveSparkPlan" else plan.executedPlan().collectLeaves()
    return len(rows), sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_station_slice_passes_over_row_groups(spark, tmp_path):
    """Each file holds a time range with few of the stations between the lowest and the highest."""
    df = spark.range(20_000).select((F.col("id") * 104_729 % 1_000_003).alias("station"), "id", F.lit("m").alias("month"))
    plain = write_partitioned(df, str(tmp_path / "p"), ["month"], cluster_by="id", partitions=20)
    bloom = write_partitioned(df, str(tmp_path / "b"), ["month"], cluster_by="id", partitions=20, bloom={"station": 2000})
    station = 777 * 104_729 % 1_000_003
    n, every = scanned(spark.read.parquet(plain).where(F.col("station") == station))
    m, few = scanned(spark.read.parquet(bloom).where(F.col("station") == station))
    assert n == m == 1 and few < every / 4


def test_raw_run_with_quarantine(spark, tmp_path):
    from stationlake.schemas import GEO_COLUMNS, MEASUREMENT_COLUMNS

    head = ";".join([*MEASUREMENT_COLUMNS, "eor"])
    good = "   44;20230101;10;1.0;1.0;3;0.5;6;2.5;0;5.3;6.1;1000.1;3.2;80;7.1;-1;-2;eor"
    lines = [head, good, good.replace("20230101", "        "), good + ";x", good.replace(";1.0;", ";n/a;", 1), good.replace("20230101", "20230102")]
    for c in ("recent", "historical"):
        (tmp_path / c / "tables").mkdir(parents=True)
        (tmp_path / c / "metadata").mkdir()
        geo = ";".join(GEO_COLUMNS) + "\n 44;1;2;3;20000101;;Größe\n"
        (tmp_path / c / "metadata" / "Metadaten_Geographie_44.txt").write_bytes(geo.encode("latin-1"))
    (tmp_path / "recent" / "tables" / "produkt_klima_tag_44.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "historical" / "tables" / "produkt_klima_tag_45.txt").write_text(head + "\n" + good + "\n")
    meta = tmp_path / "recent" / "metadata" / "Metadaten_Stationsname_Betreibername_{}.txt"
    (tmp_path / "recent" / "metadata" / meta.name.format(44)).write_text("x\n\nStations_ID;Betreibername;Von_Datum;Bis_Datum\n 44;O;20000101;\nend\n")
    (tmp_path / "recent" / "metadata" / meta.name.format(99)).write_text("no table\n")
    with pytest.raises(ValueError, match="without its marker"):
        weather.run_raw(spark, str(tmp_path), str(tmp_path / "out"))
    counts = {}
    paths = weather.run_raw(spark, str(tmp_path), str(tmp_path / "out"), counts, quarantine=True)
    got = sorted((r.dataset, r.category or "", r.reason) for r in spark.read.parquet(paths["rejects"]).collect())
    assert got == [
        ("main", "recent", "bad value in fx"), ("main", "recent", "no value in mess_datum"),
        ("main", "recent", "wrong number of cells"), ("metadata_operator", "", "no marker line"),
    ]
    assert counts == {"main": 3, "metadata_geo": 2, "metadata_operator": 1, "rejects": 4}


def test_published_marts_and_a_failed_refresh(spark, tmp_path):
    """Names that readers use: a load with bad codes is reported and never visible."""
    from stationlake.plans.derived import RICH, write_raw_from_events

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    prefix = f"m{uuid.uuid4().hex[:8]}_"
    globs = write_raw_from_events(events, str(tmp_path / "a"))
    paths = weather.run_raw(spark, str(tmp_path / "a"), str(tmp_path / "ca"), globs=globs)
    names = weather.publish_marts(spark, paths, prefix)
    before = spark.table(names["fact_measurements"]).count()
    months = plan_text(spark.table(names["raw_measurements"]).filter("month = '2024-01'"))
    assert before > 0 and "PartitionFilters: [isnotnull(month" in months
    globs = write_raw_from_events(events, str(tmp_path / "b"), RICH)
    rich = weather.run_raw(spark, str(tmp_path / "b"), str(tmp_path / "cb"), globs=globs)
    with pytest.raises(AssertionError, match="quality checks failed"):
        weather.publish_marts(spark, rich, prefix)
    assert spark.table(names["fact_measurements"]).count() == before
    report = {(r.model, r.check_name, r.column_name): r for r in spark.table(names["quality_report"]).collect()}
    assert report["stg_measurements", "accepted_values", "quality_niveau_4"].status == "fail"
    assert report["stg_measurements", "not_null", "station_id"].status == "pass"


def test_local_days_at_the_edges(spark):
    """Every local day of a slice, and no other, whatever the session zone and the UTC month."""
    from stationlake.functions import localize, obs_date, utc_of_local_day
    from stationlake.operators import local_day_slice

    days = spark.sql("SELECT explode(sequence(DATE'2023-12-25', DATE'2024-11-05', INTERVAL 1 DAY)) AS day")
    zone = spark.conf.get("spark.sql.session.timeZone")
    for session in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", session)
        try:
            df = days.withColumn("ts", localize(F.col("day").cast("timestamp_ntz"))).withColumn("month", F.date_format("ts", "yyyy-MM"))
            assert df.where(obs_date(F.col("ts")) != F.col("day")).count() == 0
            for first, last in (("2024-01-01", "2024-01-31"), ("2024-03-31", "2024-04-01"), ("2024-10-27", "2024-10-28"), ("2024-02-29", "2024-02-29")):
                got = [str(r.day) for r in local_day_slice(df, "ts", first, last, partition_col="month").orderBy("day").collect()]
                assert got == [str(r.day) for r in df.where(F.col("day").between(first, last)).orderBy("day").collect()] and got
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
    assert utc_of_local_day(dt.date(2024, 1, 1)) == dt.datetime(2023, 12, 31, 23)
