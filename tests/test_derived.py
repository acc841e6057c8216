"""The files derived from events: formatted without a formatter call per row, as before."""

import datetime as dt

from pyspark.sql import functions as F

from planutil import plan_text
from stationlake.plans import derived, queries, weather


def events(spark):
    day = dt.datetime(2024, 1, 16)
    rows = [
        (1, day, 7, "error", 1.5, None),
        (2, day + dt.timedelta(days=2), 7, "error", 2.5, None),
        (3, day, None, "error", None, None),
        (4, None, 123456789012, "error", 0.5, None),
        (None, day, -3, "error", 0.5, None),
    ]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def test_station_cells_and_operator_lines(spark, tmp_path):
    ev = events(spark)
    lines = derived.measurement_lines(ev)
    assert "format_string" not in plan_text(lines, "simple")
    want = ev.select(F.format_string("%11d", "user_id").alias("s")).collect()
    assert sorted(r.STATIONS_ID for r in lines.collect()) == sorted(r.s for r in want)

    derived.write_raw_from_events(ev, str(tmp_path / "raw"))
    files = [f.read_bytes() for f in (tmp_path / "raw/recent/metadata").glob("*.txt")]
    head = b"Stationsname / Betreibername\r\n\r\nStations_ID;Betreibername;Von_Datum;Bis_Datum\r\n"
    assert all(f.startswith(head) and f.endswith(b"generiert: footer\r\n") for f in files)
    got = sorted(x for f in files for x in f[len(head) :].split(b"\r\n") if x not in (b"", b"generiert: footer"))
    assert got == sorted(
        [
            b"          7;Operator 1;20240116;20240117",
            b"          7;Operator 2;20240118;",
            b"       null;Operator 3;20240116;",
            b"123456789012;Operator 4;null;",
            b"         -3;Operator null;20240116;",
        ]
    )


def test_refreshed_batches_are_parsed_once(spark, tmp_path, monkeypatch):
    """The recent files are delivered twice; each refresh gets written rows, no lines to parse."""
    events(spark).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    refresh = weather.refresh_months

    def spy(spark, rows, *args, **options):
        seen.append(plan_text(rows, "simple"))
        return refresh(spark, rows, *args, **options)

    monkeypatch.setattr(weather, "refresh_months", spy)
    months = spark.read.parquet(queries._refreshed(spark, str(tmp_path)) + "/month_summary").collect()
    assert sorted((r.month, r.n_rows) for r in months) == [("2024-01", 4)]
    assert len(seen) == 3 and not any("split(" in p for p in seen)
