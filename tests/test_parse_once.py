"""Measurement lines are staged whole and parsed once."""

import datetime as dt

from planutil import plan_text
from stationlake.plans import weather
from stationlake.sources import read_delimited

def test_measurements_are_parsed_before_the_range_shuffle(spark, tmp_path, monkeypatch):
    """A range shuffle passes over its input twice: it gets rows that are written, not lines to parse."""
    for category in ("recent", "historical"):
        (tmp_path / category / "tables").mkdir(parents=True)
        (tmp_path / category / "tables" / "a.txt").write_text("STATIONS_ID;MESS_DATUM;  FX\n   44;20240101; 1.5\n   44;20240102;-999\n")
        (tmp_path / category / "metadata").mkdir()
        (tmp_path / category / "metadata" / "Metadaten_Geographie_1.txt").write_text("Stations_id;von_datum;bis_datum\n44;20240101;\n")
        (tmp_path / category / "metadata" / "Metadaten_Stationsname_Betreibername_1.txt").write_text(
            "x\n\nStations_ID;Betreibername;Von_Datum;Bis_Datum\n 44;W;20240101;\nfooter\n"
        )
    seen = {}
    write = weather.write_partitioned

    def spy(df, path, *args, **options):
        seen[path.rsplit("/", 1)[-1]] = plan_text(df, "simple")
        return write(df, path, *args, **options)

    monkeypatch.setattr(weather, "write_partitioned", spy)
    counts = {}
    paths = weather.run_raw(spark, str(tmp_path), str(tmp_path / "out"), counts=counts)
    assert counts["main"] == 4
    assert "FileScan parquet" in seen["main"] and "split(" not in seen["main"] and "from_utc_timestamp" not in seen["main"]
    rows = weather.read_raw(spark, paths)[0].select("stations_id", "mess_datum", "fx", "category").collect()
    assert sorted((r.stations_id, r.mess_datum, r.fx, r.category) for r in rows) == [
        ("00044", dt.datetime(2023, 12, 31, 23), 1.5, "historical"),
        ("00044", dt.datetime(2023, 12, 31, 23), 1.5, "recent"),
        ("00044", dt.datetime(2024, 1, 1, 23), None, "historical"),
        ("00044", dt.datetime(2024, 1, 1, 23), None, "recent"),
    ]


def test_lines_are_staged_whole(spark, tmp_path):
    (tmp_path / "a.txt").write_text("STATIONS_ID;  FX\n 1; -999 \n 2;;x\n3\n")
    df = read_delimited(spark, str(tmp_path), {"STATIONS_ID": "string", "  FX": "string"}, "STATIONS_ID")
    assert "line:string" in plan_text(df, "simple")
    assert sorted((r.stations_id, r.fx) for r in df.collect()) == [("1", None), ("2", ""), ("3", None)]
