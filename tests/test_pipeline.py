"""Golden test of the observation pipeline on small hand-written files
(cases of FIXTURES.md): text -> clean -> star schema -> fact -> checks."""

import datetime as dt
import hashlib

import pytest

from stationlake.plans import weather
from stationlake.sources import read_parquet

D = dt.datetime

HEADER = "STATIONS_ID;MESS_DATUM;QN_3;  FX;  FM;QN_4; RSK;RSKF; SDK;SHK_TAG;  NM; VPM;  PM; TMK; UPM; TXK; TNK; TGK;eor"
# FX and FM swapped, one column more.
HEADER_SWAPPED = "STATIONS_ID;MESS_DATUM;QN_3;  FM;  FX;QN_4; RSK;RSKF; SDK;SHK_TAG;  NM; VPM;  PM; TMK; UPM; TXK; TNK; TGK;extra;eor"

RECENT_44 = "\n".join(
    [
        HEADER,
        "   44;20230101;   10;  12.3;   4.1;    3;   0.5;   6;   2.5;   0; 7.0;  6.2; 1003.4;   1.1;  95.00;   2.4;  -0.5;  -1.2;eor",
        "   44;20230102;    1;  10.0;   3.0;    3;   1.0;   4;   2.5; 300; 8/8;  6.0; 1000.0;   2.0;  90.00;   3.0;   1.0;   0.0;eor",
        "   44;20230231;    1;  10.0;   3.0;    3;   1.0;   4;   2.5;   0;   1;  6.0; 1000.0;   2.0;  90.00;   3.0;   1.0;   0.0;eor",
    ]
) + "\n"
HIST_44 = "\n".join(
    [
        HEADER,
        "   44;20230101;   10;  12.3;   4.1;    5;   0.5;   6;   2.5;   0; 7.0;  6.2; 1003.4;   9.9;  95.00;   2.4;  -0.5;  -1.2;eor",
        "   44;19160501;    1;  10.0;   3.0;    3;   1.0;   4;   2.5;   0;   1;  6.0; 1000.0;   2.0;  90.00;   3.0;   1.0;   0.0;eor",
    ]
) + "\n"
RECENT_123456 = "\n".join(
    [
        HEADER_SWAPPED,
        "123456;20230101;    1;   3.0;  10.0;    3;   0.0;   0;   0.0;   0; 1/8;  5.0; 1010.0;   3.0;  80.00;   4.0;   2.0;   1.0;x;eor",
    ]
) + "\n"
RECENT_12345 = "\n".join(
    [
        HEADER,
        "12345;20230101;-999;-999;-999;-999;-999;-999;-999;-999;-999;-999;-999;-999;-999;-999;-999;-999;eor",
    ]
) + "\n"

GEO_44 = "\n".join(
    [
        "Stations_id;Stationshoehe;Geogr.Breite;Geogr.Laenge;von_datum;bis_datum;Stationsname",
        "         44;     44.00;  52.9336;   8.2370;20070401;20221231;Großenkneten",
        "         44;     44.00;  52.9336;   8.2371;20230101;        ;Großenkneten Neu",
    ]
) + "\n"
GEO_123456 = "\n".join(
    [
        "Stations_id;Stationshoehe;Geogr.Breite;Geogr.Laenge;von_datum;bis_datum;Stationsname",
        "     123456;     10.00;  50.0;   7.0;20200101;20231231;Alpha",
        "     123456;     11.00;  50.1;   7.1;20221201;        ;Beta",
    ]
) + "\n"
OPERATOR_44 = (
    "Stationsname / Betreibername\r\n\r\nStations_ID;Betreibername;Von_Datum;Bis_Datum\r\n"
    "          44;Deutscher Wetterdienst;20070401;        \r\n"
    "generiert: 01.01.2024 --  Deutscher Wetterdienst  --\r\n"
)


def _put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


@pytest.fixture(scope="module")
def raw_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    _put(root / "recent/tables/produkt_klima_tag_20220101_20231231_00044.txt", RECENT_44, "latin-1")
    _put(root / "recent/tables/produkt_klima_tag_20220101_20231231_123456.txt", RECENT_123456, "latin-1")
    _put(root / "recent/tables/produkt_klima_tag_20220101_20231231_12345.txt", RECENT_12345, "latin-1")
    _put(root / "historical/tables/produkt_klima_tag_19160101_20230101_00044.txt", HIST_44, "latin-1")
    _put(root / "recent/metadata/Metadaten_Geographie_00044.txt", GEO_44, "latin-1")
    _put(root / "historical/metadata/Metadaten_Geographie_123456.txt", GEO_123456, "latin-1")
    _put(root / "recent/metadata/Metadaten_Stationsname_Betreibername_00044.txt", OPERATOR_44, "latin-1")
    return root


COUNTS: dict = {}


@pytest.fixture(scope="module")
def built(spark, raw_root, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    paths = weather.run_raw(spark, str(raw_root), str(out / "raw"), counts=COUNTS)
    fact_path, report = weather.run_marts(spark, paths, str(out / "marts"))
    return paths, fact_path, report


def test_observed_counts(built):
    assert COUNTS == {"main": 7, "metadata_geo": 4, "metadata_operator": 1}


def _key(station, ts):
    return hashlib.md5(f"{station}-{ts:%Y-%m-%d %H:%M:%S}+00".encode()).hexdigest()


def test_raw_measurements(spark, built):
    paths, _, _ = built
    raw = read_parquet(spark, paths["main"], {"year": "string"})
    rows = {(r.stations_id, r.mess_datum, r.category, r.year) for r in raw.collect()}
    assert ("00044", D(2022, 12, 31, 23), "recent", "2023") in rows
    assert ("00044", D(2022, 12, 31, 23), "historical", "2023") in rows
    assert ("00044", None, "historical", "1916") in rows  # non-existent midnight
    assert ("00044", None, "recent", None) in rows  # 20230231
    assert ("123456", D(2022, 12, 31, 23), "recent", "2023") in rows
    assert raw.count() == 7


def test_fact_golden(spark, built):
    _, fact_path, _ = built
    fact = spark.read.parquet(fact_path)
    rows = sorted(fact.collect(), key=lambda r: (r.station_id, r.dt_measurement_utc, r.station_name or ""))
    got = [
        (
            r.station_id,
            r.dt_measurement_utc,
            r.station_name,
            r.operator_name,
            r.lat_long,
            r.quality_niveau_4,
            r.max_wind_gust_mps_qn3,
            r.mean_wind_velocity_mps_qn3,
            r.mean_temperature_2m_c_qn4,
            r.sunshine_duration_h_qn4,
            r.snow_depth_cm_qn4,
            r.mean_cloud_coverage_qn4,
            r.month,
        )
        for r in rows
    ]
    assert got == [
        # historical row wins the duplicate day; interval start is inclusive
        ("00044", D(2022, 12, 31, 23), "Großenkneten Neu", "Deutscher Wetterdienst", "52.9336,8.2371", 5, 12.3, 4.1, 9.9, 3, 0, "7.0", "2022-12"),
        # sunshine 2.5 rounds to 3; snow depth above 255 kept
        ("00044", D(2023, 1, 1, 23), "Großenkneten Neu", "Deutscher Wetterdienst", "52.9336,8.2371", 3, 10.0, 3.0, 2.0, 3, 300, "8/8", "2023-01"),
        # all sentinels -> NULL; no history -> NULL attributes
        ("12345", D(2022, 12, 31, 23), None, None, None, None, None, None, None, None, None, None, "2022-12"),
        # columns bound by name in a file with swapped order; overlapping
        # location intervals give two rows; no operator history
        ("123456", D(2022, 12, 31, 23), "Alpha", None, "50.0,7.0", 3, 10.0, 3.0, 3.0, 0, 0, "1/8", "2022-12"),
        ("123456", D(2022, 12, 31, 23), "Beta", None, "50.1,7.1", 3, 10.0, 3.0, 3.0, 0, 0, "1/8", "2022-12"),
    ]
    ids = {r.station_id: r.measurement_id for r in rows}
    assert ids["00044"] in {_key("00044", D(2022, 12, 31, 23)), _key("00044", D(2023, 1, 1, 23))}


def test_quality_report_on_fact(built):
    _, _, report = built
    got = {(r.check_name, r.column_name): (r.failures, r.status) for r in report.collect()}
    assert got[("unique", "measurement_id")] == (1, "warn")  # fan-out of 123456
    assert got[("relationships", "station_id->dim_geo")] == (1, "warn")  # 12345
    assert got[("relationships", "station_id->dim_operator")] == (3, "warn")
    assert got[("accepted_values", "quality_niveau_3")] == (0, "pass")
    assert got[("not_null", "dt_measurement_utc")] == (0, "pass")


def test_rerun_replaces(spark, built, raw_root, tmp_path_factory):
    paths, _, _ = built
    before = spark.read.parquet(paths["main"]).count()
    weather.run_raw(spark, str(raw_root), paths["main"].rsplit("/", 1)[0])
    assert spark.read.parquet(paths["main"]).count() == before


def test_operator_rejects_missing_marker(spark, raw_root, tmp_path):
    bad = raw_root / "recent/metadata/Metadaten_Stationsname_Betreibername_99999.txt"
    try:
        bad.write_bytes(b"kein Marker\r\n")
        rows, rejects = weather.fetch_operator(spark, str(raw_root))
        assert rows.count() == 1
        assert rejects.count() == 1
    finally:
        bad.unlink()


def test_fact_analytics(spark, built):
    _, fact_path, _ = built
    fact = spark.read.parquet(fact_path)
    top = weather.station_year_max(fact).collect()
    # years of the UTC timestamp; highest first, NULL last
    assert [(r.station_id, r.year, r.max_value) for r in top] == [
        ("123456", 2022, 4.0),
        ("00044", 2023, 3.0),
        ("00044", 2022, 2.4),
        ("12345", 2022, None),
    ]
    assert [r.year for r in weather.years_since(fact).collect()] == [2023, 2022]
    assert weather.hottest_days(fact, 2).count() == 2


def test_publish_table_and_slice(spark, built):
    from stationlake.operators import time_slice
    from stationlake.sinks import publish_table

    _, fact_path, _ = built
    fact = spark.read.parquet(fact_path)
    publish_table(fact, "fact_measurements", ["month"], cluster_by="dt_measurement_utc")
    t = spark.table("fact_measurements")
    assert t.count() == 5
    jan = time_slice(t, "dt_measurement_utc", "2023-01-01", "2023-02-01", partition_col="month")
    assert jan.count() == 1
    publish_table(fact, "fact_measurements", ["month"], cluster_by="dt_measurement_utc")
    assert spark.table("fact_measurements").count() == 5


def test_staging_test_run(spark, built):
    paths, _, _ = built
    main, _, _ = weather.read_raw(spark, paths)
    full = weather.stg_measurements(main)
    sample = weather.stg_measurements(main, test_run=True)
    assert sample.count() == full.count() == 4  # fewer than the 100-row cap
    assert [r.measurement_id for r in sample.collect()] == sorted(r.measurement_id for r in full.collect())


def test_run_all(spark, raw_root, tmp_path):
    res = weather.run_all(spark, str(raw_root), str(tmp_path / "all"))
    assert res["rows"]["main"] == 7
    statuses = {(r["check_name"], r["column_name"]): r["status"] for r in res["report"]}
    assert statuses[("unique", "measurement_id")] == "warn"
    assert "fail" not in statuses.values()
    assert spark.read.parquet(res["paths"]["fact"]).count() == 5


def test_fact_build_shuffles_once(spark, built):
    from planutil import plan_text

    paths, _, _ = built
    fact, _, _ = weather.build_fact(spark, paths)
    plan = plan_text(fact.sortWithinPartitions("month", "dt_measurement_utc"), "simple")
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert len(exchanges) == 1 and "rangepartitioning" in exchanges[0], plan
    assert plan.count("BroadcastHashJoin") == 2


def test_sql_over_view_matches_functions(spark, built):
    from stationlake.sinks import create_view

    _, fact_path, _ = built
    fact = spark.read.parquet(fact_path)
    create_view(fact, "temps")
    by_sql = spark.sql(
        "SELECT station_id, extract(year FROM dt_measurement_utc) AS year, "
        "max(max_temperature_2m_c_qn4) AS max_value FROM temps GROUP BY 1, 2 ORDER BY 3 DESC"
    )
    assert sorted(map(tuple, by_sql.collect()), key=str) == sorted(
        map(tuple, weather.station_year_max(fact).collect()), key=str
    )
    years = spark.sql(
        "SELECT DISTINCT extract(year FROM dt_measurement_utc) AS year FROM temps "
        "WHERE to_date(dt_measurement_utc) >= '1900-01-01' ORDER BY 1 DESC"
    )
    assert [r.year for r in years.collect()] == [r.year for r in weather.years_since(fact).collect()]


def test_pipeline_straight_from_archives(spark, raw_root, built, tmp_path):
    import io
    import zipfile

    # one archive per category with every file of its folders, plus an .html member
    for category in ("recent", "historical"):
        (tmp_path / category / "download").mkdir(parents=True)
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            for f in (raw_root / category).glob("*/*.txt"):
                zf.write(f, f.name)
            zf.writestr("Metadaten_Geraete_00044.html", "<html/>")
        (tmp_path / category / "download" / "tageswerte_KL.zip").write_bytes(buf.getvalue())
    archived = weather.measurements_from_archives(spark, str(tmp_path))
    unpacked = weather.fetch_measurements(spark, str(raw_root))
    assert archived.count() == unpacked.count() == 7
    assert archived.exceptAll(unpacked.select(*archived.columns)).count() == 0

    paths = weather.run_raw(spark, str(tmp_path), str(tmp_path / "out" / "raw"), from_archives=True)
    fact_path, _ = weather.run_marts(spark, paths, str(tmp_path / "out" / "marts"))
    _, golden_path, _ = built
    a, b = spark.read.parquet(fact_path), spark.read.parquet(golden_path)
    assert a.count() == b.count() == 5
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_listing_links_and_fetch_selection(spark):
    pages = spark.createDataFrame(
        [
            ("recent", '<a href="tageswerte_KL_00044_akt.zip">z</a><a href="DESCRIPTION.pdf">d</a><a href="../">up</a>'),
            ("historical", '<a href="tageswerte_KL_00044_hist.zip">z</a><a href="DESCRIPTION.pdf">d</a>'),
        ],
        "category string, html string",
    )
    links = weather.listing_links(pages)
    assert links.count() == 4
    stored = spark.createDataFrame([("DESCRIPTION.pdf",)], "href string")
    todo = sorted(r.href for r in weather.links_to_fetch(links.select("href"), stored).collect())
    assert todo == ["tageswerte_KL_00044_akt.zip", "tageswerte_KL_00044_hist.zip"]


def test_independent_jobs_at_once():
    """Results in order, all jobs under way together, an error raised."""
    import threading

    from stationlake.session import at_once

    both = threading.Barrier(2, timeout=20)
    assert at_once(lambda: (both.wait(), 1)[1], lambda: (both.wait(), 2)[1]) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        at_once(lambda: 1 / 0, lambda: 3)


def test_long_generated_methods_are_not_interpreted(spark):
    """The JVM compiles no method over 8,000 bytes: stages beyond that run operator by operator."""
    from stationlake.session import configure

    configure(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000
