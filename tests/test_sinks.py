"""Writers: unpartitioned and year-month Parquet, CSV with header."""

from pyspark.sql import functions as F

from sfdirs import SF0001
from stationlake.functions import year_month
from stationlake.sinks import write_csv, write_partitioned
from stationlake.sources import read_parquet


def test_unpartitioned_and_year_month(spark, tmp_path):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    plain = write_partitioned(ev, str(tmp_path / "plain"), [])
    assert spark.read.parquet(plain).count() == ev.count()
    by_month = write_partitioned(
        ev.withColumn("year_month", year_month(F.col("ts"))), str(tmp_path / "ym"), ["year_month"], cluster_by=["ts", "event_id"]
    )
    back = read_parquet(spark, by_month, {"year_month": "string"})
    assert back.count() == ev.count()
    assert {r.year_month for r in back.select("year_month").distinct().collect()} == {"2024-01"}


def test_csv_has_header_and_no_index(spark, tmp_path):
    df = spark.createDataFrame([("00044", 1.5)], "stations_id string, v double")
    path = write_csv(df, str(tmp_path / "csv"))
    files = [p.read_text().splitlines() for p in (tmp_path / "csv").glob("*.csv")]
    assert all(lines[0] == "stations_id,v" for lines in files if lines)  # header per file
    assert [line for lines in files for line in lines[1:]] == ["00044,1.5"]  # no index column
    assert spark.read.schema("stations_id string, v double").option("header", "true").csv(path).first().stations_id == "00044"
