"""Incremental ingest: each run takes only the files not seen before."""


from stationlake.sources import read_parquet
from stationlake.streaming import ingest_new_measurements

from test_pipeline import RECENT_12345, RECENT_123456, RECENT_44


def test_incremental_ingest_reads_only_new_files(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", tmp_path / "out", tmp_path / "ckpt"
    src.mkdir()
    (src / "produkt_klima_tag_44.txt").write_text(RECENT_44)
    (src / "produkt_klima_tag_123456.txt").write_text(RECENT_123456)
    ingest_new_measurements(spark, str(src), str(out), checkpoint=str(ckpt), max_files_per_trigger=1)
    first = read_parquet(spark, str(out), {"year": "string"})
    assert first.count() == 4
    assert first.select("batch").distinct().count() == 2  # one file per batch

    (src / "produkt_klima_tag_12345.txt").write_text(RECENT_12345)
    ingest_new_measurements(spark, str(src), str(out), checkpoint=str(ckpt))
    second = read_parquet(spark, str(out), {"year": "string"})
    assert second.count() == 5
    assert {r.stations_id for r in second.filter("stations_id = '12345'").collect()} == {"12345"}
    # nothing new: a third run adds nothing
    ingest_new_measurements(spark, str(src), str(out), checkpoint=str(ckpt))
    assert read_parquet(spark, str(out)).count() == 5


def test_retried_batch_replaces_its_output(spark, tmp_path):
    from pyspark.sql import functions as F

    from stationlake.sources.delimited import read_lines
    from stationlake.streaming.incremental import write_measurement_batch

    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "produkt_klima_tag_44.txt").write_text(RECENT_44)
    lines = read_lines(spark, str(src))
    write_measurement_batch(lines, 7, str(out))
    write_measurement_batch(lines, 7, str(out))  # the same batch again
    assert read_parquet(spark, str(out)).count() == 3
    new = lines.filter(F.col("line").contains("20230102") | F.col("line").contains("STATIONS_ID"))
    write_measurement_batch(new, 8, str(out))
    assert read_parquet(spark, str(out)).count() == 4
