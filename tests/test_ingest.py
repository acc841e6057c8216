"""One-scan header binding, quarantine and sections over many splits."""

import random

import pytest
from pyspark.sql import functions as F

from planutil import plan_text
from stationlake.operators import quarantine
from stationlake.sources import read_delimited, read_delimited_checked, read_sectioned
from stationlake.sources.delimited import bind_by_header, read_lines
from stationlake.sources.sections import numbered_lines, sectioned_rows

COLUMNS = {"STATIONS_ID": "string", "  FX": "double", "RSKF": "int"}


@pytest.fixture
def small_splits(spark):
    """Files are cut into splits of a few bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "256b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_text_is_scanned_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text("STATIONS_ID;  FX\n 1;2.5\n")
    df = read_delimited(spark, str(tmp_path), COLUMNS, "STATIONS_ID")
    plan = plan_text(df, "simple")
    assert "csv" not in plan.lower() and "FileScan parquet" in plan
    # The header rows are a folder of their own.
    assert plan.count("kind#") and "PartitionFilters: [isnotnull(kind" in plan_text(df, "simple")
    assert [(r.stations_id, r.fx, r.rskf) for r in df.collect()] == [("1", 2.5, None)]


def test_headers_over_the_bound_are_shuffled(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.txt").write_text("STATIONS_ID;  FX\n" * 2 + f"{i};1\n" if i % 2 else f"  FX;STATIONS_ID\n1;{i}\n")
    lines = read_lines(spark, str(tmp_path))
    few = bind_by_header(lines, COLUMNS, "STATIONS_ID")
    many = bind_by_header(lines, COLUMNS, "STATIONS_ID", max_broadcast_files=0)
    assert "BroadcastHashJoin" in plan_text(few, "simple")
    rows = sorted((r.stations_id, r.fx) for r in few.collect())
    assert rows == sorted((r.stations_id, r.fx) for r in many.collect()) == [(str(i), 1.0) for i in range(4)]


def test_header_in_another_split(small_splits, tmp_path):
    """A file of many splits is bound by the header in its first one."""
    rows = [f"{i};{i}.5;{i}" for i in range(200)]
    (tmp_path / "a.txt").write_text("STATIONS_ID;  FX;RSKF\n" + "\n".join(rows) + "\n")
    (tmp_path / "b.txt").write_text("RSKF;  FX;STATIONS_ID\n" + "\n".join(";".join(reversed(r.split(";"))) for r in rows) + "\n")
    assert read_lines(small_splits, str(tmp_path)).rdd.getNumPartitions() > 10
    got = sorted((r.stations_id, r.fx, r.rskf) for r in read_delimited(small_splits, str(tmp_path), COLUMNS, "STATIONS_ID").collect())
    assert got == sorted((str(i), i + 0.5, i) for i in range(200) for _ in "ab")


def test_lines_are_judged(spark, tmp_path):
    (tmp_path / "a.txt").write_text(
        "STATIONS_ID;  FX;RSKF;DAY\n 1; 2.5;3;20240229\n2;-999;-999;20240101\n3;n/a;1;20240101\n4;1;20240101\n5;1;2;20240101;x\n"
        ";1;2;20240101\n7;1;2;20230229\n8;1;2;\n9;;;20240101\n-999;1;1;20240101\n\n  \n10;1;2.5;20240101\n"
    )
    (tmp_path / "no_header.txt").write_text("1;2;3;20240101\n")
    (tmp_path / "empty.txt").write_text("")
    from stationlake.functions import parse_yyyymmdd

    found = read_delimited_checked(
        spark, str(tmp_path), {**COLUMNS, "DAY": "string"}, "STATIONS_ID", required=["day"],
        valid={"day": parse_yyyymmdd("day").isNotNull()},
    )
    assert sorted((r.stations_id, r.fx, r.rskf, r.day) for r in found.rows.collect()) == [
        ("1", 2.5, 3, "20240229"), ("2", None, None, "20240101"), ("9", None, None, "20240101"),
    ]
    assert sorted((r.line, r.reason, r.file.rsplit("/", 1)[-1]) for r in found.rejects.collect()) == sorted([
        ("3;n/a;1;20240101", "bad value in fx", "a.txt"),
        ("4;1;20240101", "wrong number of cells", "a.txt"),
        ("5;1;2;20240101;x", "wrong number of cells", "a.txt"),
        (";1;2;20240101", "no value in stations_id", "a.txt"),
        ("7;1;2;20230229", "bad value in day", "a.txt"),
        ("8;1;2;", "no value in day", "a.txt"),
        ("-999;1;1;20240101", "no value in stations_id", "a.txt"),
        ("10;1;2.5;20240101", "bad value in rskf", "a.txt"),
        ("1;2;3;20240101", "no header line", "no_header.txt"),
    ])
    assert found.counts == {"rows": 3, "rejects": 9}


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "r", "b"), (2, "r", None)], "id int, reason string, line string")
    q = quarantine(df, "t", ["line", "reason"])
    assert sorted(r.id for r in q.rows.collect()) == [1, 1] and q.rows.columns == ["id"]
    assert sorted((str(r.line), r.reason) for r in q.rejects.collect()) == [("None", "r"), ("b", "r")]
    none = quarantine(df.limit(0), "t", ["line", "reason"])
    assert none.counts == {"rows": 0, "rejects": 0} and none.rows.count() == none.rejects.count() == 0


@pytest.mark.parametrize("marker", ["\n\nH;I\n ", "x\nH;I\n ", "x\n\nH;I\nx", "\nH;I\n"])
def test_sections_over_splits_equal_whole_texts(small_splits, tmp_path, marker):
    """Random files, read in splits of a few bytes, against the text as a whole."""
    r = random.Random(marker)
    lines = ["", "", "H;I", "H;I", " a;b", "x", "xx", "x c;d;e", "footer", "Ämter;ü", " ", "H;I "]
    head = marker.split("\n")
    for i in range(24):
        body = [r.choice(lines) for _ in range(r.randrange(0, 60))]
        for _ in range(r.randrange(0, 3)):
            at = r.randrange(0, len(body) + 1)
            body[at:at] = ["y" + head[0], *head[1:-1], head[-1] + "1;2"]
        end = r.choice(["\n", "\r\n"])
        text = end.join(body) + r.choice(["", end, end * 2])
        (tmp_path / f"{i}.txt").write_bytes(text.encode("latin-1"))
    whole = small_splits.read.format("binaryFile").load(str(tmp_path)).select(
        F.col("_metadata.file_path").alias("file"), F.decode("content", "ISO-8859-1").alias("text")
    )
    want, bad = sectioned_rows(whole, marker, ["a", "b"])
    got, rejects = read_sectioned(small_splits, str(tmp_path), marker, ["a", "b"])
    rows = sorted(map(str, got.collect()))
    assert rows == sorted(map(str, want.collect())) and len(rows) > 20
    assert sorted(x.file for x in rejects.collect()) == sorted(x.file for x in bad.collect())


def test_line_numbers_have_no_gaps(small_splits, tmp_path):
    texts = {f"{i}.txt": [f"line {i} {j}" for j in range(i * 40)] for i in range(4)}
    for name, body in texts.items():
        (tmp_path / name).write_text("\r\n".join(body))
    got = {}
    for x in numbered_lines(small_splits, str(tmp_path)).collect():
        got.setdefault(x.file.rsplit("/", 1)[-1], []).append((x.nr, x.line))
    assert {k: sorted(v) for k, v in got.items()} == {k: list(enumerate(v)) for k, v in texts.items() if v}
    with pytest.raises(ValueError):
        read_sectioned(small_splits, str(tmp_path), "no line end", ["a"])
