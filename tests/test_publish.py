"""Versions behind a name: readers always find a whole one."""

import uuid

import pytest
from pyspark.sql import functions as F

from stationlake.sinks import create_view, publish_table, publish_version
from stationlake.sources.tables import read_table


def tables(spark, name):
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(name))


@pytest.fixture
def name(spark):
    return f"t_{uuid.uuid4().hex[:12]}"


def frame(spark, label, n=6):
    return spark.range(n).select(
        F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("month"), "id", F.lit(label).alias("label")
    )


def test_versions_follow_each_other(spark, name):
    for i in range(1, 5):
        version = publish_version(frame(spark, f"load {i}", n=i), name, ["month"], cluster_by="id")
        assert version == f"{name}__v{i}"
        got = read_table(spark, name)
        assert got.columns == ["month", "id", "label"] and got.count() == i
        assert {r.label for r in got.collect()} == {f"load {i}"}
        # The version before stays for readers that have begun, older ones go.
        assert tables(spark, name) == sorted([name, *(f"{name}__v{v}" for v in (i - 1, i) if v)])
    publish_version(frame(spark, "last"), name, keep=0)
    assert tables(spark, name) == [name, f"{name}__v5"]


def test_reader_that_has_begun_keeps_its_rows(spark, name):
    publish_version(frame(spark, "old"), name)
    reader = read_table(spark, name)
    reader.first()
    publish_version(frame(spark, "new"), name)
    assert {r.label for r in reader.collect()} <= {"old", "new"} and reader.count() == 6
    assert {r.label for r in read_table(spark, name).collect()} == {"new"}


def test_failed_load_leaves_the_old_rows(spark, name):
    publish_version(frame(spark, "old"), name, ["month"])
    broken = frame(spark, "new").withColumn("id", F.when(F.col("id") == 5, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="bad row"):
        publish_version(broken, name, ["month"])
    assert {r.label for r in read_table(spark, name).collect()} == {"old"}
    assert tables(spark, name) == [name, f"{name}__v1"]
    publish_version(frame(spark, "new"), name, ["month"])
    assert {r.label for r in read_table(spark, name).collect()} == {"new"}


def test_failed_audit_is_never_visible(spark, name):
    publish_version(frame(spark, "old"), name)

    def audit(version):
        assert version.count() == 6 and version.first().label == "new"
        assert {r.label for r in read_table(spark, name).collect()} == {"old"}
        raise ValueError("declared test failed")

    with pytest.raises(ValueError, match="declared test"):
        publish_version(frame(spark, "new"), name, audit=audit)
    assert {r.label for r in read_table(spark, name).collect()} == {"old"} and tables(spark, name) == [name, f"{name}__v1"]


def test_first_load_that_fails_makes_no_name(spark, name):
    with pytest.raises(ValueError):
        publish_version(frame(spark, "x"), name, audit=lambda v: (_ for _ in ()).throw(ValueError("no")))
    assert tables(spark, name) == []


def test_version_from_itself_and_empty_version(spark, name):
    publish_version(frame(spark, "a"), name, ["month"])
    publish_version(read_table(spark, name).withColumn("label", F.lit("b")), name, ["month"])
    assert {r.label for r in read_table(spark, name).collect()} == {"b"}
    publish_version(frame(spark, "none").limit(0), name, ["month"])
    assert read_table(spark, name).count() == 0 and read_table(spark, name).columns == ["month", "id", "label"]


def test_names_in_a_database_and_names_taken(spark, name):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS db_{name}")
    publish_version(frame(spark, "a"), f"db_{name}.fact", ["month"])
    publish_version(frame(spark, "b"), f"db_{name}.fact", ["month"])
    assert {r.label for r in read_table(spark, f"db_{name}.fact").collect()} == {"b"}
    publish_table(frame(spark, "plain"), name)
    with pytest.raises(ValueError, match="not a published name"):
        publish_version(frame(spark, "c"), name)
    assert {r.label for r in read_table(spark, name).collect()} == {"plain"}
    create_view(frame(spark, "v"), f"{name}_view")


def test_month_slice_of_a_published_name_prunes(spark, name):
    from planutil import plan_text

    publish_version(frame(spark, "a"), name, ["month"])
    plan = plan_text(read_table(spark, name).filter("month = '2024-02'"))
    assert "PartitionFilters: [isnotnull(month" in plan
