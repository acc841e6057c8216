"""A key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sfdirs import SF001
from stationlake.operators import effective_dated_join, intervals_from_starts, keep_first, total_order


def _skewed_events(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    # every third event moves to user 0
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def test_hot_key_history_equals_single_window(spark):
    ev = _skewed_events(spark).filter("event_type in ('signup', 'error')")
    got = intervals_from_starts(ev, ["user_id", "event_type"], "ts", extra=["event_id"], tiebreak=["event_id"])
    w = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    want = ev.select(
        "user_id", "event_type", "event_id", F.col("ts").alias("start"),
        (F.lead("ts").over(w) - F.expr("INTERVAL '0.000001' SECOND")).alias("end"),
    )
    assert got.count() == want.count() == ev.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_hot_key_join_paths_agree(spark):
    ev = _skewed_events(spark)
    hist = intervals_from_starts(
        ev.filter("event_type = 'signup'"), "user_id", "ts", extra=["event_id"], tiebreak=["event_id"]
    ).withColumnRenamed("event_id", "geo_event_id")
    fact = ev.select("event_id", "user_id", "ts")
    a = effective_dated_join(fact, hist, "user_id", "ts", "start", "end")
    b = effective_dated_join(fact, hist, "user_id", "ts", "start", "end", max_broadcast_rows=0)
    assert a.count() == b.count() == fact.count()
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_hot_key_dedup(spark):
    ev = _skewed_events(spark).withColumn("day", F.to_date("ts"))
    out = keep_first(ev, ["user_id", "day"], total_order(ev, ["user_id", "day"], first=[("ts", True)]))
    assert out.count() == ev.select("user_id", "day").distinct().count()
    hot = out.filter("user_id = 0").agg(F.count(F.lit(1)).alias("n")).first().n
    assert hot == ev.filter("user_id = 0").select("day").distinct().count()
