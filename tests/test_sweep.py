"""The interval sweep against pairwise comparison, its hand-over, and the fact's layout."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stationlake.operators.sweep import sweep_join

FACT = "k string, ts timestamp_ntz, id long"
DIM = "k string, s timestamp_ntz, e timestamp_ntz, name string"
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def pairwise(facts, dims, outer=True):
    out = []
    for k, ts, i in facts:
        hits = [n for dk, s, e, n in dims if None not in (k, ts, dk, s) and dk == k and s <= ts and (e is None or ts <= e)]
        out += [(k, ts, i, n) for n in hits or ([None] if outer else [])]
    return sorted(out, key=repr)


def swept(spark, facts, dims, how="left", parts=7):
    out = sweep_join(
        spark.createDataFrame(facts, FACT).repartition(3), spark.createDataFrame(dims, DIM).repartition(2), "k", "ts", "s", "e", how
    )
    assert out.columns == ["k", "ts", "id", "s", "e", "name"]
    return sorted(((r.k, r.ts, r.id, r.name) for r in out.collect()), key=repr)


@pytest.fixture
def fine(spark):
    """Many small range partitions, none merged: keys straddle their borders."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(3))
def test_sweep_equals_pairwise(fine, seed):
    r = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    facts = [(r.choice(keys), at(r.choice([None, *range(300)] if r.random() < 0.1 else [r.randrange(300)])), i) for i in range(900)]
    dims = []
    for i in range(160):
        s = r.choice([None, *range(300)])
        e = None if r.random() < 0.15 else (s or 0) + r.randrange(-5, 120)
        dims.append((r.choice(keys), at(s), at(e), f"n{i}"))
    facts += facts[:40]  # repeated rows, and ends that touch
    dims += dims[:10]
    assert swept(fine, facts, dims) == pairwise(facts, dims)
    assert swept(fine, facts, dims, "inner") == pairwise(facts, dims, outer=False)


def test_sweep_without_rows(spark):
    one, span = [("a", at(1), 1)], [("a", at(0), None, "n")]
    assert swept(spark, [], span) == []
    assert swept(spark, one, []) == [("a", at(1), 1, None)]
    assert swept(spark, [(None, None, 1)], span) == [(None, None, 1, None)]
    assert swept(spark, one, [("a", at(3), at(0), "reversed")]) == [("a", at(1), 1, None)]


def test_one_instant_holds_all_facts(fine):
    """One time of one key fills many partitions; each is handed what is open."""
    facts = [("a", at(5), i) for i in range(4000)]
    dims = [("a", at(0), None, "open"), ("a", at(5), at(5), "point"), ("a", at(1), at(4), "over"), ("a", at(6), None, "later")]
    got = swept(fine, facts, dims)
    assert len(got) == 8000 and {n for *_, n in got} == {"open", "point"}


def test_key_with_100000_intervals_in_a_month(fine):
    """As many intervals as facts, all of one key and one month: pairs of them
    would be 10^10, the result is a row or two per fact."""
    n = 100_000
    minute = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 26.0)")
    facts = fine.range(n).select(F.lit("a").alias("k"), minute.alias("ts"), "id")
    dims = fine.range(n).select(
        F.lit("a").alias("k"), minute.alias("s"), (minute + F.expr("INTERVAL 30 SECONDS")).alias("e"), F.col("id").alias("span")
    )
    out = sweep_join(facts, dims, "k", "ts", "s", "e")
    assert out.agg(F.count("*"), F.count("span"), F.sum(F.col("id") - F.col("span"))).first() == (2 * n - 1, 2 * n - 1, n - 1)


def test_types_and_clashing_names(spark):
    """Column types survive, a name may be on both sides, times of other types are compared."""
    fact = spark.sql("SELECT 7L AS k, DATE'2024-01-05' AS ts, CAST(1.5 AS DECIMAL(8, 2)) AS v, array(1, NULL) AS pid, 'x' AS f, map('a', 1) AS m")
    dim = spark.sql("SELECT 7 AS k, TIMESTAMP_NTZ'2024-01-05 00:00:00' AS s, CAST(NULL AS TIMESTAMP_NTZ) AS e, 'd' AS d, 3S AS n, true AS kind")
    out = sweep_join(fact, dim, "k", "ts", "s", "e")
    assert dict(out.dtypes) == {**dict(fact.dtypes), **{c: t for c, t in dim.dtypes if c != "k"}}
    r = out.first()
    assert (r.k, r.v, r.pid, r.f, r.d, r.n, r.kind) == (7, __import__("decimal").Decimal("1.50"), [1, None], "x", "d", 3, True)
    ints = spark.createDataFrame([(1, 5), (1, 9)], "k int, t int")
    spans = spark.createDataFrame([(1, 4, 6, "u")], "k int, a long, b long, n string")
    assert sorted((r.t, r.n) for r in sweep_join(ints, spans, "k", "t", "a", "b").collect()) == [(5, "u"), (9, None)]
    with pytest.raises(TypeError):
        sweep_join(fact, dim.withColumn("s", F.lit("2024")), "k", "ts", "s", "e")


@pytest.mark.parametrize("seed", range(2))
def test_combined_rows_equal_grouped_pairs(fine, seed):
    r = random.Random(seed)
    facts = [(r.choice(["hot", "hot", "a", None]), at(r.choice([None, *range(300)])), i) for i in range(700)]
    facts += facts[:30]
    dims = []
    for _ in range(200):
        s = r.choice([None, *range(300)])
        e = None if r.random() < 0.1 else (s or 0) + r.randrange(-5, 150)
        dims.append((r.choice(["hot", "a", None]), at(s), at(e), None if r.random() < 0.2 else r.randrange(-50, 50)))
    fact = fine.createDataFrame(facts, FACT).withColumn("row", F.monotonically_increasing_id()).repartition(3)
    dim = fine.createDataFrame(dims, DIM.replace("name string", "v long"))
    fact = fact.localCheckpoint()
    aggs = {"n": ("count", "v"), "total": ("sum", "v"), "low": ("min", "v")}
    for how in ("left", "inner"):
        pairs = sweep_join(fact, dim, "k", "ts", "s", "e", how)
        want = pairs.groupBy(*fact.columns).agg(F.count("v").alias("n"), F.sum("v").alias("total"), F.min("v").alias("low"))
        got = sweep_join(fact, dim, "k", "ts", "s", "e", how, combine=aggs)
        assert got.columns == want.columns and got.count() == want.count() > 0
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_combine_does_not_build_pairs(fine):
    """60,000 facts that all meet 60,000 open intervals: 3.6e9 pairs, 60,000 rows."""
    n = 60_000
    facts = fine.range(n).select(F.lit("a").alias("k"), F.lit(T0 + dt.timedelta(days=1)).cast("timestamp_ntz").alias("ts"), "id")
    dims = fine.range(n).select(
        F.lit("a").alias("k"), F.lit(T0).cast("timestamp_ntz").alias("s"), F.lit(None).cast("timestamp_ntz").alias("e"), F.col("id").alias("v")
    )
    out = sweep_join(facts, dims, "k", "ts", "s", "e", combine={"n": ("count", "v"), "low": ("min", "v"), "total": ("sum", "v")})
    assert out.agg(F.count("*"), F.min("n"), F.max("n"), F.max("low"), F.min("total")).first() == (n, n, n, 0, n * (n - 1) // 2)
    with pytest.raises(TypeError):
        sweep_join(facts, dims.withColumn("v", F.lit("x")), "k", "ts", "s", "e", combine={"n": ("min", "v")})
