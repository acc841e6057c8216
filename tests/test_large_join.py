"""Histories too large to broadcast: joined in pairs after a shuffle by key, dense keys swept."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stationlake.operators import effective, effective_dated_join

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def _histories(spark, seed):
    r = random.Random(seed)
    keys = ["hot"] * 5 + ["a", "b", "c", "d", None]
    facts = [(r.choice(keys), at(r.choice([None, *range(200)])), i) for i in range(600)]
    dims = []
    for i in range(150):
        s = r.choice([None, *range(200)])
        e = None if r.random() < 0.2 else (s or 0) + r.randrange(-5, 60)
        dims.append((r.choice(keys), at(s), at(e), f"n{i}"))
    facts += facts[:30]
    dims += dims[:10]
    return (
        spark.createDataFrame(facts, "k string, ts timestamp_ntz, id long"),
        spark.createDataFrame(dims, "k string, s timestamp_ntz, e timestamp_ntz, name string"),
    )


@pytest.mark.parametrize("intervals, facts", [(256, 100_000), (40, 100_000), (256, 100), (256, 50), (0, 0)])
def test_large_join_equals_broadcast(spark, monkeypatch, intervals, facts):
    """Keys that are joined in pairs, swept ones, NULL among either, all together."""
    monkeypatch.setattr(effective, "MAX_PAIRED_INTERVALS", intervals)
    monkeypatch.setattr(effective, "MAX_PAIRED_FACTS", facts)
    fact, dim = _histories(spark, intervals + facts)
    for how in ("left", "inner"):
        small = effective_dated_join(fact, dim, "k", "ts", "s", "e", how)
        large = effective_dated_join(fact, dim, "k", "ts", "s", "e", how, max_broadcast_rows=0)
        assert large.columns == small.columns
        assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))


def test_few_intervals_are_not_swept(spark, monkeypatch):
    """No Python pass and no range shuffle where no key has many intervals; the sweep where one has."""
    swept = []
    sweep = effective.sweep_join
    monkeypatch.setattr(effective, "sweep_join", lambda *a, **k: swept.append(a[0]) or sweep(*a, **k))
    fact, dim = _histories(spark, 1)
    effective_dated_join(fact, dim, "k", "ts", "s", "e", max_broadcast_rows=0)
    assert not swept
    monkeypatch.setattr(effective, "MAX_PAIRED_INTERVALS", 40)
    effective_dated_join(fact, dim, "k", "ts", "s", "e", max_broadcast_rows=0)
    assert [r.k for r in swept[0].select("k").distinct().collect()] == ["hot"]
    assert swept[0].filter(F.col("k") != "hot").count() == 0
