"""Physical plans: the shapes the operators are built for."""

from sfdirs import SF001
from planutil import plan_text
from stationlake.plans.queries import QUERIES


def test_dedup_limits_before_shuffle(spark):
    p = plan_text(QUERIES["dedup_latest"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p
    # the partial limit sits below the exchange
    assert p.index("Partial") > p.index("Exchange")


def test_effective_fact_broadcasts_histories(spark):
    p = plan_text(QUERIES["effective_dated_fact"](spark, SF001), "simple")
    assert p.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in p


def test_month_slice_prunes_partitions(spark):
    p = plan_text(QUERIES["partition_slice"](spark, SF001))
    assert "PartitionFilters: [isnotnull(month" in p
    assert "1996-01" in p and "1996-06" in p


def test_scan_pruning_and_pushdown(spark):
    p = plan_text(QUERIES["time_slice"](spark, SF001))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    p = plan_text(QUERIES["global_max"](spark, SF001))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in p


def test_no_python_outside_archives_and_the_sweep(spark):
    for name, fn in QUERIES.items():
        p = plan_text(fn(spark, SF001))
        has_python = any(k in p for k in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "PythonUDF"))
        assert has_python == (name in ("archive_members", "hot_key_intervals")), name  # the zip reader and the sweep


def test_topk_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan_text(QUERIES["topk"](spark, SF001))
