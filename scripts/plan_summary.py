"""Markdown table of the physical plan shape of every registered query:
shuffles by kind, broadcasts, Python stages, pushed filters.

Usage: python scripts/plan_summary.py [sf_dir [name ...]]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


def main() -> None:
    from stationlake.plans.queries import QUERIES
    from stationlake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(extra={"spark.ui.showConsoleProgress": "false"})
    print("| query | hash | range | round-robin | single | broadcast | python | pushed filters |")
    print("|---|---|---|---|---|---|---|---|")
    only = set(sys.argv[2:])
    for name, fn in ((n, f) for n, f in QUERIES.items() if not only or n in only):
        p = plan_text(fn(spark, sf_dir))
        count = lambda pat: len(re.findall(pat, p))
        print(
            f"| {name} | {count(r'Exchange hashpartitioning')} | {count(r'Exchange rangepartitioning')} "
            f"| {count(r'Exchange RoundRobinPartitioning')} | {count(r'Exchange SinglePartition')} "
            f"| {count(r'BroadcastExchange')} | {count(r'MapInPandas|MapInArrow|ArrowEvalPython|BatchEvalPython')} "
            f"| {'yes' if re.search(r'PushedFilters: \[[^\]]', p) else 'no'} |"
        )
    spark.stop()


if __name__ == "__main__":
    main()
