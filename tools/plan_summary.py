"""Operator counts of each query's physical plan, as a markdown table.

    python tools/plan_summary.py [--sf-dir DIR] [--no-broadcast] [name ...]

Counts come from ``explain("formatted")`` (the plan before AQE re-planning):
shuffle exchanges, broadcast exchanges, join strategies, windows, aggregates,
generators and parquet scans.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNT = [("shuffles", r"^\(\d+\) Exchange$"), ("broadcasts", r"^\(\d+\) BroadcastExchange$"),
         ("smj", r"^\(\d+\) SortMergeJoin"), ("bhj", r"^\(\d+\) BroadcastHashJoin"),
         ("nested_loop", r"^\(\d+\) (BroadcastNestedLoopJoin|CartesianProduct)"),
         ("windows", r"^\(\d+\) Window$"), ("aggregates", r"^\(\d+\) (Hash|Sort|ObjectHash)Aggregate$"),
         ("generators", r"^\(\d+\) Generate$"), ("scans", r"^\(\d+\) Scan parquet")]


def summarise(df) -> dict[str, int]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    lines = [ln.strip() for ln in buf.getvalue().splitlines()]
    return {k: sum(1 for ln in lines if re.match(p, ln)) for k, p in COUNT}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--no-broadcast", action="store_true")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from bench import HEADLINE
    from cohortlab.session import build_session
    extra = {}
    if a.no_broadcast:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session(shuffle_partitions=16, extra=extra)
    from cohortlab.plans.catalog import QUERIES
    names = a.names or [n for n in HEADLINE if n in QUERIES]
    print("| query | " + " | ".join(k for k, _ in COUNT) + " |")
    print("|---" * (len(COUNT) + 1) + "|")
    for n in names:
        s = summarise(QUERIES[n](spark, a.sf_dir))
        print(f"| {n} | " + " | ".join(str(s[k]) for k, _ in COUNT) + " |", flush=True)


if __name__ == "__main__":
    main()
