"""Print, for every registered query, risky physical operators (cartesian products, nested-loop joins,
single-partition exchanges, Python evaluation) and windows without a partition key, and the number of
scans and exchanges of the widest plans.

The plans of staged tables are scanned as they are written, not as the one scan that reads them back.

usage: python tools/plan_scan.py [sf_dir]
"""
import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from affinis import session  # noqa: E402
from affinis.plans.registry import QUERIES  # noqa: E402

RISKY = ["CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition", "BatchEvalPython", "ArrowEvalPython"]
plans: dict[str, str] = {}
write = session._write


def recorded(df, name):
    plans[f"table {name}"] = df._jdf.queryExecution().executedPlan().toString()
    return write(df, name)


def main():
    session._write = recorded
    spark = session.build_session("local[8]")
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    for n, fn in QUERIES.items():
        plans[n] = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    found = collections.defaultdict(list)
    width = []
    for n, plan in plans.items():
        for pat in RISKY:
            if plan.count(pat):
                found[pat].append((n, plan.count(pat)))
        for spec in re.findall(r"windowspecdefinition\(([^,)]*)", plan):
            if " ASC" in spec or " DESC" in spec:          # the first argument is an ordering: no PARTITION BY
                found["window without partition key"].append((n, spec.strip()[:40]))
        width.append((plan.count("Exchange hashpartitioning"), plan.count("FileScan"), n))
    for k, v in found.items():
        print(k, len(v))
        for x in v:
            print("   ", x)
    print("widest plans (hash exchanges, scans):")
    for x in sorted(width, reverse=True)[:12]:
        print("   ", x)
    spark.stop()


if __name__ == "__main__":
    main()
