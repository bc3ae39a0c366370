"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line {"metric", "value", "unit", "queries", "staging", "sf"}.
Each query is built and run to completion (``noop`` sink, so every row is
produced but nothing is collected).  ``queries`` holds its whole time and
``staging`` the part of it that went into writing shared tables.  By default
later queries reuse the tables that earlier ones wrote, as one pipeline run
does; with BENCH_COLD=1 every query starts without any, so its time does not
depend on the order.  value = sum of the per-query times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from affinis.plans.registry import QUERIES  # noqa: E402
from affinis import session  # noqa: E402
from affinis.plans import workflows  # noqa: E402

HEADLINE = [
    "profile_tags",
    "features_true",
    "negative_pairs",
    "training_set",
    "candidate_pairs",
    "features_candidates",
    "map_threshold_grid",
    "confusion_by_threshold",
    "area_under_roc",
    "lr_weights",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    cold = os.environ.get("BENCH_COLD") == "1"
    spark = session.build_session(f"local[{cpus}]", app="affinis-bench")
    # warm-up: JVM class loading and codegen, not counted
    QUERIES["title_word_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, staging = {}, {}
    for n in names:
        if cold:
            session.forget_staged()
            workflows.forget_models()
        t, before = time.time(), session.staging_seconds
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t, 3)
        staging[n] = round(session.staging_seconds - before, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "staging": staging, "cold": cold, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
