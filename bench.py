"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and forced through the ``noop`` sink (every row is
produced, nothing is collected): one cold run, which also derives and writes
the warehouse tables the query reads, then the median of five.  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera import catalog  # noqa: E402
from tessera.session import local_session  # noqa: E402

HEADLINE = ["card_pos_tran", "fee_txn_rules", "rule_audit_counts", "cal_expand_days",
            "cal_lookback_totals", "trigger_dispatch"]


def run_once(spark, key, sf_dir):
    t0 = time.perf_counter()
    df = catalog.QUERIES[key](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]
    reps = int(os.environ.get("BENCH_REPS", "5"))
    default_parts = cpus if cpus.isdigit() else str(os.cpu_count() or 8)
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS",
                                                                      default_parts)))
    times, cold = {}, {}
    for key in keys:
        cold[key] = round(run_once(spark, key, sf_dir), 3)
        times[key] = round(statistics.median(run_once(spark, key, sf_dir) for _ in range(reps)), 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
