"""Audit the physical plans of every registered job: report cross joins, nested-loop joins,
Python UDF nodes and single-partition exchanges, and count shuffles / broadcasts / scans.

    python tools/plan_audit.py [--sf /root/testdata/sf0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetscope.plans.catalog import all_specs  # noqa: E402
from fleetscope.session import get_spark  # noqa: E402

FLAGS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition")
# jobs that write files while being built (checked by their own tests)
EAGER = ("a1_read_extract_files", "a5_", "a6_", "a7_", "i1_", "i2_", "i3_")


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = get_spark("local[8]", shuffle_partitions=16)
    for name, spec in all_specs().items():
        if a.names and not name.startswith(tuple(a.names)):
            continue
        if name.startswith(EAGER):
            continue
        plan = spec.run(spark, a.sf)._jdf.queryExecution().executedPlan().toString()
        flags = [f for f in FLAGS if f in plan]
        print(f"{name}: shuffles={len(re.findall(r'Exchange hashpartitioning|Exchange rangepartitioning', plan))} "
              f"broadcasts={plan.count('BroadcastExchange')} scans={plan.count('FileScan')} "
              f"windows={len(re.findall(r'Window ', plan))} {'FLAGS=' + ','.join(flags) if flags else ''}")
    spark.stop()


if __name__ == "__main__":
    main()
