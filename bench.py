"""Benchmark: run the headline jobs on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]`` and print
one JSON line with per-job seconds.  Each job is executed completely with the ``noop``
sink (full plan, no collect to the driver).  Every job runs ``$BENCH_RUNS`` times (default
2): ``queries`` / ``value`` report the best run (steady state), ``cold`` the first run
(includes code generation and JIT warm-up for that plan)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetscope.plans.catalog import all_specs  # noqa: E402
from fleetscope.session import get_spark  # noqa: E402

HEADLINE = [
    "c1_counter_delta", "c5_hourly_profile", "c6_os_stat_profile", "c9_io_event_profile", "c10_io_function_profile",
    "c12_command_profile", "c14_top_statements", "c17_hour_matrix_count",
    "d1_data_type_counts", "d2_data_type_matrix", "d7_constraint_matrix", "d11_schema_objects",
    "d16_compression_by_type", "d17_lob_sizing", "d21_source_code_metrics", "d23_dialect_dependencies",
    "d27_object_list_mssql",
    "e0_readiness_report", "f0_validation_findings", "f25_validation_summary",
    "g1_identity_map", "g2_apply_mask", "a1_read_extract", "i3_stream_counter_delta",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="fleetscope-bench", shuffle_partitions=max(8, 2 * cpus),
                      extra={"spark.driver.memory": "16g"})
    specs = all_specs()
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    times, cold = {}, {}
    for name in names:
        best = None
        for i in range(runs):
            t0 = time.time()
            specs[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.time() - t0
            if i == 0:
                cold[name] = round(dt, 3)
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cold_total": round(sum(cold.values()), 3), "cold": cold, "runs": runs,
                      "cpus": cpus, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
